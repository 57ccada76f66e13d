"""Anonymisation of whole reports and the check that ids still join afterwards."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.functions.text import hash_embedded_ids, hash_id, hash_url, scrub_terms
from mixlens.sources.reports import _quoted

Terms = Sequence[tuple[str, str]]

# Headers that hold free text.
TEXT_COLUMNS = (
    "Campaign Name",
    "Campaign Name (Informational only)",
    "Ad Group Name",
    "Ad Group Name (Informational only)",
    "Portfolio Name (Informational only)",
    "Portfolio name",
    "Keyword Text",
    "Customer Search Term",
    "Targeting",
    "Product Targeting Expression",
    "Resolved Product Targeting Expression (Informational only)",
    "Title",
    "Product Name",
    "Description",
)

# Headers that hold URLs.
URL_COLUMNS = ("Landing Page URL", "Image Locator", "Image URL", "Creative Asset URL")

# Headers that carry the same ids under different names.
ID_PREFIXES = {
    "ASIN": "ASIN",
    "Advertised ASIN": "ASIN",
    "ASIN (Informational only)": "ASIN",
    "(Parent) ASIN": "ASIN",
    "(Child) ASIN": "ASIN",
    "SKU": "SKU",
    "Advertised SKU": "SKU",
}

# Id columns of each report.
BULK_IDS = (
    "Campaign ID",
    "Ad Group ID",
    "Portfolio ID",
    "Ad ID",
    "Keyword ID",
    "Product Targeting ID",
    "ASIN (Informational only)",
    "SKU",
)
TERM_IDS = ("Campaign ID", "Ad Group ID", "Advertised ASIN", "ASIN")
ADS_IDS = ("Campaign ID", "Ad Group ID", "Advertised ASIN", "Advertised SKU", "ASIN", "SKU")
BUSINESS_IDS = ("(Parent) ASIN", "(Child) ASIN", "ASIN")


def id_prefix(header: str) -> str:
    """The prefix of hashed ids in a column: shared by all headers of one id space."""
    fallback = header.translate(str.maketrans({" ": "_", "(": None, ")": None})).strip("_")
    return ID_PREFIXES.get(header, fallback)


def anonymize(
    df: DataFrame,
    id_columns: Iterable[str] = (),
    terms: Terms = (),
    text_columns: Iterable[str] = TEXT_COLUMNS,
    url_columns: Iterable[str] = URL_COLUMNS,
    order: str = "longest",
) -> DataFrame:
    """Scrub texts, hash ids and URLs; columns the frame lacks are ignored.

    ``terms`` is the caller's dictionary of names to hide. An id inside a text
    gets a shorter digest than the same id in an id column, so the two do not
    join with each other.
    """
    ids, texts, urls = set(id_columns), set(text_columns), set(url_columns)
    text_here = {name for name, kind in df.dtypes if name in texts and kind == "string"}

    def scrubbed(name: str) -> Column:
        column = F.col(_quoted(name))
        return (scrub_terms(column, terms, order) if name in text_here else column).alias(name)

    def masked(name: str) -> Column:
        column = F.col(_quoted(name))
        if name in text_here:
            column = hash_embedded_ids(column)
        if name in ids:
            column = hash_id(column, id_prefix(name))
        if name in urls:
            column = hash_url(column)
        return column.alias(name)

    # Two projections: the second reads a scrubbed text several times, the first computes it once.
    return df.select(*map(scrubbed, df.columns)).select(*map(masked, df.columns))


def anonymize_bulk(df: DataFrame, terms: Terms = ()) -> DataFrame:
    """Bulk campaign file: 8 id columns."""
    return anonymize(df, BULK_IDS, terms)


def anonymize_terms(df: DataFrame, terms: Terms = ()) -> DataFrame:
    """Search-term report: 4 id columns."""
    return anonymize(df, TERM_IDS, terms)


def anonymize_ads(df: DataFrame, terms: Terms = ()) -> DataFrame:
    """Advertised-product report: 6 id columns."""
    return anonymize(df, ADS_IDS, terms)


def anonymize_business(df: DataFrame, terms: Terms = ()) -> DataFrame:
    """Business report: 3 id columns."""
    return anonymize(df, BUSINESS_IDS, terms)


def id_overlap(a: DataFrame, a_col: str, b: DataFrame, b_col: str) -> DataFrame:
    """One row: distinct ids of each side and of both (null ids are not counted).

    Both sides are tagged and grouped by id once, so a hot id is combined
    before the shuffle and no join is needed.
    """
    tagged = a.select(F.col(_quoted(a_col)).alias("id"), F.lit(1).alias("side")).unionByName(
        b.select(F.col(_quoted(b_col)).alias("id"), F.lit(2).alias("side"))
    )
    sides = tagged.where(F.col("id").isNotNull()).groupBy("id").agg(F.bit_or("side").alias("sides"))
    return sides.agg(
        F.count_if(F.col("sides").bitwiseAND(1) > 0).alias("ids_a"),
        F.count_if(F.col("sides").bitwiseAND(2) > 0).alias("ids_b"),
        F.count_if(F.col("sides") == 3).alias("ids_both"),
    )
