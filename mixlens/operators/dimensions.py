"""Date, campaign and product dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mixlens.functions.cleaning import date_column, to_money
from mixlens.functions.dates import calendar_date_parts, iso_date_parts
from mixlens.operators.joins import join_dimension


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``, which should be a total order.

    Spark turns the filter on the row number into a group limit that each task
    applies before the shuffle, so a hot key travels as one row per task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def _nulls_last(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _file_order(df: DataFrame, *ties: str) -> list[Column]:
    """Position in the report where the frame has one, then the named columns."""
    first = ["ingest_seq"] if "ingest_seq" in df.columns else []
    return _nulls_last(*first, *[t for t in ties if t in df.columns])


def dim_date_observed(*dates: tuple[DataFrame, str]) -> DataFrame:
    """Every date found in the given columns, with ISO parts and ``iso_year``."""
    found = [df.select(date_column(df, column).alias("date_id")).distinct() for df, column in dates]
    days = reduce(DataFrame.unionByName, found).where(F.col("date_id").isNotNull()).distinct()
    return days.select("date_id", *iso_date_parts("date_id"))


def dim_date_spine(spark: SparkSession, start: str, end_exclusive: str) -> DataFrame:
    """Every day from ``start`` up to, but without, ``end_exclusive``."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("first_day"), F.lit(end_exclusive).cast("date").alias("end_day")
    )
    return calendar_between(bounds, "first_day", "end_day")


def calendar_between(bounds: DataFrame, start: str, end_exclusive: str) -> DataFrame:
    """The spine for bounds that are themselves computed: a one-row frame with two dates."""
    # A sequence must not run backwards, so an empty range starts as one day and is filtered out.
    last = F.greatest(F.col(start), F.date_sub(F.col(end_exclusive), 1))
    days = bounds.select(
        F.explode(F.sequence(F.col(start), last, F.expr("interval 1 day"))).alias("date_id"), end_exclusive
    ).where(F.col("date_id") < F.col(end_exclusive))
    return days.select("date_id", F.col("date_id").alias("full_date"), *calendar_date_parts("date_id"))


def dim_campaign_entity(bulk: DataFrame) -> DataFrame:
    """Campaigns from the bulk file's campaign rows, the first row per id."""
    campaigns = bulk.where((F.col("entity") == "Campaign") & F.col("campaign_id").isNotNull())
    order = _file_order(
        bulk, "campaign_name", "portfolio_id", "portfolio_name", "targeting_type",
        "bidding_strategy", "state", "daily_budget",
    )
    return keep_first(campaigns, ["campaign_id"], order).select(
        "campaign_id",
        "campaign_name",
        "portfolio_id",
        "portfolio_name",
        "targeting_type",
        "bidding_strategy",
        "state",
        to_money("daily_budget").alias("daily_budget"),
    )


def dim_campaign_dedup(bulk: DataFrame) -> DataFrame:
    """Campaigns from all rows of the bulk file; a row with a name wins over one without.

    Rows that tie on the name are told apart by entity (campaign rows first)
    and then by the remaining columns.
    """
    order = [
        F.col("campaign_name").asc_nulls_last(),
        F.when(F.col("entity") == "Campaign", 0).otherwise(1).asc(),
        *_nulls_last("product", "targeting_type", "state", "daily_budget", "bidding_strategy"),
    ]
    rows = bulk.where(F.col("campaign_id").isNotNull())
    return keep_first(rows, ["campaign_id"], order).select(
        "campaign_id",
        "campaign_name",
        F.col("product").alias("ad_product"),
        "targeting_type",
        "state",
        to_money("daily_budget").alias("daily_budget"),
        "bidding_strategy",
    )


def dim_product_outer(ads: DataFrame, business: DataFrame) -> DataFrame:
    """Products from both reports: sku from the ads, title from the business report.

    Each side is reduced to one row per product before the full outer join, so
    neither side can multiply the other.
    """
    skus = keep_first(
        ads.where(F.col("advertised_asin").isNotNull())
        .select(F.col("advertised_asin").alias("asin"), F.col("advertised_sku").alias("sku"))
        .distinct(),
        ["asin"],
        _nulls_last("sku"),
    )
    titles = keep_first(
        business.where(F.col("parent_asin").isNotNull())
        .select(F.col("parent_asin").alias("asin"), F.col("product_title").alias("title"))
        .distinct(),
        ["asin"],
        _nulls_last("title"),
    )
    return skus.join(titles, "asin", "full_outer").select("asin", "sku", "title")


def product_titles(business: DataFrame) -> DataFrame:
    """The title side of the product dimension: asin, title of the products in the business report."""
    return (
        business.where(F.col("parent_asin").isNotNull())
        .groupBy(F.col("parent_asin").alias("asin"))
        .agg(F.min("product_title").alias("title"))
    )


def dim_product_dedup(bulk: DataFrame) -> DataFrame:
    """Products by sku from the bulk file; a row with a product id wins over one without."""
    rows = bulk.where(F.col("sku").isNotNull()).select("sku", "asin")
    return keep_first(rows, ["sku"], _nulls_last("asin"))


def campaign_lookup(bulk: DataFrame) -> DataFrame:
    """Campaign name to id, the first id per name."""
    campaigns = bulk.where((F.col("entity") == "Campaign") & F.col("campaign_name").isNotNull())
    order = _file_order(bulk, "campaign_id")
    return keep_first(campaigns, ["campaign_name"], order).select("campaign_name", "campaign_id")


def dim_product_bridge(family: DataFrame) -> DataFrame:
    """Child to parent products, one parent per child, for reports that use different ids.

    ``family`` has the columns ``child_asin`` and ``parent_asin``.
    """
    known = family.where(F.col("child_asin").isNotNull() & F.col("parent_asin").isNotNull())
    return keep_first(
        known.select("child_asin", "parent_asin"), ["child_asin"], [F.col("parent_asin").asc()]
    )


def to_parent_asin(fact: DataFrame, bridge: DataFrame) -> DataFrame:
    """Replace child products in a fact by their parents; products without one stay."""
    parents = bridge.select(F.col("child_asin").alias("asin"), F.col("parent_asin").alias("_parent"))
    columns = [
        F.coalesce("_parent", "asin").alias("asin") if c == "asin" else F.col(c) for c in fact.columns
    ]
    return join_dimension(fact, parents, "asin", "left").select(*columns)
