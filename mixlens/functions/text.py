"""Deterministic masking of names, product ids, ids and URLs.

Everything is a Catalyst expression. Equal inputs give equal outputs, so
masked ids still join across reports.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from mixlens.functions.cleaning import _col

# Shape of a product id, and the masks' prefixes and digest lengths.
PRODUCT_ID_PATTERN = r"B0[A-Z0-9]{8}"
PRODUCT_ID_PREFIX = "ASIN_"
PRODUCT_ID_DIGITS = 8
ID_DIGITS = 10
URL_PREFIX = "https://hashed-url.example/"
URL_DIGITS = 12


def _quote(term: str) -> str:
    # Java regex: every character that could be special is escaped.
    return re.sub(r"([^\w\s])", r"\\\1", term)


def scrub_terms(
    c: Column | str,
    terms: Iterable[tuple[str, str]],
    order: str = "longest",
    whole_word: bool = False,
) -> Column:
    """Replace every term, whatever its case, by its replacement.

    ``order="longest"`` takes long terms before the short ones inside them;
    ``order="given"`` keeps the order of the dictionary. ``whole_word`` leaves
    terms inside other words alone.
    """
    if order not in ("longest", "given"):
        raise ValueError(f"order must be 'longest' or 'given', not {order!r}")
    terms = list(terms)
    if order == "longest":
        terms.sort(key=lambda t: -len(t[0]))
    patterns = []
    for term, _ in terms:
        pattern = _quote(term)
        patterns.append(rf"(?U)\b{pattern}\b" if whole_word else pattern)
    text = out = _col(c)
    for pattern, (_, replacement) in zip(patterns, terms):
        java_replacement = replacement.replace("\\", "\\\\").replace("$", "\\$")
        out = F.regexp_replace(out, f"(?iu){pattern}", java_replacement)
    if len(terms) < 2:
        return out
    # Texts without any term, usually most of them, are looked at once and not once per term.
    return F.when(text.rlike("(?iu)" + "|".join(patterns)), out).otherwise(text)


def hash_embedded_ids(
    c: Column | str,
    pattern: str = PRODUCT_ID_PATTERN,
    prefix: str = PRODUCT_ID_PREFIX,
    digits: int = PRODUCT_ID_DIGITS,
) -> Column:
    """Replace each product id that stands as a word of its own by a digest of the id.

    ``pattern`` must match letters and digits only.
    """
    text = _col(c)
    bounded = rf"(?U)\b({pattern})\b"
    digests = F.transform(
        F.regexp_extract_all(text, F.lit(bounded), F.lit(1)),
        lambda found: F.concat(F.lit(prefix), F.upper(F.substring(F.sha1(found), 1, digits))),
    )
    # The texts between the ids are one more than the ids, so one pass puts them together again.
    pieces = F.zip_with(
        F.split(text, bounded), digests, lambda between, digest: F.concat(between, F.coalesce(digest, F.lit("")))
    )
    return F.when(text.rlike(bounded), F.array_join(pieces, "")).otherwise(text)


def hash_id(c: Column | str, prefix: str = "ID") -> Column:
    """``prefix_`` and the first digits of the SHA-1 of the id; null stays null."""
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(_col(c).cast("string")), 1, ID_DIGITS))


def hash_url(c: Column | str) -> Column:
    """A placeholder address with a digest of the URL; null and blank stay as they are."""
    url = _col(c)
    masked = F.concat(F.lit(URL_PREFIX), F.substring(F.sha1(url), 1, URL_DIGITS))
    return F.when(url.rlike(r"(?U)\S"), masked).otherwise(url)
