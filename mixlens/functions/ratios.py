"""Ratios, rounding and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from mixlens.functions.cleaning import _col


def safe_ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as a double, null where the denominator is 0 or null."""
    return _col(num).cast("double") / F.nullif(_col(den).cast("double"), F.lit(0.0))


def eps_ratio(num: Column | str, den: Column | str, digits: int | None = None, eps: float = 1e-9) -> Column:
    """``num / (den + eps)``: finite for zero denominators, rounded if ``digits`` is given.

    Such row ratios must not be averaged; use ratios of sums for totals.
    """
    ratio = _col(num).cast("double") / (_col(den).cast("double") + F.lit(eps))
    return ratio if digits is None else F.round(ratio, digits)


def round_to(c: Column | str, digits: int) -> Column:
    """Half-up rounding to ``digits``, as a double.

    The detour over nine decimals drops binary noise first, so half-way cases
    follow the written digits.
    """
    return F.round(_col(c).cast("decimal(38,9)"), digits).cast("double")


def label(cases: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The label of the first condition that holds."""
    (condition, value), *rest = cases
    out = F.when(condition, F.lit(value))
    for condition, value in rest:
        out = out.when(condition, F.lit(value))
    return out if otherwise is None else out.otherwise(F.lit(otherwise))


def cut(c: Column | str, n: int) -> Column:
    """The first ``n`` characters."""
    return F.substring(_col(c), 1, n)


def or_default(c: Column | str, default: object) -> Column:
    """``default`` where the column is null."""
    return F.coalesce(_col(c), F.lit(default))
