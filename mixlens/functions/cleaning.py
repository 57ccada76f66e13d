"""Coercions for dirty report columns; every one works on string and on typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = "decimal(18,4)"

# Layouts of dates in exported reports, besides ISO dates. A single letter takes one or two digits.
REPORT_DATE_FORMATS = (
    "M/d/yyyy",
    "M/d/yy",
    "M-d-yyyy",
    "yyyy/M/d",
    "yyyyMMdd",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d MMM yyyy",
    "d-MMM-yyyy",
    "d-MMM-yy",
)

# A time of day after the date, as spreadsheets write it; it is not part of the date.
_TIME_OF_DAY = r"(?i)[ T]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*([ap]m)?\s*(z|utc|[+-]\d{2}:?\d{2})?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_long(c: Column | str) -> Column:
    """Whole number, cut towards zero; unreadable values stay null."""
    # Through a decimal, because casts to double also read spellings such as "12d".
    through = _col(c).try_cast("decimal(38,9)").try_cast("bigint")
    return F.coalesce(_col(c).try_cast("bigint"), through)


def to_long0(c: Column | str) -> Column:
    """Whole number, cut towards zero; unreadable values become 0."""
    return F.coalesce(to_long(c), F.lit(0).cast("bigint"))


def to_money(c: Column | str) -> Column:
    """Decimal amount; unreadable values stay null."""
    return _col(c).try_cast(MONEY)


def to_money0(c: Column | str) -> Column:
    """Decimal amount; unreadable values become 0."""
    return F.coalesce(to_money(c), F.lit(0).cast(MONEY))


def parse_pct(c: Column | str) -> Column:
    """``"45.2%"`` to 45.2; unreadable values stay null."""
    number = F.regexp_replace(_col(c).cast("string"), "%+$", "")
    # Casts to double also read spellings such as "12d"; casts to decimal do not.
    return F.when(number.try_cast("decimal(38,9)").isNotNull(), number.try_cast("double"))


def parse_currency0(c: Column | str) -> Column:
    """``"$1,234.50"`` to 1234.5000; unreadable values become 0."""
    return to_money0(F.regexp_replace(_col(c).cast("string"), "[$,]", ""))


def to_date_or_null(c: Column | str, formats: tuple[str, ...] = ()) -> Column:
    """Calendar date without time; unreadable values stay null.

    ``formats`` adds layouts to try after ISO dates, for string columns only; a
    time of day behind the date is set aside.
    """
    parsed = _col(c).try_cast("date")
    if not formats:
        return parsed
    text = F.regexp_replace(F.trim(_col(c)), _TIME_OF_DAY, "")
    extra = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in formats]
    return F.coalesce(parsed, text.try_cast("date"), *extra)


def date_column(df: DataFrame, name: str) -> Column:
    """A report's date column as a date; strings are tried in all report layouts.

    Columns that are dates already stay as they are, so filters on them still
    reach the scan.
    """
    is_text = isinstance(df.schema[name].dataType, T.StringType)
    return to_date_or_null(name, REPORT_DATE_FORMATS if is_text else ())


def unreadable_dates(df: DataFrame, *names: str) -> DataFrame:
    """For each date column, how many rows have a value that is no date in any layout: column, unreadable.

    Facts leave such rows out, so this tells what a load would lose.
    """
    counts = [
        F.count_if(F.col(n).isNotNull() & (F.trim(F.col(n).cast("string")) != "") & date_column(df, n).isNull()) for n in names
    ]
    rows = F.array(
        *[F.struct(F.lit(n).alias("column"), F.col(f"_{i}").alias("unreadable")) for i, n in enumerate(names)]
    )
    return df.agg(*[c.alias(f"_{i}") for i, c in enumerate(counts)]).select(F.inline(rows))
