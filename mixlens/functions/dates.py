"""Calendar parts in the two flavours the warehouse uses, and week starts."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from mixlens.functions.cleaning import _col


def iso_date_parts(c: Column | str) -> list[Column]:
    """Year, month, ISO week, weekday (1 = Monday), weekend flag and ISO year.

    ``year`` is the calendar year, so 2024-12-30 is (2024, week 1). Group by
    ``iso_year`` and ``week`` where weeks must not mix across years.
    """
    d = _col(c)
    weekday = F.weekday(d) + 1
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week"),
        weekday.alias("day_of_week"),
        (weekday >= 6).cast("int").alias("is_weekend"),
        F.extract(F.lit("YEAROFWEEK"), d).alias("iso_year"),
    ]


def calendar_date_parts(c: Column | str) -> list[Column]:
    """Year, month, day, quarter, weekday (1 = Sunday) and the English names."""
    d = _col(c)
    return [
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
    ]


def week_start_sunday(c: Column | str) -> Column:
    """The Sunday on or before the date."""
    d = _col(c)
    return F.date_sub(d, F.dayofweek(d) - 1)


def week_start_monday(c: Column | str) -> Column:
    """The Monday on or before the date."""
    return F.date_trunc("week", _col(c)).cast("date")


def season(week: Column | str, period: int = 52) -> tuple[Column, Column]:
    """Sine and cosine of the position of ``week`` in the yearly cycle."""
    angle = F.lit(2 * math.pi) * _col(week) / F.lit(period)
    return F.sin(angle), F.cos(angle)
