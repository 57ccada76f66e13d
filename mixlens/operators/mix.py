"""Weekly series: adstock, saturation, seasonality, KPIs and scorecards.

Frames have one row per (series, week). A series (account, geo, product) is
bounded by the calendar, so windows over one series stay small; the work is
spread over series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixlens.functions.cleaning import _col
from mixlens.functions.dates import season
from mixlens.functions.ratios import eps_ratio, safe_ratio


@dataclass(frozen=True)
class Channel:
    """An advertising channel and the shape of its response."""

    name: str
    label: str
    decay: float
    half_saturation: float
    exponent: float = 2.0

    @property
    def spend(self) -> str:
        return f"spend_{self.name}"

    @property
    def adstock(self) -> str:
        return f"adstock_spend_{self.name}"

    @property
    def saturated(self) -> str:
        return f"saturated_spend_{self.name}"

    @property
    def transformed(self) -> str:
        return f"transformed_spend_{self.name}"

    @property
    def beta(self) -> str:
        return f"coef_{self.transformed}"

    @property
    def contribution(self) -> str:
        return f"contrib_{self.name}"


# Channels with their decay and half-saturation spend.
CHANNELS = (
    Channel("sp", "Sponsored Products", 0.5, 3000.0),
    Channel("sb", "Sponsored Brands", 0.3, 1500.0),
    Channel("dsp", "DSP", 0.7, 1000.0),
)

FORMS = ("spend", "saturating")


def memory_length(decay: float, precision: float = 1e-17) -> int:
    """Number of periods after which a decayed value no longer changes a double."""
    if not 0 <= decay < 1:
        raise ValueError(f"decay must be in [0, 1), not {decay}")
    return 1 if decay == 0 else math.ceil(math.log(precision) / math.log(decay))


def adstock_over(c: Column | str, decay: float, window: Window) -> Column:
    """Carry-over ``a_t = x_t + decay * a_(t-1)`` over an ordered window; null counts as 0."""
    frame = window.rowsBetween(1 - memory_length(decay), 0)
    recent = F.collect_list(F.coalesce(_col(c).cast("double"), F.lit(0.0))).over(frame)
    return F.aggregate(recent, F.lit(0.0), lambda carried, x: carried * decay + x)


def adstock(df: DataFrame, column: str, decay: float, series: Sequence[str], order: str) -> DataFrame:
    """Add ``adstock_<column>``."""
    window = Window.partitionBy(*series).orderBy(order)
    return df.withColumn(f"adstock_{column}", adstock_over(column, decay, window))


def hill(c: Column | str, k: Column | float, n: float = 2.0) -> Column:
    """Saturation ``x^n / (k^n + x^n)``: 0.5 at ``k``."""
    powered = F.pow(_col(c), F.lit(float(n)))
    half = F.pow(k if isinstance(k, Column) else F.lit(float(k)), F.lit(float(n)))
    return powered / (half + powered)


def transform_channels(
    df: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    series: Sequence[str] = ("series",),
    order: str = "week_start",
    form: str = "spend",
) -> DataFrame:
    """Add adstock, saturation and the model feature of every channel.

    ``form="spend"`` multiplies saturation by raw spend, which grows without
    bound; ``form="saturating"`` uses saturation alone.
    """
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}, not {form!r}")
    window = Window.partitionBy(*series).orderBy(order)
    stocked = df.select("*", *[adstock_over(c.spend, c.decay, window).alias(c.adstock) for c in channels])
    saturated = stocked.select(
        "*", *[hill(c.adstock, c.half_saturation, c.exponent).alias(c.saturated) for c in channels]
    )
    return saturated.select(
        "*",
        *[
            (F.col(c.saturated) * F.col(c.spend) if form == "spend" else F.col(c.saturated)).alias(
                c.transformed
            )
            for c in channels
        ],
    )


def season_features(df: DataFrame, week: str = "week", period: int = 52) -> DataFrame:
    """Add ``season_sin`` and ``season_cos``."""
    sine, cosine = season(week, period)
    return df.select("*", sine.alias("season_sin"), cosine.alias("season_cos"))


def weekly_kpis(df: DataFrame) -> DataFrame:
    """Add ROAS, TACoS and CTR per row. They must not be averaged; see ``kpi_total``."""
    return df.select(
        "*",
        eps_ratio("ad_sales", "spend_total", 3).alias("roas"),
        eps_ratio("spend_total", "total_sales", 3).alias("tacos"),
        eps_ratio("clicks_total", "impressions_total", 4).alias("ctr"),
    )


def _totals(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("spend_total").alias("spend"),
        F.sum("ad_sales").alias("ad_sales"),
        F.sum("total_sales").alias("total_sales"),
        F.sum("clicks_total").alias("clicks"),
        F.sum("impressions_total").alias("impressions"),
    )


def kpi_total(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROAS, TACoS and CTR as ratios of sums, for any grouping."""
    return _totals(df, by).select(
        *by,
        "spend",
        "ad_sales",
        "total_sales",
        safe_ratio("ad_sales", "spend").alias("roas"),
        safe_ratio("spend", "total_sales").alias("tacos"),
        safe_ratio("clicks", "impressions").alias("ctr"),
    )


def scorecard_yoy(df: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Yearly spend, sales, ROAS and TACoS with the change against the year before."""
    yearly = _totals(df, [*series, F.year("week_start").alias("year")]).select(
        *series,
        "year",
        "spend",
        "total_sales",
        safe_ratio("ad_sales", "spend").alias("roas"),
        safe_ratio("spend", "total_sales").alias("tacos"),
    )
    # One row per year and series; a missing year leaves the change empty.
    years = Window.partitionBy(*series).orderBy("year")
    previous_year = F.lag("year").over(years) == F.col("year") - 1
    changes = []
    for m in ("spend", "total_sales", "roas", "tacos"):
        before = F.when(previous_year, F.lag(m).over(years))
        changes.append((safe_ratio(m, before) - 1).alias(f"{m}_yoy"))
    return yearly.select("*", *changes)


def channel_mix(long: DataFrame, period: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Spend per period and channel and its share of the period; periods are years by default."""
    period = F.year("week_start") if period is None else period
    spend = long.groupBy(*by, period.alias("period"), "channel").agg(F.sum("spend").alias("spend"))
    # One row per channel in each window.
    whole = F.sum("spend").over(Window.partitionBy(*by, "period"))
    return spend.select("*", safe_ratio("spend", whole).alias("share"))


def ads_organic_split(df: DataFrame, period: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Ad and organic sales per period and their shares of total sales."""
    period = F.year("week_start") if period is None else period
    sums = df.groupBy(*by, period.alias("period")).agg(
        F.sum("ad_sales").alias("ad_sales"),
        F.sum("organic_sales").alias("organic_sales"),
        F.sum("total_sales").alias("total_sales"),
    )
    return sums.select(
        "*",
        safe_ratio("ad_sales", "total_sales").alias("ad_share"),
        safe_ratio("organic_sales", "total_sales").alias("organic_share"),
    )
