"""Small tables derived from the standing questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.functions.ratios import cut


def roas_histogram(q1: DataFrame, min_spend: float = 50, bins: int = 30) -> DataFrame:
    """Equal-width ROAS histogram of campaigns that spent enough, and their median.

    The last bin includes the maximum, empty bins are listed with 0. Bounds and
    median come from one aggregate. The median is exact: Spark combines equal
    values before the shuffle, and ROAS has two decimals.
    """
    active = q1.where((F.col("spend") >= min_spend) & F.col("roas").isNotNull()).select("roas")
    bounds = active.groupBy("roas").count().agg(
        F.min("roas").alias("low"),
        F.max("roas").alias("high"),
        F.percentile("roas", 0.5, F.col("count")).alias("median_roas"),
    )
    # A single value gets a bin range of width 1 around it.
    flat = F.col("low") == F.col("high")
    edges = bounds.select(
        F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        "median_roas",
    )
    limits = edges.select(F.struct("low", "high").alias("limits")).scalar()
    position = (F.col("roas") - limits["low"]) * bins / (limits["high"] - limits["low"])
    filled = (
        active.select(F.least(F.floor(position).cast("int"), F.lit(bins - 1)).alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("campaigns"))
    )
    width = (F.col("high") - F.col("low")) / bins
    all_bins = edges.where(F.col("low").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "low", "high", "median_roas"
    )
    return (
        all_bins.join(filled, "bin", "left")
        .select(
            "bin",
            (F.col("low") + F.col("bin") * width).alias("bin_start"),
            (F.col("low") + (F.col("bin") + 1) * width).alias("bin_end"),
            F.coalesce("campaigns", F.lit(0).cast("bigint")).alias("campaigns"),
            "median_roas",
        )
        .orderBy("bin")
    )


def top_harvest(q2: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` harvestable terms with the highest sales, labels cut to 50 characters."""
    return (
        q2.orderBy(F.col("sales").desc(), "customer_search_term", "campaign_name", "match_type")
        .limit(k)
        .select(cut("customer_search_term", 50).alias("term"), "campaign_name", "match_type", "sales")
    )


def waste_by_reason(q3: DataFrame) -> DataFrame:
    """Wasted spend and number of terms per reason."""
    return (
        q3.groupBy("waste_reason")
        .agg(F.sum("spend").alias("total_spend"), F.count("spend").alias("n_search_terms"))
        .orderBy(F.col("total_spend").desc(), "waste_reason")
    )


def health_distribution(q4: DataFrame) -> DataFrame:
    """Number of products per health label."""
    return (
        q4.groupBy("health_label")
        .agg(F.count(F.lit(1)).alias("products"))
        .orderBy(F.col("products").desc(), "health_label")
    )


def anomalous_days(q5: DataFrame) -> DataFrame:
    """Days that carry the anomaly flag."""
    return q5.where(F.col("anomaly_flag") == "roas_anomaly")


def query_totals(q1: DataFrame, q3: DataFrame) -> DataFrame:
    """Number of campaigns analysed and total wasted spend, in one row."""
    campaigns = q1.agg(F.count(F.lit(1)).alias("n")).scalar()
    return q3.agg(
        F.count(F.lit(1)).alias("wasted_terms"), F.sum("spend").alias("total_wasted_spend")
    ).select(campaigns.alias("campaigns"), "wasted_terms", "total_wasted_spend")


def mmm_overview(weekly: DataFrame, series: str | None = None) -> DataFrame:
    """Weekly spend by channel, total and organic sales, and TACoS beside its mean.

    The mean is taken over weekly ratios, as in the overview charts; use
    ``kpi_total`` for the ratio of sums.
    """
    keys = [series] if series else []
    tacos = F.round(F.col("spend_total") / (F.col("total_sales") + F.lit(1e-9)), 3)
    rows = weekly.select(
        *keys,
        "week_start",
        "spend_sp",
        "spend_sb",
        "spend_dsp",
        "spend_total",
        "total_sales",
        "organic_sales",
        tacos.alias("tacos"),
    )
    means = rows.groupBy(*keys).agg(F.avg("tacos").alias("mean_tacos"))
    if not keys:
        return rows.select("*", means.scalar().alias("mean_tacos"))
    return rows.join(means, keys)
