"""The five standing questions about campaigns, search terms, products and days.

Facts are summed on their own keys before they meet a dimension: the sums
combine inside each map task, so a campaign that holds a third of the rows
reaches the join as few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mixlens.functions.ratios import cut, label, round_to, safe_ratio
from mixlens.operators.joins import join_dimension


def _sums(df: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(name) for c, name in measures.items()])


def _ratio(num: str, den: str, digits: int):
    return round_to(safe_ratio(num, den), digits)


def campaign_roas_tacos(fact_ads: DataFrame, dim_campaign: DataFrame, business: DataFrame) -> DataFrame:
    """Spend, sales, ROAS, ACoS per campaign, and TACoS against all business sales."""
    per_id = _sums(
        fact_ads,
        ["campaign_id"],
        {"spend": "total_spend", "sales_7d": "total_ad_sales", "orders_7d": "orders"},
    )
    attributes = ["campaign_id", "campaign_name", "portfolio_name", "targeting_type"]
    campaigns = per_id.join(dim_campaign.select(*attributes), "campaign_id")
    business_sales = business.agg(F.sum("ordered_product_sales").alias("total")).scalar()
    return (
        campaigns.select(
            "campaign_name",
            "portfolio_name",
            "targeting_type",
            F.round("total_spend", 2).alias("spend"),
            F.round("total_ad_sales", 2).alias("ad_sales"),
            "orders",
            _ratio("total_ad_sales", "total_spend", 2).alias("roas"),
            _ratio("total_spend", "total_ad_sales", 4).alias("acos"),
            round_to(safe_ratio("total_spend", business_sales), 4).alias("tacos"),
        )
        .where(F.col("spend") > 0)
        .orderBy(F.col("roas").desc_nulls_last(), "campaign_name")
    )


_TERM_SUMS = {
    "impressions": "impressions",
    "clicks": "clicks",
    "spend": "spend",
    "sales_7d": "sales",
    "orders_7d": "orders",
}


def _term_performance(fact_terms: DataFrame, dim_campaign: DataFrame, by_match_type: bool) -> DataFrame:
    """Search-term sums per campaign name and targeting type.

    The first sum is per campaign id, the second merges ids that share a name.
    A hot campaign may still have very many terms, hence the row-level join.
    """
    terms = ["customer_search_term", *(["match_type"] if by_match_type else [])]
    campaigns = dim_campaign.select("campaign_id", "campaign_name", "targeting_type")
    per_id = _sums(fact_terms, ["campaign_id", *terms], _TERM_SUMS)
    again = {name: name for name in _TERM_SUMS.values()}
    return _sums(
        join_dimension(per_id, campaigns, "campaign_id"),
        [*terms, "campaign_name", "targeting_type"],
        again,
    )


def harvestable_terms(
    fact_terms: DataFrame,
    dim_campaign: DataFrame,
    min_orders: int = 2,
    max_acos: float = 0.30,
    top: int = 5,
    exclude_existing_exact: bool = False,
) -> DataFrame:
    """Broad and phrase terms that sell well enough to be targeted exactly.

    Terms are ranked by sales within their campaign before the ACoS filter.
    ``exclude_existing_exact`` leaves out terms that the campaign already
    targets exactly.
    """
    targeted = dim_campaign.where(F.upper("targeting_type").isin("AUTO", "MANUAL"))
    open_match = fact_terms.where(F.col("match_type").isin("BROAD", "PHRASE"))
    terms = _term_performance(open_match, targeted, True)
    if exclude_existing_exact:
        exact = (
            fact_terms.where(F.col("match_type") == "EXACT")
            .select("campaign_id", "customer_search_term")
            .distinct()
        )
        exact = join_dimension(exact, targeted.select("campaign_id", "campaign_name"), "campaign_id")
        exact = exact.select("campaign_name", "customer_search_term")
        terms = terms.join(exact, ["campaign_name", "customer_search_term"], "left_anti")
    best_first = Window.partitionBy("campaign_name").orderBy(
        F.col("sales").desc_nulls_last(), "customer_search_term", "match_type", "targeting_type"
    )
    converting = terms.where((F.col("orders") >= min_orders) & (F.col("spend") > 0))
    return (
        converting.withColumn("rank_in_campaign", F.row_number().over(best_first))
        .where(F.col("rank_in_campaign") <= top)
        .select(
            "customer_search_term",
            "campaign_name",
            "targeting_type",
            "match_type",
            "impressions",
            "clicks",
            F.round("spend", 2).alias("spend"),
            F.round("sales", 2).alias("sales"),
            "orders",
            _ratio("sales", "spend", 2).alias("roas"),
            _ratio("spend", "sales", 4).alias("acos"),
            _ratio("orders", "clicks", 4).alias("conversion_rate"),
            "rank_in_campaign",
        )
        .where(F.col("acos") < max_acos)
        .orderBy("campaign_name", "rank_in_campaign")
    )


def wasted_spend(
    fact_terms: DataFrame,
    dim_campaign: DataFrame,
    min_clicks: int = 15,
    limit: int = 50,
) -> DataFrame:
    """Terms with many clicks and no or unprofitable sales: the ``limit`` most expensive ones."""
    terms = _term_performance(fact_terms, dim_campaign, False)
    wasted = terms.where(
        (F.col("clicks") >= min_clicks) & ((F.col("orders") == 0) | (F.col("spend") > F.col("sales")))
    )
    reason = label(
        [
            (F.col("orders") == 0, "no_conversions"),
            (F.col("spend") > F.col("sales"), "unprofitable"),
        ],
        "review",
    )
    return (
        wasted.select(
            reason.alias("waste_reason"),
            "customer_search_term",
            "campaign_name",
            "targeting_type",
            "clicks",
            F.round("spend", 2).alias("spend"),
            F.round("sales", 2).alias("sales"),
            "orders",
            _ratio("spend", "sales", 4).alias("acos"),
        )
        .orderBy(
            F.col("spend").desc_nulls_last(), "customer_search_term", "campaign_name", "targeting_type"
        )
        .limit(limit)
    )


def ads_vs_organic(
    fact_ads: DataFrame,
    business: DataFrame,
    dim_product: DataFrame,
    hi: float = 0.8,
    mid: float = 0.4,
) -> DataFrame:
    """Ad share of each product's sales and a health label.

    ``dim_product`` must have one row per product.
    """
    ads = _sums(
        fact_ads.where(F.col("asin").isNotNull()), ["asin"], {"spend": "spend", "sales_7d": "sales"}
    )
    total = business.groupBy("asin").agg(
        F.sum("ordered_product_sales").alias("total"),
        F.sum("sessions_total").alias("sessions"),
        F.avg("unit_session_pct").alias("conversion"),
    )
    zero = F.lit(0).cast("decimal(18,4)")
    joined = (
        total.where(F.col("total") > 0)
        .join(ads, "asin", "left")
        .join(dim_product.select("asin", "title"), "asin", "left")
        .withColumn("sales", F.coalesce("sales", zero))
        .withColumn("spend", F.coalesce("spend", zero))
        .withColumn("ad_sales_share", _ratio("sales", "total", 4))
    )
    share = F.col("ad_sales_share")
    return joined.select(
        "asin",
        cut("title", 60).alias("title_short"),
        F.round("total", 2).alias("total_sales"),
        F.round("sales", 2).alias("ad_sales"),
        F.round(F.col("total") - F.col("sales"), 2).alias("organic_sales"),
        F.round("spend", 2).alias("ad_spend"),
        "sessions",
        round_to("conversion", 2).alias("avg_conversion_pct"),
        "ad_sales_share",
        _ratio("spend", "total", 4).alias("tacos_asin"),
        label(
            [(share >= hi, "ad_dependent"), (share >= mid, "balanced"), (share > 0, "organic_strong")],
            "no_ads",
        ).alias("health_label"),
    ).orderBy(F.col("total_sales").desc_nulls_last(), "asin")


def daily_trend(
    fact_ads: DataFrame, window: int = 7, tolerance: float = 0.5, by: str | None = None
) -> DataFrame:
    """Daily totals with rolling means over ``window`` rows and an anomaly flag.

    The windows run over one row per day, after the sum, so their size is
    bounded by the calendar. ``by`` gives every account or portfolio its own
    series. Missing days are not filled in.
    """
    keys = [by] if by else []
    daily = _sums(
        fact_ads, [*keys, "date_id"], {"spend": "spend", "sales_7d": "sales", "orders_7d": "orders"}
    )
    if by:
        # Ranges of series serve the windows and the order of the result; sorting windows by ranges of their
        # own would compute them a second time, for Spark's sample of the ranges.
        daily = daily.repartitionByRange(by)
    ordered = Window.partitionBy(*keys).orderBy("date_id")
    frame = ordered.rowsBetween(-(window - 1), 0)
    rolling_spend = F.sum("spend").over(frame)
    rolled = daily.select(
        *keys,
        "date_id",
        F.round("spend", 2).alias("daily_spend"),
        F.round("sales", 2).alias("daily_sales"),
        F.col("orders").alias("daily_orders"),
        _ratio("sales", "spend", 2).alias("daily_roas"),
        round_to(safe_ratio(rolling_spend, F.count("spend").over(frame)), 2).alias("rolling_spend"),
        round_to(safe_ratio(F.sum("sales").over(frame), rolling_spend), 2).alias("rolling_roas"),
        F.lag("spend", window).over(ordered).alias("earlier_spend"),
    )
    deviation = F.abs(F.col("daily_roas") - F.col("rolling_roas")) / F.nullif(
        F.col("rolling_roas"), F.lit(0.0)
    )
    return rolled.select(
        *keys,
        "date_id",
        "daily_spend",
        F.col("rolling_spend").alias("rolling_7d_spend"),
        "daily_sales",
        "daily_orders",
        "daily_roas",
        F.col("rolling_roas").alias("rolling_7d_roas"),
        F.round("earlier_spend", 2).alias("spend_one_week_ago"),
        round_to(
            safe_ratio(F.col("daily_spend") - F.col("earlier_spend"), "earlier_spend"), 4
        ).alias("spend_wow_change"),
        label([(deviation > tolerance, "roas_anomaly")]).alias("anomaly_flag"),
    ).orderBy(*keys, "date_id")
