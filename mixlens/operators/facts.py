"""Facts keyed by campaign id (campaigns outside the bulk file are dropped) and by
campaign name (they are kept), and the weekly marts.

Measures are decimals or whole numbers, so sums do not depend on the order of
rows. Spark chooses every join's kind by the sizes it sees, and can split hot keys
of row-level joins; all other joins see rows that are summed already.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mixlens.functions.cleaning import (
    date_column,
    parse_currency0,
    parse_pct,
    to_long,
    to_long0,
    to_money,
    to_money0,
)
from mixlens.functions.dates import iso_date_parts, week_start_monday, week_start_sunday
from mixlens.operators.dimensions import campaign_lookup, keep_first
from mixlens.operators.joins import join_dimension

# Fixed value: day the business report was taken.
SNAPSHOT_DATE = "2025-03-11"


def _with_campaign_id(
    rows: DataFrame, bulk: DataFrame, null_safe: bool, lookup: DataFrame | None = None
) -> DataFrame:
    """Add the campaign id by name; rows of unknown campaigns disappear.

    ``null_safe`` lets rows without a campaign name match a nameless campaign.
    ``lookup`` is the written ``campaign_lookup`` of the bulk file, where there is one.
    """
    lookup = (campaign_lookup(bulk) if lookup is None else lookup).where(F.col("campaign_id").isNotNull())
    found = join_dimension(rows, lookup, "campaign_name")
    if null_safe:
        nameless = bulk.where((F.col("entity") == "Campaign") & F.col("campaign_name").isNull())
        only_id = nameless.agg(F.min("campaign_id").alias("campaign_id")).scalar()
        unnamed = rows.where(F.col("campaign_name").isNull()).withColumn("campaign_id", only_id)
        found = found.unionByName(unnamed.where(F.col("campaign_id").isNotNull()))
    return found


def fact_ads_by_id(
    ads: DataFrame, bulk: DataFrame, null_safe: bool = False, lookup: DataFrame | None = None
) -> DataFrame:
    """Daily ads fact by (date, campaign, product, sku); null keys form their own groups."""
    extra = {
        c: to_money0(c) if c in ads.columns else to_money0(F.lit(0))
        for c in ("advertised_sku_sales_7d", "other_sku_sales_7d")
    }
    rows = ads.select(
        date_column(ads, "start_date").alias("date_id"),
        "campaign_name",
        F.col("advertised_asin").alias("asin"),
        F.col("advertised_sku").alias("sku"),
        to_long0("impressions").alias("impressions"),
        to_long0("clicks").alias("clicks"),
        to_money0("spend").alias("spend"),
        to_money0("total_sales_7d").alias("sales_7d"),
        to_long0("total_orders_7d").alias("orders_7d"),
        to_long0("total_units_7d").alias("units_7d"),
        *[expr.alias(c) for c, expr in extra.items()],
    )
    measures = rows.columns[4:]
    return (
        _with_campaign_id(rows, bulk, null_safe, lookup)
        .groupBy("date_id", "campaign_id", "asin", "sku")
        .agg(*[F.sum(m).alias(m) for m in measures])
    )


def ads_by_product(fact: DataFrame) -> DataFrame:
    """The daily ads fact one step coarser: (date, campaign, product) over all skus."""
    keys = ["date_id", "campaign_id", "asin"]
    measures = [c for c in fact.columns if c not in (*keys, "sku")]
    return fact.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def fact_terms_by_id(
    terms: DataFrame, bulk: DataFrame, null_safe: bool = False, lookup: DataFrame | None = None
) -> DataFrame:
    """Search-term fact by campaign id, one row per report row."""
    rows = terms.select(
        date_column(terms, "start_date").alias("date_id"),
        "campaign_name",
        "customer_search_term",
        "targeting",
        "match_type",
        to_long0("impressions").alias("impressions"),
        to_long0("clicks").alias("clicks"),
        to_money0("spend").alias("spend"),
        to_money0("total_sales_7d").alias("sales_7d"),
        to_long0("total_orders_7d").alias("orders_7d"),
    )
    return _with_campaign_id(rows, bulk, null_safe, lookup).select(
        "date_id",
        "campaign_id",
        *[c for c in rows.columns if c not in ("date_id", "campaign_name")],
    )


def fact_business_snapshot(business: DataFrame, snapshot_date: str = SNAPSHOT_DATE) -> DataFrame:
    """Business report as of one day; rows without a product are dropped."""
    return business.where(F.col("parent_asin").isNotNull()).select(
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
        F.col("parent_asin").alias("asin"),
        to_long0("sessions_total").alias("sessions_total"),
        to_long0("page_views_total").alias("page_views_total"),
        parse_pct("buy_box_pct").alias("buy_box_pct"),
        to_long0("units_ordered").alias("units_ordered"),
        parse_pct("unit_session_pct").alias("unit_session_pct"),
        parse_currency0("ordered_product_sales").alias("ordered_product_sales"),
        to_long0("total_order_items").alias("total_order_items"),
    )


def _name_keyed_measures() -> list[Column]:
    """Sums that stay null where a group has no readable value."""
    readers = {
        "impressions": to_long("impressions"),
        "clicks": to_long("clicks"),
        "spend": to_money("spend"),
        "sales": to_money("total_sales_7d"),
        "orders": to_long("total_orders_7d"),
        "units": to_long("total_units_7d"),
    }
    return [F.sum(value).alias(name) for name, value in readers.items()]


def fact_ads_by_name(ads: DataFrame) -> DataFrame:
    """Daily ads fact by (date, campaign name, product, sku); rows without date or product are dropped."""
    return (
        ads.where(date_column(ads, "start_date").isNotNull() & F.col("advertised_asin").isNotNull())
        .groupBy(
            date_column(ads, "start_date").alias("date_id"),
            "campaign_name",
            F.col("advertised_asin").alias("asin"),
            F.col("advertised_sku").alias("sku"),
        )
        .agg(*_name_keyed_measures())
    )


def fact_terms_by_name(terms: DataFrame) -> DataFrame:
    """Daily search-term fact by (date, campaign name, term, match type)."""
    return (
        terms.where(date_column(terms, "start_date").isNotNull() & F.col("customer_search_term").isNotNull())
        .groupBy(
            date_column(terms, "start_date").alias("date_id"),
            "campaign_name",
            "customer_search_term",
            "match_type",
        )
        .agg(*_name_keyed_measures())
    )


def fact_business(business: DataFrame) -> DataFrame:
    """Business report rows that have a product."""
    return business.where(F.col("parent_asin").isNotNull()).select(
        "parent_asin",
        "product_title",
        "sessions_total",
        "session_pct_total",
        "page_views_total",
        "page_views_pct_total",
        "buy_box_pct",
        "units_ordered",
        "unit_session_pct",
        F.col("ordered_product_sales").alias("sales"),
        F.col("total_order_items").alias("orders"),
    )


def weekly_channel(ads_by_name: DataFrame, dim_campaign: DataFrame, unique_names: bool = True) -> DataFrame:
    """Weekly totals per ad product, weeks starting on Sunday; unknown campaigns count as ``unknown``.

    Ads are summed per week and campaign before the join, so the join sees few
    rows and no hot campaign. Two campaigns of one name would count its spend
    twice; ``unique_names`` keeps the first of them, ``False`` keeps both.
    """
    measures = ["spend", "sales", "clicks", "orders"]
    weekly = ads_by_name.groupBy(
        week_start_sunday("date_id").alias("week"), "campaign_name"
    ).agg(*[F.sum(m).alias(m) for m in measures])
    campaigns = dim_campaign.where(F.col("campaign_name").isNotNull())
    if unique_names:
        campaigns = keep_first(campaigns, ["campaign_name"], [F.col("campaign_id").asc()])
    return (
        weekly.join(campaigns.select("campaign_name", "ad_product"), "campaign_name", "left")
        .groupBy("week", F.coalesce("ad_product", F.lit("unknown")).alias("ad_product"))
        .agg(*[F.sum(m).alias(f"total_{m}") for m in measures])
    )


def mmm_weekly(staged: DataFrame) -> DataFrame:
    """Weekly totals: the staged mix data as they are."""
    return staged


# Spend columns of the weekly mix data and their channel names.
CHANNEL_LABELS = {"spend_sp": "Sponsored Products", "spend_sb": "Sponsored Brands", "spend_dsp": "DSP"}


def channel_spend_long(staged: DataFrame, keys: Sequence[str] = ("week_start",)) -> DataFrame:
    """One row per week and channel, in one pass over the weekly data."""
    named = staged.select(*keys, *[F.col(c).alias(label) for c, label in CHANNEL_LABELS.items()])
    return named.unpivot(list(keys), list(CHANNEL_LABELS.values()), "channel", "spend")


def weekly_actuals(fact: DataFrame, dim_date: DataFrame, dim_campaign: DataFrame) -> DataFrame:
    """Weekly totals per calendar year and ISO week, spend split by targeting type.

    The fact is summed per day and campaign before it meets the campaigns, and
    per day and targeting type before it meets the calendar.
    """
    measures = ["spend", "impressions", "clicks", "sales_7d", "orders_7d"]
    sums = [F.sum(m).alias(m) for m in measures]
    per_campaign = fact.groupBy("date_id", "campaign_id").agg(*sums)
    per_day = (
        per_campaign.join(dim_campaign.select("campaign_id", "targeting_type"), "campaign_id")
        .groupBy("date_id", F.upper("targeting_type").alias("targeting"))
        .agg(*sums)
    )
    zero = F.lit(0)
    return (
        per_day.join(dim_date.select("date_id", "year", "week"), "date_id")
        .groupBy("year", "week")
        .agg(
            F.sum(F.when(F.col("targeting") == "AUTO", F.col("spend")).otherwise(zero)).alias("spend_auto"),
            F.sum(F.when(F.col("targeting") == "MANUAL", F.col("spend")).otherwise(zero)).alias("spend_manual"),
            F.sum("spend").alias("spend_total"),
            F.sum("impressions").alias("impressions_total"),
            F.sum("clicks").alias("clicks_total"),
            F.sum("sales_7d").alias("ad_sales"),
            F.sum("orders_7d").alias("ad_orders"),
        )
        .orderBy("year", "week")
    )


def allocate_snapshot(weekly: DataFrame, business: DataFrame) -> DataFrame:
    """Spread the snapshot's total sales evenly over the weeks.

    The snapshot holds ad and organic sales together, so ``total_sales_est``
    (ad sales added on top) counts ad sales twice. ``total_sales_alloc`` is the
    spread total by itself.
    """
    total = business.agg(F.sum("ordered_product_sales").cast("double").alias("total")).scalar()
    # The window sees one row per week, so counting here does not compute the fact a second time.
    share = total / F.count(F.lit(1)).over(Window.partitionBy())
    return weekly.select(
        "*",
        share.alias("organic_sales_est"),
        (F.col("ad_sales").cast("double") + share).alias("total_sales_est"),
        share.alias("total_sales_alloc"),
    )


# Channel names of the model panel.
PANEL_CHANNELS = {"spend_sp": "Sponsored_Products", "spend_sb": "Sponsored_Brands", "spend_dsp": "DSP"}


def mmm_panel(weekly: DataFrame, geo_col: str | None = None) -> DataFrame:
    """Media panel (geo, time, channel, media, spend); media is spend as a stand-in for exposure.

    Without ``geo_col`` everything belongs to one geo, ``national``.
    """
    geo = F.col(geo_col) if geo_col else F.lit("national")
    wide = weekly.select(
        geo.alias("geo"),
        F.col("week_start").alias("time"),
        *[F.col(c).alias(name) for c, name in PANEL_CHANNELS.items()],
    )
    long = wide.unpivot(["geo", "time"], list(PANEL_CHANNELS.values()), "channel", "spend")
    return long.select("geo", "time", "channel", F.col("spend").alias("media"), "spend")


def mmm_panel_kpi(weekly: DataFrame, geo_col: str | None = None, kpi: str = "total_sales") -> DataFrame:
    """KPI panel (geo, time, kpi, population)."""
    geo = F.col(geo_col) if geo_col else F.lit("national")
    return weekly.select(
        geo.alias("geo"),
        F.col("week_start").alias("time"),
        F.col(kpi).cast("double").alias("kpi"),
        F.lit(1.0).alias("population"),
    )


def weekly_series(
    ads: DataFrame, channel_of: DataFrame, series: str, total_sales: str, channels: Sequence[tuple[str, str]]
) -> DataFrame:
    """Weekly mix data per series from daily rows and a campaign table.

    ``channel_of`` maps ``campaign_name`` to ``ad_product`` and to the series;
    ``channels`` pairs an ad product with its spend column. Weeks start on
    Monday. Rows are summed per campaign and week before the join.
    """
    measures = ["spend", "impressions", "clicks", "ad_sales", "ad_orders", total_sales]
    weekly = ads.groupBy("campaign_name", week_start_monday("date_id").alias("week_start")).agg(
        *[F.sum(m).alias(m) for m in measures]
    )
    zero = F.lit(0)
    split = [
        F.sum(F.when(F.col("ad_product") == product, F.col("spend")).otherwise(zero)).cast("double").alias(c)
        for product, c in channels
    ]
    summed = (
        weekly.join(channel_of.select("campaign_name", "ad_product", series), "campaign_name")
        .groupBy(F.col(series).alias("series"), "week_start")
        .agg(
            *split,
            F.sum("impressions").alias("impressions_total"),
            F.sum("clicks").alias("clicks_total"),
            F.sum("ad_sales").cast("double").alias("ad_sales"),
            F.sum("ad_orders").alias("ad_orders"),
            F.sum(total_sales).cast("double").alias("total_sales"),
        )
    )
    year, _, week, *_ = iso_date_parts("week_start")
    spend_total = sum((F.col(c) for _, c in channels[1:]), F.col(channels[0][1]))
    return summed.select(
        "series",
        "week_start",
        year,
        week,
        *[c for _, c in channels],
        spend_total.alias("spend_total"),
        "impressions_total",
        "clicks_total",
        "ad_sales",
        "ad_orders",
        "total_sales",
        (F.col("total_sales") - F.col("ad_sales")).alias("organic_sales"),
    )
