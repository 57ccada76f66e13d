from __future__ import annotations

import datetime as dt
from decimal import Decimal

from support import rows

from mixlens.operators import dimensions as dims
from mixlens.operators import facts

BULK = (
    "entity string, campaign_id string, campaign_name string, portfolio_id string, portfolio_name string, product string, "
    "targeting_type string, state string, daily_budget string, bidding_strategy string, sku string, asin string, ingest_seq bigint"
)


def bulk(spark):
    def row(entity, cid, name, seq, budget="1.5", product="SP", sku=None, asin=None):
        return (entity, cid, name, None, "P", product, "AUTO", "enabled", budget, "fixed", sku, asin, seq)

    return spark.createDataFrame(
        [
            row("Keyword", "c1", None, 1),
            row("Campaign", "c1", "One", 2, "12.50"),
            row("Campaign", "c1", "One again", 3),
            row("Campaign", "c2", "Two", 5, "x"),
            row("Campaign", "c3", "Two", 4),
            row("Campaign", None, "No id", 6),
            row("Campaign", "c5", None, 8),
            row("Product Ad", "c4", "Four", 7, None, None, "s1", None),
            row("Product Ad", "c4", "Four", 9, None, None, "s1", "a1"),
            row("Product Ad", "c4", "Four", 10, None, None, "s2", None),
        ],
        BULK,
    )


def test_campaigns_from_campaign_rows(spark):
    got = rows(dims.dim_campaign_entity(bulk(spark)).select("campaign_id", "campaign_name", "daily_budget"), "campaign_id")
    assert got == [("c1", "One", Decimal("12.5")), ("c2", "Two", None), ("c3", "Two", Decimal("1.5")), ("c5", None, Decimal("1.5"))]


def test_campaigns_from_all_rows_prefer_a_name(spark):
    got = rows(dims.dim_campaign_dedup(bulk(spark)).select("campaign_id", "campaign_name"), "campaign_id")
    assert got == [("c1", "One"), ("c2", "Two"), ("c3", "Two"), ("c4", "Four"), ("c5", None)]


def test_products_and_lookup(spark):
    assert rows(dims.dim_product_dedup(bulk(spark)), "sku") == [("s1", "a1"), ("s2", None)]
    assert rows(dims.campaign_lookup(bulk(spark)), "campaign_name") == [("No id", None), ("One", "c1"), ("One again", "c1"), ("Two", "c3")]


def test_observed_dates(spark):
    a = spark.createDataFrame([("2024-12-30",), ("bad",), (None,), ("2025-02-01",)], "d string")
    b = spark.createDataFrame([("2025-02-01 09:00:00",)], "d string")
    got = rows(dims.dim_date_observed((a, "d"), (b, "d")), "date_id")
    assert got == [
        (dt.date(2024, 12, 30), 2024, 12, 1, 1, 0, 2025),
        (dt.date(2025, 2, 1), 2025, 2, 5, 6, 1, 2025),
    ]


def test_date_spine_leaves_out_its_end(spark):
    spine = dims.dim_date_spine(spark, "2025-01-01", "2026-12-31")
    got = rows(spine, "date_id")
    assert len(got) == 729 and got[0][:2] == (dt.date(2025, 1, 1),) * 2 and got[-1][0] == dt.date(2026, 12, 30)
    assert dims.dim_date_spine(spark, "2025-01-01", "2025-01-01").count() == 0


ADS = (
    "start_date string, campaign_name string, advertised_asin string, advertised_sku string, impressions string, clicks string, "
    "spend string, total_sales_7d string, total_orders_7d string, total_units_7d string, advertised_sku_sales_7d string, other_sku_sales_7d string"
)


def ads(spark):
    def row(day, name, asin, sku, impressions="10", clicks="1", spend="2.5", sales="5", orders="1"):
        return (day, name, asin, sku, impressions, clicks, spend, sales, orders, "1", "1", "2")

    return spark.createDataFrame(
        [
            row("2025-02-01", "One", "a1", "s1", impressions="12.9"),
            row("2025-02-01", "One", "a1", "s1", clicks="abc", spend="0.25"),
            row("2025-02-01", "One", "a1", "s2"),
            row("2025-02-01", "One", None, "s1"),
            row("2025-02-02", "Two", "a2", "s3"),
            row("2025-02-02", "Unknown", "a2", "s3", spend="100"),
            row("bad", "One", "a1", "s1"),
            row("2025-02-02", None, "a9", "s9"),
        ],
        ADS,
    )


def test_ads_by_id(spark):
    fact = facts.fact_ads_by_id(ads(spark), bulk(spark))
    got = rows(fact.select("date_id", "campaign_id", "asin", "sku", "impressions", "clicks", "spend", "orders_7d"), "date_id", "campaign_id", "asin", "sku")
    d1, d2 = dt.date(2025, 2, 1), dt.date(2025, 2, 2)
    assert got == [
        (None, "c1", "a1", "s1", 10, 1, Decimal("2.5"), 1),
        (d1, "c1", None, "s1", 10, 1, Decimal("2.5"), 1),
        (d1, "c1", "a1", "s1", 22, 1, Decimal("2.75"), 2),
        (d1, "c1", "a1", "s2", 10, 1, Decimal("2.5"), 1),
        (d2, "c3", "a2", "s3", 10, 1, Decimal("2.5"), 1),
    ]
    by_product = facts.ads_by_product(fact).where("asin = 'a1' and date_id is not null")
    assert rows(by_product.select("impressions", "spend")) == [(32, Decimal("5.25"))]


def test_null_safe_lookup(spark):
    fact = facts.fact_ads_by_id(ads(spark), bulk(spark), null_safe=True)
    assert rows(fact.where("asin = 'a9'").select("campaign_id")) == [("c5",)]


def test_ads_by_name_keeps_unknown_campaigns(spark):
    fact = facts.fact_ads_by_name(ads(spark))
    assert fact.where("campaign_name = 'Unknown'").count() == 1
    assert fact.where("date_id is null or asin is null").count() == 0
    abc = spark.createDataFrame([("2025-02-01", "n", "a", "s", "x", None, None, "1", "1", "1", None, None)], ADS)
    assert rows(facts.fact_ads_by_name(abc).select("impressions", "clicks", "spend", "sales")) == [(None, None, None, 1)]


def test_weekly_channel_counts_each_name_once(spark):
    fact, campaigns = facts.fact_ads_by_name(ads(spark)), dims.dim_campaign_dedup(bulk(spark))
    once = rows(facts.weekly_channel(fact, campaigns).select("week", "ad_product", "total_spend"), "week", "ad_product")
    both = facts.weekly_channel(fact, campaigns, unique_names=False)
    assert once == [
        (dt.date(2025, 1, 26), "SP", Decimal("5.25")),
        (dt.date(2025, 2, 2), "SP", Decimal("2.5")),
        (dt.date(2025, 2, 2), "unknown", Decimal("102.5")),
    ]
    assert both.where("week = '2025-02-02' and ad_product = 'SP'").first()["total_spend"] == 5
    total = fact.agg({"spend": "sum"}).first()[0]
    assert sum(r[2] for r in once) == total


def test_business_snapshot(spark):
    raw = spark.createDataFrame(
        [("a1", "T", "10", None, "12", None, "45.2%", "3", "7.5%", "$1,234.50", "2"), (None, "T", *["1"] * 9), ("a2", None, *[None] * 9)],
        "parent_asin string, product_title string, sessions_total string, session_pct_total string, page_views_total string, "
        "page_views_pct_total string, buy_box_pct string, units_ordered string, unit_session_pct string, ordered_product_sales string, total_order_items string",
    )
    day = dt.date(2025, 3, 11)
    assert rows(facts.fact_business_snapshot(raw), "asin") == [
        (day, "a1", 10, 12, 45.2, 3, 7.5, Decimal("1234.5"), 2),
        (day, "a2", 0, 0, None, 0, None, Decimal(0), 0),
    ]
    assert facts.fact_business(raw).columns[-2:] == ["sales", "orders"] and facts.fact_business(raw).count() == 2


def test_outer_products(spark):
    business = spark.createDataFrame([("a1", "Z"), ("a1", "Y"), ("a7", None), (None, "N")], "parent_asin string, product_title string")
    got = rows(dims.dim_product_outer(ads(spark), business), "asin")
    assert got == [("a1", "s1", "Y"), ("a2", "s3", None), ("a7", None, None), ("a9", "s9", None)]


def test_product_bridge(spark):
    family = spark.createDataFrame([("k1", "p2"), ("k1", "p1"), ("k2", None), (None, "p1")], "child_asin string, parent_asin string")
    bridge = dims.dim_product_bridge(family)
    assert rows(bridge) == [("k1", "p1")]
    fact = spark.createDataFrame([("k1", 1), ("k2", 2), (None, 3)], "asin string, n int")
    assert rows(dims.to_parent_asin(fact, bridge), "n") == [("p1", 1), ("k2", 2), (None, 3)]


def test_channel_spend_keeps_totals(spark):
    weekly = spark.createDataFrame([(dt.date(2025, 1, 6), 1.0, 2.0, 4.0), (dt.date(2025, 1, 13), None, 1.0, 1.0)], "week_start date, spend_sp double, spend_sb double, spend_dsp double")
    long = facts.channel_spend_long(weekly)
    assert long.count() == 6
    assert rows(long.groupBy("week_start").sum("spend"), "week_start") == [(dt.date(2025, 1, 6), 7.0), (dt.date(2025, 1, 13), 2.0)]


def test_panel_is_national_by_default(spark):
    weekly = spark.createDataFrame([(dt.date(2025, 1, 6), 1.0, 2.0, 4.0, 9.0)], "week_start date, spend_sp double, spend_sb double, spend_dsp double, total_sales double")
    day = dt.date(2025, 1, 6)
    assert rows(facts.mmm_panel(weekly), "channel")[0] == ("national", day, "DSP", 4.0, 4.0)
    assert rows(facts.mmm_panel_kpi(weekly)) == [("national", day, 9.0, 1.0)]


def test_weekly_actuals_and_allocation(spark):
    b = bulk(spark)
    fact = facts.fact_ads_by_id(ads(spark), b)
    weekly = facts.weekly_actuals(fact, dims.dim_date_observed((ads(spark), "start_date")), dims.dim_campaign_entity(b))
    got = rows(weekly.select("year", "week", "spend_auto", "spend_manual", "spend_total", "clicks_total"))
    assert got == [(2025, 5, Decimal("10.25"), 0, Decimal("10.25"), 4)]
    business = spark.createDataFrame([(Decimal("100"),), (Decimal("20"),)], "ordered_product_sales decimal(18,4)")
    spread = facts.allocate_snapshot(weekly, business).first()
    assert spread["organic_sales_est"] == 120 and spread["total_sales_est"] == 120 + float(spread["ad_sales"])
