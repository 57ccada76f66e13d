from __future__ import annotations

import pytest

from mixlens.plans import runs
from mixlens.plans import tables as t
from mixlens.sources import reports as rep
from mixlens.sources import warehouse as wh


@pytest.fixture(scope="module")
def warehouse(spark, small, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    landing, processed = str(root / "landing"), str(root / "processed")
    raw = {"bulk_campaigns": t.raw_bulk, "advertised_products": t.raw_ads, "search_terms": t.raw_terms, "business_report": t.raw_business}
    for name, make in raw.items():
        wh.write_report(make(spark, small), f"{landing}/{rep.SOURCES[name]}")
    runs.anonymize_reports(spark, landing, processed, [("supplier", "Brand_A"), ("ring", "Brand_B")])
    return runs.build_warehouse(spark, processed, str(root / "warehouse"), partitions={})


def test_names_are_hidden_everywhere(warehouse):
    campaigns, products, terms = warehouse["dim_campaign"], warehouse["dim_product"], warehouse["fact_search_term"]
    assert campaigns.where("lower(campaign_name) like '%supplier%'").count() == 0
    assert terms.where("customer_search_term like '%ring%'").count() == 0
    assert products.where("asin not like 'ASIN\\_%'").count() == 0
    assert campaigns.where("campaign_id not like 'Campaign_ID\\_%'").count() == 0


def test_anonymised_reports_give_the_same_numbers(spark, small, warehouse):
    from mixlens.plans.queries import QUERIES

    asked = runs.standing_questions(warehouse)
    plain = QUERIES["q1_campaign_roas_tacos"](spark, small).drop("campaign_name").toPandas()
    masked = asked["campaign_roas_tacos"].drop("campaign_name").toPandas()
    columns = ["spend", "ad_sales", "orders", "roas", "acos", "tacos"]
    assert sorted(plain[columns].astype(float).itertuples(index=False)) == sorted(masked[columns].astype(float).itertuples(index=False))
    assert asked["ads_vs_organic"].count() == QUERIES["q4_ads_vs_organic"](spark, small).count()
    assert asked["wasted_spend"].count() == 50 and asked["daily_trend"].count() > 0 and asked["harvestable_terms"].count() > 0


def test_views_and_actuals(spark, warehouse):
    runs.publish_views(warehouse)
    total = spark.sql("select cast(sum(spend) as double) from fact_ads_daily").first()[0]
    weekly = runs.extract_actuals(warehouse)
    assert abs(float(weekly.agg({"spend_total": "sum"}).first()[0]) - total) < 1e-6
    assert set(weekly.columns) >= {"organic_sales_est", "total_sales_est"}


def test_sources_by_name(spark, tmp_path):
    spark.range(1).selectExpr("'baseline' as param", "8000 as value", "'x' as description").write.option("header", True).csv(str(tmp_path / "true_parameters"))
    assert rep.read_source(spark, "true_parameters", str(tmp_path)).dtypes[1] == ("value", "double")
    with pytest.raises(ValueError):
        rep.read_source(spark, "other", str(tmp_path))


def test_fit_mix_has_every_result(spark):
    import os

    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("the tables are not here")
    weekly = t.weekly(spark, "/root/testdata/sf0.01").cache()
    results = runs.fit_mix(weekly)
    assert results["model"].where("status = 'ok'").count() == 5
    assert results["budget"].count() == 15 and results["curves"].count() == 4500 and results["metrics"].count() == 5


def test_rows_of_facts_are_not_shuffled_to_find_campaigns(spark, small, tmp_path, monkeypatch):
    """The written lookup's size is known, so the join with campaigns needs no shuffle of the facts' rows."""
    landing, plans = str(tmp_path / "landing"), {}
    raw = {"bulk_campaigns": t.raw_bulk, "advertised_products": t.raw_ads, "search_terms": t.raw_terms, "business_report": t.raw_business}
    for name, make in raw.items():
        wh.write_report(make(spark, small), f"{landing}/{rep.SOURCES[name]}", "parquet")
    load = wh.load_warehouse

    def planned(tables, *args):
        for name in wh.SLICED:
            plans[name] = tables[name]._jdf.queryExecution().executedPlan().toString()
        return load(tables, *args)

    monkeypatch.setattr(wh, "load_warehouse", planned)
    got = runs.build_warehouse(spark, landing, str(tmp_path / "w"), fmt="parquet", partitions={})
    assert plans["fact_search_term"].count("Exchange hashpartitioning") == 0
    # The one that is left is for the sum.
    assert plans["fact_ads_daily"].count("Exchange hashpartitioning") == 1
    assert got["fact_search_term"].count() > 0
