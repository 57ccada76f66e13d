"""Plans and results under hot keys, without broadcasts and with other partition counts."""

from __future__ import annotations

import contextlib
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from mixlens.operators import dimensions as dims
from mixlens.operators import facts
from mixlens.operators import performance as perf
from mixlens.operators.joins import join_dimension
from mixlens.plans.queries import QUERIES


@contextlib.contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df, final=False):
    if final:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_row_functions(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|ArrowEvalPython", text)
    python = set(re.findall("MapInPandas|FlatMapGroupsInPandas", text))
    assert not python or name.startswith("m")


SENSITIVE = [
    "d3_dim_campaign_entity", "d4_dim_campaign_dedup", "d5_dim_product_outer", "d7_campaign_lookup", "f1_fact_ads_by_id",
    "f7_weekly_channel", "f10_weekly_actuals", "q1_campaign_roas_tacos", "q2_harvestable_terms", "q3_wasted_spend",
    "q4_ads_vs_organic", "q5_daily_trend", "n1_roas_histogram", "m1_adstock", "m10_contribution_shares",
]


@pytest.mark.parametrize("name", SENSITIVE)
def test_results_do_not_depend_on_partitions_or_broadcasts(spark, small, name):
    def result():
        return sorted(map(str, QUERIES[name](spark, small).collect()))

    want = result()
    with settings(spark, spark__sql__shuffle__partitions="1", spark__sql__adaptive__enabled="false"):
        assert result() == want
    with settings(spark, spark__sql__shuffle__partitions="13", spark__sql__autoBroadcastJoinThreshold="-1"):
        assert result() == want


def hot_ads(spark, n=60_000):
    """A third of the rows belong to one campaign."""
    name = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), F.col("id") % 50))
    return spark.range(n).repartition(16).select(
        F.lit(dt.date(2025, 1, 1)).alias("start_date"),
        name.alias("campaign_name"),
        F.concat(F.lit("a"), F.col("id") % 7).alias("advertised_asin"),
        F.sha1(F.col("id").cast("string")).alias("advertised_sku"),
        *[(F.col("id") % 97).alias(c) for c in ("impressions", "clicks", "spend", "total_sales_7d", "total_orders_7d", "total_units_7d")],
    )


def hot_bulk(spark):
    names = ["hot", *[f"n{i}" for i in range(50)]]
    return spark.createDataFrame([("Campaign", f"c{i}", n, i) for i, n in enumerate(names)], "entity string, campaign_id string, campaign_name string, ingest_seq int")


SMALL_SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "16KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "16KB",
}


def test_hot_campaign_is_split_beyond_the_broadcast_limit(spark):
    ads, bulk = hot_ads(spark), hot_bulk(spark)
    small_lookup = facts.fact_ads_by_id(ads, bulk)
    assert "BroadcastHashJoin" in plan(small_lookup, final=True)
    with settings(spark, **SMALL_SKEW):
        shuffled = facts.fact_ads_by_id(ads, bulk)
        assert "skew=true" in plan(shuffled, final=True)
        assert sorted(map(str, shuffled.collect())) == sorted(map(str, small_lookup.collect()))


def test_hot_campaign_with_many_terms_is_split(spark):
    ads = hot_ads(spark)
    terms = ads.select(
        F.lit(dt.date(2025, 1, 1)).alias("date_id"),
        F.when(F.col("campaign_name") == "hot", "c0").otherwise(F.concat(F.lit("c"), F.substring("campaign_name", 2, 9).cast("int") + 1)).alias("campaign_id"),
        F.col("advertised_sku").alias("customer_search_term"),
        F.lit("BROAD").alias("match_type"),
        *[F.col(c).cast("bigint").alias(n) for c, n in (("impressions", "impressions"), ("clicks", "clicks"), ("total_orders_7d", "orders_7d"))],
        *[F.col("spend").cast("decimal(18,4)").alias(n) for n in ("spend", "sales_7d")],
    )
    campaigns = dims.keep_first(
        spark.createDataFrame([(f"c{i}", f"n{i}", "AUTO") for i in range(51)], "campaign_id string, campaign_name string, targeting_type string"),
        ["campaign_id"],
        [F.col("campaign_name")],
    )
    want = sorted(map(str, perf.harvestable_terms(terms, campaigns, max_acos=2).collect()))
    with settings(spark, **SMALL_SKEW):
        split = perf.harvestable_terms(terms, campaigns, max_acos=2)
        assert "skew=true" in plan(split, final=True)
        assert sorted(map(str, split.collect())) == want and len(want) == 51 * 5


def test_small_dimensions_are_broadcast_and_no_job_runs_for_it(spark, tmp_path):
    path = str(tmp_path / "dimension")
    spark.range(5).select(F.col("id").alias("k"), F.lit("x").alias("v")).write.parquet(path)
    rows, dimension = spark.range(100).select((F.col("id") % 5).alias("k")), spark.read.parquet(path)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "")
    joined = join_dimension(rows, dimension, "k")
    assert "BroadcastHashJoin" in plan(joined) and not tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("other", "")
    assert joined.count() == 100


def below_exchange(text, node):
    """Whether ``node`` stands below an exchange, so before the shuffle."""
    lines = text.splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    return any(node in line for line in lines[exchange + 1 :])


def test_first_rows_are_limited_before_the_shuffle(spark):
    bulk = hot_bulk(spark)
    text = plan(dims.campaign_lookup(bulk))
    assert below_exchange(text, "WindowGroupLimit") and text.count("WindowGroupLimit") == 2


def test_ranked_terms_are_limited_before_the_shuffle(spark):
    terms = spark.createDataFrame([], "campaign_id string, customer_search_term string, match_type string, impressions bigint, clicks bigint, spend decimal(18,4), sales_7d decimal(18,4), orders_7d bigint")
    campaigns = spark.createDataFrame([], "campaign_id string, campaign_name string, targeting_type string")
    assert "WindowGroupLimit" in plan(perf.harvestable_terms(terms, campaigns))


def test_windows_of_a_trend_are_computed_once(spark, small):
    text = plan(QUERIES["q5_daily_trend_by_campaign"](spark, small))
    # What is above an exchange by range is not computed for the sample of its ranges.
    assert text.count("rangepartitioning") == 1 and text.index("Window") < text.index("rangepartitioning")
    rows = [(r["campaign_id"], r["date_id"]) for r in QUERIES["q5_daily_trend_by_campaign"](spark, small).collect()]
    assert rows == sorted(rows) and len(rows) > 100


def test_sums_are_combined_before_the_shuffle_and_before_the_join(spark):
    fact = facts.fact_ads_by_id(hot_ads(spark), hot_bulk(spark))
    text = plan(perf.campaign_roas_tacos(
        fact,
        spark.createDataFrame([], "campaign_id string, campaign_name string, portfolio_name string, targeting_type string"),
        spark.createDataFrame([], "ordered_product_sales decimal(18,4)"),
    ))
    join = min(i for i in (text.find("SortMergeJoin"), text.find("HashJoin")) if i >= 0)
    assert re.search(r"HashAggregate\(keys=\[campaign_id#\d+\], functions=\[partial_sum", text[join:])


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "ads")
    hot_ads(spark, 100).withColumn("unused", F.lit(1)).write.parquet(path)
    text = plan(facts.fact_ads_by_name(spark.read.parquet(path)).select("date_id", "spend"))
    assert "IsNotNull(start_date)" in text and "IsNotNull(advertised_asin)" in text
    schema = re.search(r"ReadSchema: struct<(.*)", text).group(1)
    assert "unused" not in schema and "clicks" not in schema and "spend" in schema


def test_a_refresh_reads_recent_events_only(spark, small):
    from mixlens.plans.tables import table
    from mixlens.streaming.daily import daily_from_events, events_since

    text = plan(daily_from_events(events_since(table(spark, small, "events"), "2024-01-28", 3)))
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(ts,2024-01-25", text)


def test_each_report_is_scanned_once(spark, small):
    assert plan(QUERIES["q4_ads_vs_organic"](spark, small)).count("lineitem.parquet") <= 2
    assert plan(QUERIES["t1_t4_mart_checks"](spark, small)).count("lineitem.parquet") == 0


def test_marts_of_several_checks_are_made_once_and_hold_what_checks_read(spark, small):
    text = plan(QUERIES["t1_t4_mart_checks"](spark, small))
    assert "sum(spend" not in text
    for path in set(re.findall(r"file:[^\],]*mixlens-fact_search_term-[0-9a-f]+", text)):
        assert spark.read.parquet(path).columns == ["date_id", "campaign_name", "customer_search_term"]


def test_executors_do_not_need_the_package(small, tmp_path):
    """A driver that only extends its own path, in another folder: workers cannot import the package."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as e
from mixlens.session import build_session
spark = build_session(master="local[2]", conf={{"spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": {str(tmp_path)!r}}})
for name in ("m5_fit_ols", "m14_optimize_budget", "m20_grid_search", "m22_roi_intervals"):
    print(name, len(e.queries()[name](spark, {small!r}).collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and done.stdout.count("m") >= 4, done.stderr[-2000:]
