"""The whole way from raw reports to answers, step by step.

Every step reads what the one before wrote, so a step can be run again by
itself, and a table is computed once however many questions use it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from mixlens.operators import anonymize as anon
from mixlens.operators import mix, mix_budget, mix_model
from mixlens.operators import performance as perf
from mixlens.operators.dimensions import campaign_lookup
from mixlens.operators.facts import SNAPSHOT_DATE, allocate_snapshot, weekly_actuals
from mixlens.plans.star import star_by_id
from mixlens.sources import reports as rep
from mixlens.sources import warehouse as wh

Terms = Sequence[tuple[str, str]]

# The folder name starts with "_", so it isn't taken for a table.
LOOKUP_FOLDER = "_campaign_lookup"

_ANONYMIZERS: dict[str, Callable[[DataFrame, Terms], DataFrame]] = {
    "bulk_campaigns": anon.anonymize_bulk,
    "advertised_products": anon.anonymize_ads,
    "search_terms": anon.anonymize_terms,
    "business_report": anon.anonymize_business,
}


def anonymize_reports(
    spark: SparkSession, landing: str, processed: str, terms: Terms = (), fmt: str = "csv"
) -> None:
    """Anonymise the four reports of a landing folder into a folder of processed reports."""
    for name, scrub in _ANONYMIZERS.items():
        raw = rep.read_source(spark, name, landing, fmt)
        wh.write_report(scrub(raw, terms), f"{processed.rstrip('/')}/{rep.SOURCES[name]}", fmt)


def build_warehouse(
    spark: SparkSession,
    processed: str,
    warehouse: str,
    snapshot_date: str = SNAPSHOT_DATE,
    fmt: str = "csv",
    partitions: Mapping[str, str] = wh.PARTITIONS,
) -> dict[str, DataFrame]:
    """Build the id-keyed star schema from processed reports and return the written tables.

    The lookup of campaigns is written first, below the warehouse: both facts
    read it, and Spark knows the size of files and so needn't shuffle the facts'
    rows to find out that it can be broadcast.
    """
    reports = {name: rep.read_source(spark, name, processed, fmt) for name in rep.REPORTS}
    bulk = rep.stage_bulk(reports["bulk_campaigns"], optional=True)
    lookup = f"{warehouse.rstrip('/')}/{LOOKUP_FOLDER}"
    campaign_lookup(bulk).write.mode("overwrite").parquet(lookup)
    tables = star_by_id(
        bulk,
        rep.stage_ads(reports["advertised_products"], optional=True),
        rep.stage_terms(reports["search_terms"]),
        rep.stage_business(reports["business_report"]),
        snapshot_date,
        spark.read.parquet(lookup),
    )
    # CSV is parsed whole for every slice; of Parquet only the columns that a fact needs are read.
    wh.load_warehouse(tables, warehouse, partitions, {} if fmt == "csv" else wh.SLICED)
    return wh.read_warehouse(spark, warehouse)


def publish_views(tables: Mapping[str, DataFrame]) -> None:
    """Make the tables known by name, for SQL of one's own with ``spark.sql``."""
    for name, df in tables.items():
        wh.materialize(name, df)


def standing_questions(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The five questions over the warehouse tables."""
    ads, terms = tables["fact_ads_daily"], tables["fact_search_term"]
    business, campaigns = tables["fact_business_report"], tables["dim_campaign"]
    return {
        "campaign_roas_tacos": perf.campaign_roas_tacos(ads, campaigns, business),
        "harvestable_terms": perf.harvestable_terms(terms, campaigns),
        "wasted_spend": perf.wasted_spend(terms, campaigns),
        "ads_vs_organic": perf.ads_vs_organic(ads, business, tables["dim_product"]),
        "daily_trend": perf.daily_trend(ads),
    }


def extract_actuals(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Weekly actuals of the warehouse with the spread business total."""
    weekly = weekly_actuals(tables["fact_ads_daily"], tables["dim_date"], tables["dim_campaign"])
    return allocate_snapshot(weekly, tables["fact_business_report"])


def fit_mix(weekly: DataFrame, channels: Sequence[mix.Channel] = mix.CHANNELS) -> dict[str, DataFrame]:
    """Model, decomposition, curves and budget of written weekly data with a ``series`` column."""
    features = mix.season_features(mix.transform_channels(weekly, channels))
    model = mix_model.fit_ols(features, mix_model.model_features(channels))
    parts = mix_model.decompose(features, model, channels)
    predicted = mix_model.predict(features, model, mix_model.model_features(channels))
    optimum = mix_budget.optimize_budget(model, weekly, channels)
    return {
        "model": model,
        "metrics": mix_model.fit_metrics(predicted),
        "decomposition": parts,
        "shares": mix_model.contribution_shares(parts, channels),
        "curves": mix_model.response_curve(model, weekly, channels),
        "marginal_returns": mix_model.marginal_return(model, weekly, channels),
        "budget": mix_budget.allocation_report(optimum, model, weekly, channels),
    }
