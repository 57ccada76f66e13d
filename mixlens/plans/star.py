"""The two star schemas, built from staged reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from mixlens.operators.dimensions import (
    dim_campaign_dedup,
    dim_campaign_entity,
    dim_date_observed,
    dim_product_dedup,
    dim_product_outer,
)
from mixlens.operators.facts import (
    SNAPSHOT_DATE,
    channel_spend_long,
    fact_ads_by_id,
    fact_ads_by_name,
    fact_business,
    fact_business_snapshot,
    fact_terms_by_id,
    fact_terms_by_name,
    mmm_weekly,
    weekly_channel,
)


def star_by_id(
    bulk: DataFrame,
    ads: DataFrame,
    terms: DataFrame,
    business: DataFrame,
    snapshot_date: str = SNAPSHOT_DATE,
    lookup: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The id-keyed warehouse: six tables, ready for ``load_warehouse``.

    ``lookup`` is the ``campaign_lookup`` of the bulk file, if it was written before.
    """
    return {
        "dim_date": dim_date_observed((ads, "start_date"), (terms, "start_date")),
        "dim_campaign": dim_campaign_entity(bulk),
        "dim_product": dim_product_outer(ads, business),
        "fact_ads_daily": fact_ads_by_id(ads, bulk, lookup=lookup),
        "fact_search_term": fact_terms_by_id(terms, bulk, lookup=lookup),
        "fact_business_report": fact_business_snapshot(business, snapshot_date),
    }


def marts_by_name(
    bulk: DataFrame,
    ads: DataFrame,
    terms: DataFrame,
    business: DataFrame,
    dim_date: DataFrame,
    table: Callable[[str, DataFrame], DataFrame] = lambda _name, df: df,
) -> dict[str, DataFrame]:
    """The name-keyed marts the declared checks are about.

    All are views unless ``table`` writes one and returns what was written, which
    pays for marts that several readers share.
    """
    ads_daily = table("fact_ads_daily", fact_ads_by_name(ads))
    campaigns = table("dim_campaign", dim_campaign_dedup(bulk))
    return {
        "dim_date": dim_date,
        "dim_campaign": campaigns,
        "dim_product": table("dim_product", dim_product_dedup(bulk)),
        "fact_ads_daily": ads_daily,
        "fact_search_term": table("fact_search_term", fact_terms_by_name(terms)),
        "fact_business_report": table("fact_business_report", fact_business(business)),
        "fact_weekly_channel_performance": weekly_channel(ads_daily, campaigns),
    }


def mix_marts(staged: DataFrame) -> dict[str, DataFrame]:
    """The weekly mix marts from staged weekly data."""
    return {
        "fct_mmm_weekly": mmm_weekly(staged),
        "fct_mmm_channel_spend_weekly": channel_spend_long(staged),
    }
