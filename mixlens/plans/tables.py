"""The four reports and the weekly series, derived from the given tables.

Line items stand for ad rows: suppliers are campaigns, parts are products and
search terms, regions are portfolios. Every table is used whole; rows that
should lack something (a product id, a campaign row) lack it by value, not by
being left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlens.operators.dimensions import keep_first
from mixlens.operators.facts import weekly_series
from mixlens.sources.reports import stage_ads, stage_bulk, stage_business, stage_mmm, stage_terms


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _padded(key: str, digits: int) -> str:
    """The key with leading zeros; longer keys keep all their digits."""
    text = f"cast({key} as string)"
    return f"lpad({text}, greatest({digits}, length({text})), '0')"


def product_id(key: str) -> str:
    return f"concat('B0', {_padded(key, 8)})"


def campaign_name(key: str) -> str:
    return f"concat('Supplier#', {_padded(key, 9)})"


# What a line item means as an ad row. Open lines were only shown; returned ones brought no sales.
_CLOSED = "l_linestatus = 'F'"
_SOLD = "l_linestatus = 'F' and l_returnflag <> 'R'"
AD_VALUES = {
    "day": "cast(l_shipdate as date)",
    "campaign": campaign_name("l_suppkey"),
    "product": f"case when l_partkey % 7 = 0 then null else {product_id('l_partkey')} end",
    "impressions": "cast(l_quantity * 1000 as bigint)",
    "clicks": f"case when {_CLOSED} then cast(l_quantity as bigint) else 0 end",
    "spend": f"case when {_CLOSED} then cast(l_extendedprice * l_discount as decimal(18,4)) else 0 end",
    "sales": (
        f"case when {_SOLD} then cast(l_extendedprice * "
        "(case when l_partkey % 11 = 0 then 0.3D else 0.1D end) as decimal(18,4)) else 0 end"
    ),
    "orders": f"case when {_SOLD} then 1L else 0L end",
    "units": f"case when {_SOLD} then cast(l_quantity as bigint) else 0L end",
}


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(expression).alias(name) for name, expression in columns.items()])


def raw_bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk file: a row per supplier (campaign or ad group) and a row per part (ads, keywords, targets)."""
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    none = "cast(null as string)"
    campaigns = {
        "Product": (
            "case s_suppkey % 4 when 0 then 'Sponsored Products' when 1 then 'Sponsored Brands' "
            "when 2 then 'Sponsored Display' end"
        ),
        "Entity": "case when s_suppkey % 10 = 9 then 'Ad Group' else 'Campaign' end",
        "Campaign ID": "concat('C', s_suppkey)",
        "Ad Group ID": "concat('AG', s_nationkey)",
        "Portfolio ID": "concat('P', r_regionkey)",
        "Ad ID": none,
        "Keyword ID": none,
        "Product Targeting ID": none,
        "Campaign Name": "s_name",
        "Ad Group Name": "n_name",
        "Targeting Type": "case when s_suppkey % 2 = 0 then 'AUTO' else 'MANUAL' end",
        "State": "case when s_acctbal < 0 then 'paused' else 'enabled' end",
        "Daily Budget": "cast(cast(s_acctbal as decimal(18,2)) as string)",
        "SKU": none,
        "ASIN (Informational only)": none,
        "Ad Group Default Bid": none,
        "Bid": none,
        "Keyword Text": none,
        "Match Type": none,
        "Bidding Strategy": "case when s_acctbal > 5000 then 'Dynamic bids' else 'Fixed bid' end",
        "Placement": none,
        "Percentage": none,
        "Product Targeting Expression": none,
        "Impressions": none,
        "Clicks": none,
        "Click-through Rate": none,
        "Spend": none,
        "Sales": none,
        "Orders": none,
        "Units": none,
        "Conversion Rate": none,
        "ACOS": none,
        "CPC": none,
        "ROAS": none,
        "Portfolio Name (Informational only)": "r_name",
        "ingest_seq": "s_suppkey",
    }
    products = {
        **{header: none for header in campaigns},
        "Product": "'Sponsored Products'",
        "Entity": (
            "case p_partkey % 3 when 0 then 'Product Ad' when 1 then 'Keyword' else 'Product Targeting' end"
        ),
        "Campaign ID": "concat('C', p_size)",
        "Ad Group ID": "concat('AG', p_size)",
        "Ad ID": "case when p_partkey % 3 = 0 then concat('A', p_partkey) end",
        "Keyword ID": "case when p_partkey % 3 = 1 then concat('K', p_partkey) end",
        "Product Targeting ID": "case when p_partkey % 3 = 2 then concat('T', p_partkey) end",
        "Campaign Name": f"case when p_partkey % 3 = 1 then {campaign_name('p_size')} end",
        "Ad Group Name": "p_brand",
        "State": "'enabled'",
        "SKU": "p_name",
        "ASIN (Informational only)": (
            f"case when p_partkey % 5 = 0 then null else {product_id('p_partkey')} end"
        ),
        "Bid": "cast(cast(p_retailprice as decimal(18,2)) as string)",
        "Keyword Text": "p_type",
        "Match Type": "'BROAD'",
        "Product Targeting Expression": f"concat('asin=', {product_id('p_partkey')}, ' x', {product_id('p_partkey')})",
        "Impressions": "cast(p_size * 1000 as string)",
        "ingest_seq": "1000000000000 + p_partkey",
    }
    return _select(suppliers, campaigns).unionByName(_select(table(spark, sf_dir, "part"), products))


def _performance() -> dict[str, str]:
    v = AD_VALUES
    return {
        "Impressions": v["impressions"],
        "Clicks": v["clicks"],
        "Click-Thru Rate (CTR)": "cast(l_tax as double)",
        "Cost Per Click (CPC)": "cast(l_discount as decimal(18,4))",
        "Spend": v["spend"],
        "7 Day Total Sales ": v["sales"],
        "Total Advertising Cost of Sales (ACOS) ": "cast(null as double)",
        "Total Return on Advertising Spend (ROAS)": "cast(null as double)",
        "7 Day Total Orders (#)": v["orders"],
        "7 Day Total Units (#)": v["units"],
        "7 Day Conversion Rate": "cast(null as double)",
    }


def _place() -> dict[str, str]:
    v = AD_VALUES
    return {
        "Start Date": v["day"],
        "End Date": v["day"],
        "Portfolio name": "cast(null as string)",
        "Campaign Name": v["campaign"],
        "Ad Group Name": "concat('AG', l_linenumber)",
    }


def raw_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advertised-product report: one row per line item."""
    own = f"case when l_tax > 0.04 then {AD_VALUES['sales']} else 0 end"
    other = f"case when l_tax > 0.04 then 0 else {AD_VALUES['sales']} end"
    columns = {
        **_place(),
        "Country": "'US'",
        "Advertised SKU": "concat('SKU-', l_partkey)",
        "Advertised ASIN": AD_VALUES["product"],
        **_performance(),
        "7 Day Advertised SKU Sales ": own,
        "7 Day Other SKU Sales ": other,
    }
    return _select(table(spark, sf_dir, "lineitem"), columns)


def raw_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-term report: one row per line item, the part's name as the term."""
    columns = {
        **_place(),
        "Targeting": "p_brand",
        "Match Type": (
            "case l_linenumber % 4 when 0 then 'BROAD' when 1 then 'PHRASE' when 2 then 'EXACT' else '-' end"
        ),
        "Customer Search Term": "p_name",
        **_performance(),
    }
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return _select(lines.join(parts, F.col("l_partkey") == F.col("p_partkey")), columns)


def raw_business(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business report: one row per part, amounts and percentages as display strings."""
    per_part = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(
            F.sum(F.expr("cast(l_extendedprice * 0.1D as decimal(18,4))")).alias("sales"),
            F.sum(F.expr("cast(l_quantity as bigint)")).alias("qty"),
            F.sum(F.expr("cast(l_tax as decimal(18,4))")).alias("tax"),
            F.count(F.lit(1)).alias("items"),
        )
    )
    columns = {
        "(Parent) ASIN": f"case when p_size = 13 then null else {product_id('p_partkey')} end",
        "Title": "p_name",
        "Sessions - Total": "cast(qty * 3 as string)",
        "Session Percentage - Total": "concat(p_size, '%')",
        "Page Views - Total": "cast(qty * 5 as string)",
        "Page Views Percentage - Total": "concat(p_size, '.5%')",
        "Featured Offer (Buy Box) Percentage": "case when p_size % 2 = 0 then concat(p_size, '.25%') else 'n/a' end",
        "Units Ordered": "cast(qty as string)",
        "Unit Session Percentage": (
            "concat(cast(cast(round(cast(cast(tax as double) * 100 / items as decimal(38,9)), 2) "
            "as decimal(18,2)) as string), '%')"
        ),
        "Ordered Product Sales": "concat('$', format_number(round(sales, 2), 2))",
        "Total Order Items": "cast(items as string)",
    }
    parts = table(spark, sf_dir, "part")
    return _select(per_part.join(parts, F.col("l_partkey") == F.col("p_partkey")), columns)


def bulk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_bulk(raw_bulk(spark, sf_dir), optional=True)


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_ads(raw_ads(spark, sf_dir), optional=True)


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_terms(raw_terms(spark, sf_dir))


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_business(raw_business(spark, sf_dir))


def weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly mix data per region, from all line items."""
    v = AD_VALUES
    daily = _select(
        table(spark, sf_dir, "lineitem"),
        {
            "date_id": v["day"],
            "campaign_name": v["campaign"],
            "spend": v["spend"],
            "impressions": v["impressions"],
            "clicks": v["clicks"],
            "ad_sales": v["sales"],
            "ad_orders": v["orders"],
            "total_sales": "cast(l_extendedprice * 0.2D as decimal(18,4))",
        },
    )
    campaigns = bulk(spark, sf_dir).where(F.col("entity") == "Campaign")
    channel_of = keep_first(campaigns, ["campaign_name"], [F.col("ingest_seq").asc()]).select(
        "campaign_name", F.col("product").alias("ad_product"), F.col("portfolio_name").alias("region")
    )
    channels = [
        ("Sponsored Products", "spend_sp"),
        ("Sponsored Brands", "spend_sb"),
        ("Sponsored Display", "spend_dsp"),
    ]
    return weekly_series(daily, channel_of, "region", "total_sales", channels)


def weekly_staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_mmm(weekly(spark, sf_dir), keys=("series",))
