"""The four advertising reports and the weekly mix data: reading and staging."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Report:
    """Header-to-column mapping of one report kind; ``optional`` headers may be missing."""

    name: str
    columns: dict[str, str]
    optional: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        """All columns as strings, in report order."""
        headers = [*self.columns, *self.optional]
        return T.StructType([T.StructField(h, T.StringType()) for h in headers])


# Headers of the exported reports and the staged column names.
BULK = Report(
    "bulk_campaigns",
    {
        "Product": "product",
        "Entity": "entity",
        "Campaign ID": "campaign_id",
        "Ad Group ID": "ad_group_id",
        "Portfolio ID": "portfolio_id",
        "Ad ID": "ad_id",
        "Keyword ID": "keyword_id",
        "Product Targeting ID": "product_targeting_id",
        "Campaign Name": "campaign_name",
        "Ad Group Name": "ad_group_name",
        "Targeting Type": "targeting_type",
        "State": "state",
        "Daily Budget": "daily_budget",
        "SKU": "sku",
        "ASIN (Informational only)": "asin",
        "Ad Group Default Bid": "ad_group_default_bid",
        "Bid": "bid",
        "Keyword Text": "keyword_text",
        "Match Type": "match_type",
        "Bidding Strategy": "bidding_strategy",
        "Placement": "placement",
        "Percentage": "percentage",
        "Product Targeting Expression": "product_targeting_expression",
        "Impressions": "impressions",
        "Clicks": "clicks",
        "Click-through Rate": "ctr",
        "Spend": "spend",
        "Sales": "sales",
        "Orders": "orders",
        "Units": "units",
        "Conversion Rate": "conversion_rate",
        "ACOS": "acos",
        "CPC": "cpc",
        "ROAS": "roas",
    },
    {
        "Portfolio Name (Informational only)": "portfolio_name",
        "ingest_seq": "ingest_seq",
    },
)

_PERFORMANCE = {
    "Impressions": "impressions",
    "Clicks": "clicks",
    "Click-Thru Rate (CTR)": "ctr",
    "Cost Per Click (CPC)": "cpc",
    "Spend": "spend",
    "7 Day Total Sales ": "total_sales_7d",
    "Total Advertising Cost of Sales (ACOS) ": "acos",
    "Total Return on Advertising Spend (ROAS)": "roas",
    "7 Day Total Orders (#)": "total_orders_7d",
    "7 Day Total Units (#)": "total_units_7d",
    "7 Day Conversion Rate": "conversion_rate_7d",
}

_PLACE = {
    "Start Date": "start_date",
    "End Date": "end_date",
    "Portfolio name": "portfolio_name",
    "Campaign Name": "campaign_name",
    "Ad Group Name": "ad_group_name",
}

ADS = Report(
    "advertised_products",
    {
        **_PLACE,
        "Country": "country",
        "Advertised SKU": "advertised_sku",
        "Advertised ASIN": "advertised_asin",
        **_PERFORMANCE,
    },
    {
        "7 Day Advertised SKU Sales ": "advertised_sku_sales_7d",
        "7 Day Other SKU Sales ": "other_sku_sales_7d",
    },
)

TERMS = Report(
    "search_terms",
    {
        **_PLACE,
        "Targeting": "targeting",
        "Match Type": "match_type",
        "Customer Search Term": "customer_search_term",
        **_PERFORMANCE,
    },
)

BUSINESS = Report(
    "business_report",
    {
        "(Parent) ASIN": "parent_asin",
        "Title": "product_title",
        "Sessions - Total": "sessions_total",
        "Session Percentage - Total": "session_pct_total",
        "Page Views - Total": "page_views_total",
        "Page Views Percentage - Total": "page_views_pct_total",
        "Featured Offer (Buy Box) Percentage": "buy_box_pct",
        "Units Ordered": "units_ordered",
        "Unit Session Percentage": "unit_session_pct",
        "Ordered Product Sales": "ordered_product_sales",
        "Total Order Items": "total_order_items",
    },
)

REPORTS = {report.name: report for report in (BULK, ADS, TERMS, BUSINESS)}

# Physical name of every source, as a file below a landing folder or a table of a schema.
SOURCES = {
    "bulk_campaigns": "raw_bulk_campaigns",
    "advertised_products": "raw_advertised_products",
    "search_terms": "raw_search_terms",
    "business_report": "raw_business_report",
    "weekly_synthetic": "weekly_synthetic",
    "true_parameters": "true_parameters",
}

# Columns of the weekly mix data; its row ratios (roas, tacos, ctr) are not staged.
MIX_COLUMNS = (
    "week_start",
    "spend_sp",
    "spend_sb",
    "spend_dsp",
    "spend_total",
    "impressions_total",
    "clicks_total",
    "ad_sales",
    "ad_orders",
    "total_sales",
    "organic_sales",
)

MIX_SCHEMA = (
    "week_start date, year int, week int, spend_sp double, spend_sb double, spend_dsp double, "
    "spend_total double, impressions_total bigint, clicks_total bigint, ad_sales double, "
    "ad_orders bigint, total_sales double, organic_sales double, roas double, tacos double, ctr double"
)

TRUTH_SCHEMA = "param string, value double, description string"


def read_report(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A processed report: CSV with a header line, columns by name of ``schema``.

    The columns a file really has are looked up from its own header line, so
    column order and missing optional columns do not matter, also among the
    files of one folder.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = _csv_as_strings(spark, path)
    present = {_plain(c): c for c in raw.columns}
    return raw.select(
        *[
            F.col(_quoted(present[_plain(f.name)])).cast(f.dataType).alias(f.name)
            for f in wanted.fields
            if _plain(f.name) in present
        ]
    )


def read_raw(spark: SparkSession, path: str, kind: str, fmt: str = "csv") -> DataFrame:
    """A raw report from a landing folder, as CSV (all strings) or Parquet (types kept)."""
    if kind not in REPORTS:
        raise ValueError(f"unknown report kind {kind!r}; known: {', '.join(REPORTS)}")
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt == "csv":
        return _csv_as_strings(spark, path)
    raise ValueError(f"reports are read from csv or parquet, not {fmt!r}")


def read_source(spark: SparkSession, name: str, location: str, fmt: str = "csv") -> DataFrame:
    """A source by its logical name, from a landing folder (csv, parquet) or a schema (table)."""
    if name not in SOURCES:
        raise ValueError(f"unknown source {name!r}; known: {', '.join(SOURCES)}")
    if fmt == "table":
        return spark.table(f"{location}.{SOURCES[name]}")
    path = f"{location.rstrip('/')}/{SOURCES[name]}"
    if name in REPORTS:
        return read_raw(spark, path, name, fmt)
    if fmt == "parquet":
        return spark.read.parquet(path)
    return read_report(spark, path, MIX_SCHEMA if name == "weekly_synthetic" else TRUTH_SCHEMA)


def _header_line(spark: SparkSession, file: str) -> str:
    """The first line of a file, through the file system that Spark reads it by."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def _csv_as_strings(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV files with every column as a string, matched by name.

    Spark reads all files of a folder by the header of one of them, so files are
    grouped by their header line and each group is read by its own. The header
    of each file is looked at on the driver; exports have few files. Values may
    hold line breaks, for which a file is read by one task; ``multi_line=False``
    splits large files that have none.
    """

    def read(files: list[str]) -> DataFrame:
        # Without schema inference every column is a string and only the header line is looked at.
        return (
            spark.read.option("header", True)
            .option("inferSchema", False)
            .option("multiLine", multi_line)
            .option("escape", '"')
            .csv(files)
        )

    groups: dict[str, list[str]] = {}
    for file in spark.read.text(path).inputFiles():
        groups.setdefault(_header_line(spark, file), []).append(unquote(file))
    if len(groups) < 2:
        return read([path])
    frames = [read(sorted(files)) for _, files in sorted(groups.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _plain(header: str) -> str:
    """One spelling for raw and warehouse headers: special characters as ``_``, no outer blanks."""
    return re.sub(r"[()#/]", "_", header).strip()


def _quoted(header: str) -> str:
    return "`" + header.replace("`", "``") + "`"


def stage(df: DataFrame, report: Report, optional: bool = False) -> DataFrame:
    """Pick and rename the report's columns; nothing is coerced.

    With ``optional`` the optional columns the frame has come last.
    """
    present = {_plain(c): c for c in df.columns}
    missing = [h for h in report.columns if _plain(h) not in present]
    if missing:
        raise ValueError(f"{report.name}: missing columns {missing}")
    wanted = dict(report.columns)
    if optional:
        wanted.update({h: c for h, c in report.optional.items() if _plain(h) in present})
    return df.select(*[F.col(_quoted(present[_plain(h)])).alias(c) for h, c in wanted.items()])


def stage_bulk(df: DataFrame, optional: bool = False) -> DataFrame:
    """Bulk campaign file: 34 columns."""
    return stage(df, BULK, optional)


def stage_ads(df: DataFrame, optional: bool = False) -> DataFrame:
    """Advertised-product report: 19 columns."""
    return stage(df, ADS, optional)


def stage_terms(df: DataFrame) -> DataFrame:
    """Search-term report: 19 columns."""
    return stage(df, TERMS)


def stage_business(df: DataFrame) -> DataFrame:
    """Business report: 11 columns."""
    return stage(df, BUSINESS)


def stage_mmm(df: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Weekly mix data: ``keys`` (such as an account) and 11 columns, the week as a date."""
    week, *rest = MIX_COLUMNS
    return df.select(*keys, F.col(week).cast("date").alias(week), *rest)
