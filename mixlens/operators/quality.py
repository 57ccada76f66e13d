"""Declarative data checks: each counts failing rows, one result row per check."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    """One rule about a table; ``parent`` is (table, column) for relationships."""

    kind: str
    table: str
    columns: tuple[str, ...]
    severity: str = "error"
    parent: tuple[str, str] | None = None

    @property
    def name(self) -> str:
        target = f"_to_{self.parent[0]}" if self.parent else ""
        return f"{self.kind}_{self.table}_{'_'.join(self.columns)}{target}"


def not_null(table: str, *columns: str, severity: str = "error") -> list[Check]:
    """One check per column: no nulls."""
    return [Check("not_null", table, (c,), severity) for c in columns]


def unique(table: str, column: str, severity: str = "error") -> Check:
    """No value twice; nulls do not count."""
    return Check("unique", table, (column,), severity)


def relationship(child: str, column: str, parent: str, parent_column: str, severity: str = "error") -> Check:
    """Every non-null value has a parent row."""
    return Check("relationship", child, (column,), severity, (parent, parent_column))


def unique_combination(table: str, *columns: str, severity: str = "error") -> Check:
    """No combination of values twice; null equals null."""
    return Check("unique_combination", table, columns, severity)


def _result(check: Check, failing: DataFrame) -> DataFrame:
    """One row for a check from a one-row frame with the column ``failing_rows``."""
    return failing.select(
        F.lit(check.name).alias("check"),
        F.lit(check.table).alias("table"),
        F.lit(", ".join(check.columns)).alias("columns"),
        F.lit(check.severity).alias("severity"),
        F.coalesce(F.col("failing_rows"), F.lit(0)).cast("bigint").alias("failing_rows"),
    )


def _not_null_results(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All null checks of one table from a single pass over it."""
    counted = df.agg(
        *[F.count_if(F.col(c.columns[0]).isNull()).alias(f"n{i}") for i, c in enumerate(checks)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("check"),
                F.lit(c.table).alias("table"),
                F.lit(c.columns[0]).alias("columns"),
                F.lit(c.severity).alias("severity"),
                F.col(f"n{i}").alias("failing_rows"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))


def _repeated(df: DataFrame, check: Check) -> DataFrame:
    """Number of values (or combinations) that occur more than once."""
    columns = list(check.columns)
    rows = df.dropna(subset=columns) if check.kind == "unique" else df
    groups = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count_if(F.col("n") > 1).alias("failing_rows"))


def _orphans(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Number of child rows without a parent row.

    Child rows are counted per value and parents are made distinct before the
    join, so no value is hot in it.
    """
    (column,), (_, parent_column) = check.columns, check.parent
    values = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).count()
    known = parent.select(F.col(parent_column).alias("value")).where(F.col("value").isNotNull()).distinct()
    return values.join(known, "value", "left_anti").agg(F.sum("count").alias("failing_rows"))


def columns_read(checks: Iterable[Check | list[Check]]) -> dict[str, list[str]]:
    """The columns of each table that the checks look at, parents' columns included."""
    found: dict[str, dict[str, None]] = {}
    for check in _flat(checks):
        found.setdefault(check.table, {}).update(dict.fromkeys(check.columns))
        if check.parent:
            found.setdefault(check.parent[0], {})[check.parent[1]] = None
    return {table: list(columns) for table, columns in found.items()}


def _flat(checks: Iterable[Check | list[Check]]) -> list[Check]:
    return [one for c in checks for one in (c if isinstance(c, list) else [c])]


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check | list[Check]]) -> DataFrame:
    """One row per check: check, table, columns, severity, failing_rows."""
    flat = _flat(checks)
    results = []
    for table in dict.fromkeys(c.table for c in flat if c.kind == "not_null"):
        own = [c for c in flat if c.kind == "not_null" and c.table == table]
        results.append(_not_null_results(tables[table], own))
    for check in flat:
        df = tables[check.table]
        if check.kind in ("unique", "unique_combination"):
            results.append(_result(check, _repeated(df, check)))
        elif check.kind == "relationship":
            results.append(_result(check, _orphans(df, tables[check.parent[0]], check)))
        elif check.kind != "not_null":
            raise ValueError(f"unknown kind of check: {check.kind}")
    if not results:
        raise ValueError("no checks given")
    return reduce(DataFrame.unionByName, results)


class ChecksFailed(AssertionError):
    """At least one check of severity ``error`` has failing rows."""


def assert_checks(result: DataFrame) -> DataFrame:
    """Raise if an ``error`` check fails; return the failing ``warn`` checks.

    The result has one row per check; it is computed once, on the driver, and
    the warnings come back as a frame of those rows.
    """
    failing = result.where(F.col("failing_rows") > 0).collect()
    errors = [r for r in failing if r["severity"] == "error"]
    if errors:
        raise ChecksFailed("; ".join(f"{r['check']}: {r['failing_rows']} rows" for r in errors))
    return result.sparkSession.createDataFrame(failing, result.schema)


# The checks the warehouse marts declare.
MART_CHECKS = [
    *not_null("dim_date", "date_id"),
    unique("dim_date", "date_id"),
    *not_null("dim_campaign", "campaign_id", "campaign_name"),
    unique("dim_campaign", "campaign_id"),
    *not_null("dim_product", "sku"),
    unique("dim_product", "sku"),
    *not_null("fact_ads_daily", "date_id", "asin", "campaign_name", "impressions"),
    relationship("fact_ads_daily", "asin", "dim_product", "asin"),
    relationship("fact_ads_daily", "campaign_name", "dim_campaign", "campaign_name", "warn"),
    unique_combination("fact_ads_daily", "date_id", "campaign_name", "asin"),
    *not_null("fact_search_term", "date_id", "campaign_name", "customer_search_term"),
    relationship("fact_search_term", "campaign_name", "dim_campaign", "campaign_name", "warn"),
    *not_null("fact_business_report", "parent_asin"),
    unique("fact_business_report", "parent_asin"),
    relationship("fact_business_report", "parent_asin", "dim_product", "asin", "warn"),
    *not_null("fact_weekly_channel_performance", "week", "ad_product", "total_spend", "total_sales"),
    unique_combination("fact_weekly_channel_performance", "week", "ad_product"),
]

MIX_CHECKS = [
    *not_null("fct_mmm_weekly", "week_start"),
    unique("fct_mmm_weekly", "week_start"),
    *not_null("fct_mmm_channel_spend_weekly", "week_start"),
    unique_combination("fct_mmm_channel_spend_weekly", "week_start", "channel"),
]

# The real grain of the daily ads fact: two skus of one product may share a day.
ADS_GRAIN_CHECK = unique_combination("fact_ads_daily", "date_id", "campaign_name", "asin", "sku")


@dataclass(frozen=True)
class TableRules:
    """Primary key, required columns and foreign keys of a table."""

    primary_key: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    foreign_keys: tuple[tuple[str, str, str], ...] = ()


# Keys and required columns of the id-keyed star schema.
STAR_RULES = {
    "dim_date": TableRules(("date_id",), ("date_id", "year", "month", "week", "day_of_week", "is_weekend")),
    "dim_campaign": TableRules(("campaign_id",), ("campaign_id", "campaign_name")),
    "dim_product": TableRules(("asin",), ("asin",)),
    "fact_ads_daily": TableRules(
        ("date_id", "campaign_id", "asin"),
        ("date_id", "campaign_id"),
        (
            ("date_id", "dim_date", "date_id"),
            ("campaign_id", "dim_campaign", "campaign_id"),
            ("asin", "dim_product", "asin"),
        ),
    ),
    "fact_search_term": TableRules(
        (),
        ("date_id", "campaign_id", "customer_search_term"),
        (("date_id", "dim_date", "date_id"), ("campaign_id", "dim_campaign", "campaign_id")),
    ),
    "fact_business_report": TableRules(
        ("snapshot_date", "asin"), ("snapshot_date", "asin"), (("asin", "dim_product", "asin"),)
    ),
}


def checks_from_schema(table: str, rules: TableRules | None = None) -> list[Check]:
    """The checks that a table's keys and required columns imply."""
    rules = rules or STAR_RULES[table]
    out = not_null(table, *rules.required)
    if len(rules.primary_key) == 1:
        out.append(unique(table, rules.primary_key[0]))
    elif rules.primary_key:
        out.append(unique_combination(table, *rules.primary_key))
    out.extend(relationship(table, c, parent, pc) for c, parent, pc in rules.foreign_keys)
    return out


def schema_drift(
    df: DataFrame,
    expected: T.StructType,
    ranges: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Differences from an expected schema, and counts of values outside their ranges.

    One row per finding: column, problem, detail, failing_rows (null for schema findings).
    """
    spark = df.sparkSession
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    findings = [(c, "missing", t, None) for c, t in want.items() if c not in have]
    findings += [(c, "unexpected", t, None) for c, t in have.items() if c not in want]
    findings += [
        (c, "type", f"{want[c]} -> {have[c]}", None) for c in want if c in have and want[c] != have[c]
    ]
    schema = "column string, problem string, detail string, failing_rows bigint"
    out = spark.createDataFrame(findings, schema)
    bounded = {c: r for c, r in (ranges or {}).items() if c in have}
    if not bounded:
        return out
    outside, details = {}, {}
    for c, (low, high) in bounded.items():
        below = F.col(c) < F.lit(low) if low is not None else F.lit(False)
        above = F.col(c) > F.lit(high) if high is not None else F.lit(False)
        outside[c] = F.count_if(below | above)
        details[c] = f"outside [{'' if low is None else low}, {'' if high is None else high}]"
    counted = df.agg(*[expr.alias(c) for c, expr in outside.items()])
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.lit("range").alias("problem"),
                F.lit(details[c]).alias("detail"),
                F.col(_tick(c)).alias("failing_rows"),
            )
            for c in bounded
        ]
    )
    return out.unionByName(counted.select(F.inline(rows)).where(F.col("failing_rows") > 0))


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
