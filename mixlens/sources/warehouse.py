"""Writing of reports, warehouse tables and incrementally refreshed facts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixlens.session import release

# Names of the warehouse tables.
WAREHOUSE_TABLES = (
    "dim_date",
    "dim_campaign",
    "dim_product",
    "fact_ads_daily",
    "fact_search_term",
    "fact_business_report",
)

# Tables that are written partitioned by day.
PARTITIONS = {"fact_ads_daily": "date_id", "fact_search_term": "date_id"}

# Facts that are large, and the columns by whose hash their rows are dealt to slices. Filters on
# these columns reach the scan of the report, past the sum and the join with campaigns.
SLICED = {"fact_ads_daily": ("date_id", "sku"), "fact_search_term": ("date_id",)}

# A fact that shuffles its rows is written in a slice for every so many bytes of its sources, in so many at
# most: every slice reads the sources again.
SLICE_BYTES, SLICES = 128 << 20, 4

# The folder name starts with "_", so readers of the table skip it.
SCHEMA_FOLDER = "_columns"


def at_once(spark: SparkSession, steps: Sequence[Callable[[], object]]) -> None:
    """Run steps that don't need each other at the same time: the last tasks of one leave no core idle.

    The first error is raised when all steps have ended.
    """
    inherited = inheritable_thread_target(spark)
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        running = [pool.submit(inherited(step)) for step in steps]
    for step in running:
        step.result()


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write an anonymised report, replacing what is there."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        # Doubling quotes is how spreadsheet tools and read_report escape them.
        writer.option("header", True).option("escape", '"').csv(path)
    elif fmt == "parquet":
        writer.option("compression", "zstd").parquet(path)
    else:
        raise ValueError(f"reports are written as csv or parquet, not {fmt!r}")


def write_mmm(df: DataFrame, path: str) -> None:
    """Write a weekly mix extract or a parameter table as CSV."""
    write_report(df, path)


def _by_partition(df: DataFrame, column: str) -> DataFrame:
    # Rebalancing gathers a day's rows into few files, and splits a hot day over many tasks.
    return df.hint("rebalance", column)


def _source_bytes(df: DataFrame) -> int:
    """Bytes of the files that the frame reads; sources of unknown size count as none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(size for size in sizes if size < 2**63 - 1)


def _slices(df: DataFrame, partition: str | None = None) -> int:
    """In how many slices a fact is written: one if it is small or moves no rows between tasks."""
    wanted = min(SLICES, -(-_source_bytes(df) // SLICE_BYTES))
    if wanted < 2:
        return 1
    written = _by_partition(df, partition) if partition else df
    return wanted if "Exchange hashpartitioning" in written._jdf.queryExecution().executedPlan().toString() else 1


def _write_slices(df: DataFrame, path: str, slices: int, by: Sequence[str], partition: str | None) -> None:
    """Write the frame slice by slice: the shuffle files of one are gone before the next one's are made.

    A row's slice is a hash of its columns ``by``, so the slices are the whole
    frame. The mark of success comes with the last one.
    """
    for i in range(slices):
        part = df.where(F.pmod(F.xxhash64(*by), F.lit(slices)) == i) if slices > 1 else df
        writer = (_by_partition(part, partition) if partition else part).write.mode("append" if i else "overwrite")
        writer = writer.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", i == slices - 1)
        writer = writer.option("compression", "zstd")
        (writer.partitionBy(partition) if partition else writer).parquet(path)
        if slices > 1:
            release(df.sparkSession)


def load_warehouse(
    tables: Mapping[str, DataFrame],
    path: str,
    partitions: Mapping[str, str] = PARTITIONS,
    sliced: Mapping[str, Sequence[str]] = SLICED,
) -> dict[str, str]:
    """Write every table below ``path`` from scratch; running it again gives the same tables.

    ``partitions`` names the column by which a table gets one folder per value,
    ``sliced`` the columns by which a large table is dealt to slices. Tables in
    slices are written one after another, the others at the same time.
    """
    unknown = set(tables) - set(WAREHOUSE_TABLES)
    if unknown:
        raise ValueError(f"not warehouse tables: {sorted(unknown)}")
    paths = {name: f"{path.rstrip('/')}/{name}" for name in tables}

    def write(name: str) -> None:
        df, partition = tables[name], partitions.get(name)
        if partition:
            _by_partition(df, partition).write.mode("overwrite").partitionBy(partition).parquet(paths[name])
        else:
            df.write.mode("overwrite").parquet(paths[name])

    def dealt_by(name: str) -> list[str]:
        # All rows of a day go to the same files, so they stay in one slice.
        wanted = [partitions[name]] if name in partitions else sliced[name]
        return [c for c in wanted if c in tables[name].columns]

    facts = {name: dealt_by(name) for name in tables if name in sliced}
    slices = {name: _slices(tables[name], partitions.get(name)) if by else 1 for name, by in facts.items()}

    def write_fact(name: str) -> None:
        _write_slices(tables[name], paths[name], slices[name], facts[name], partitions.get(name))

    def write_in_turn(names: Sequence[str]) -> None:
        for name in names:
            write_fact(name)

    if tables:
        spark = next(iter(tables.values())).sparkSession
        in_turn = [name for name in facts if slices[name] > 1]
        steps = [partial(write_fact if name in facts else write, name) for name in tables if name not in in_turn]
        at_once(spark, [*steps, *([partial(write_in_turn, in_turn)] if in_turn else [])])
    return paths


def read_warehouse(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The warehouse tables below ``path``."""
    root = path.rstrip("/")
    return {name: spark.read.parquet(f"{root}/{name}") for name in WAREHOUSE_TABLES}


def materialize(name: str, df: DataFrame, kind: str = "view") -> DataFrame:
    """Publish a model under a name: ``view`` is computed when used, ``table`` is written."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    elif kind == "table":
        df.write.mode("overwrite").saveAsTable(name)
    else:
        raise ValueError(f"a model is a view or a table, not {kind!r}")
    return df.sparkSession.table(name)


def write_incremental_base(df: DataFrame, path: str, partition: str = "date_id") -> None:
    """First build of an incrementally refreshed table: every partition is written."""
    _save_schema(df, path, 0)
    _by_partition(df, partition).write.mode("overwrite").partitionBy(partition).parquet(_version_path(path, 0))


def refresh_incremental(
    df: DataFrame,
    path: str,
    as_of: str,
    lookback_days: int = 3,
    partition: str = "date_id",
) -> DataFrame:
    """Rewrite the days from ``as_of - lookback_days`` on that ``df`` has rows for.

    Older rows of ``df`` are ignored and older days of the table stay as they
    are. The table takes on the columns of ``df``: new ones are null in old
    days, and columns ``df`` no longer has disappear. If a column's type changes,
    the new days go to a folder of their own, and old days are cast when read.

    The column list is written first: a refresh that fails after that is simply
    run again. A task that is run again writes the same rows into the same
    partitions, so a lost executor or a second run changes nothing.
    """
    spark = df.sparkSession
    since = F.date_sub(F.lit(as_of).cast("date"), lookback_days)
    recent = df.where(F.col(partition) >= since)
    versions = _schemas(spark, path)
    last = max(versions)
    old = {f.name: f.dataType for f in versions[last].fields}
    changed = any(f.name in old and old[f.name] != f.dataType for f in df.schema.fields)
    version = last + 1 if changed else last
    _save_schema(df, path, version)
    (
        _by_partition(recent, partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(_version_path(path, version))
    )
    return read_incremental(spark, path, partition)


def read_incremental(spark: SparkSession, path: str, partition: str = "date_id") -> DataFrame:
    """The table with the columns of its last refresh; a day comes from the latest folder that has it."""
    versions = _schemas(spark, path)
    latest = max(versions)
    wanted = versions[latest]
    out = later_days = None
    for version in sorted(versions, reverse=True):
        table = spark.read.schema(versions[version]).parquet(_version_path(path, version))
        rows = table.select(
            *[
                (F.col(f"`{f.name}`") if f.name in table.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in wanted.fields
            ]
        )
        if out is not None:
            rows = rows.join(later_days, rows[partition].eqNullSafe(later_days["_day"]), "left_anti")
        out = rows if out is None else out.unionByName(rows)
        # Days are folder names, so this reads no data.
        days = table.select(F.col(partition).alias("_day")).distinct()
        later_days = days if later_days is None else later_days.union(days)
    return out


def _version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/types={version}"


def _schemas(spark: SparkSession, path: str) -> dict[int, T.StructType]:
    """The column list of each folder of the table."""
    saved = spark.read.option("basePath", f"{path}/{SCHEMA_FOLDER}").text(f"{path}/{SCHEMA_FOLDER}/types=*", wholetext=True)
    return {int(r["types"]): T.StructType.fromDDL(r["value"]) for r in saved.collect()}


def _save_schema(df: DataFrame, path: str, version: int) -> None:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    (
        df.sparkSession.range(1)
        .select(F.lit(ddl).alias("value"))
        .coalesce(1)
        .write.mode("overwrite")
        .text(f"{path}/{SCHEMA_FOLDER}/types={version}")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
