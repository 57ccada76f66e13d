"""Column expressions and helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mixlens.session import release as release
from mixlens.session import scratch_path

#: ASCII white space; everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Up to so many small rows (ids, sketches; no texts) are one task's share; more are dealt out.
SHARE = 50_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for an empty text."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is computed once per row, also when body names it inside other lambdas."""
    return F.transform(F.array(value), body)[0]


def hex_number(digest: Column, start: int, digits: int) -> Column:
    """Hex digits of a digest (from 1) as a long; at most 15 digits."""
    return F.conv(F.substring(digest, start, digits), 16, 10).cast("long")


def written(df: DataFrame, name: str, *folders: str) -> DataFrame:
    """The frame as a table in the shared scratch folder: cuts lineage, survives lost executors.

    Rows of each value of ``folders``, the last columns, go to a folder of their own.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_out(df: DataFrame, rows: int) -> DataFrame:
    """The frame, in one partition if its rows are no more than one task's share.

    Spark then groups and joins it without dealing it out to all shuffle
    partitions, which takes longer and more files than the work itself.
    """
    return df.coalesce(1) if rows <= SHARE else df


def looked_up(df: DataFrame, rows: int) -> DataFrame:
    """The frame as the side of a join that is looked up: broadcast if its rows are no more than one task's share."""
    return F.broadcast(df) if rows <= SHARE else df


def kept_whole(docs: DataFrame, *columns: str) -> DataFrame:
    """The given columns and ``row``, the whole row as a struct, whose names can clash with no others."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *columns)
