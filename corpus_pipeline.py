"""A corpus pipeline over ``documents``: quality, near copies, test items, mixing, shards.

Each stage gets the rows that its predecessor kept, read again from Parquet, and
all but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mixlens.llm import contamination, mixing, near_dup, quality, sharding
from mixlens.llm.common import read, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only documents that pass the base rule and that the weighed votes of all rules call good."""
    return quality.keep_good(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of least id."""
    return near_dup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only documents that contain no benchmark item."""
    return contamination.clean(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows left out or repeated so that sources weigh 5, 2, 1 by turns, with 150 % of the words in all."""
    return mixing.repeat_rows(docs, (5, 2, 1), 1.5)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``shard``, one of 16 in a tree of regions and racks."""
    return sharding.assign(docs.drop("shard"), sharding.balanced_tree(16))


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copies_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Estimating votes and sampling shingles are no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
