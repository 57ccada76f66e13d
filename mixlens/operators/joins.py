"""Joining facts to dimensions at row level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_dimension(rows: DataFrame, dimension: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join rows to a dimension that has one row per key.

    Nothing is measured beforehand: both sides come to the join by a shuffle, and
    adaptive execution broadcasts the dimension instead if it turns out to be
    below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, or else splits the
    partitions of hot keys. It can split only if both sides come straight from a
    shuffle made for the join. A dimension that was just deduplicated by the
    same key would be joined as it lies; matching on the key's hash as well
    makes Spark shuffle it for the join.
    """
    hashed = F.xxhash64(on)
    joined = rows.withColumn("_hash", hashed).join(dimension.withColumn("_hash", hashed), [on, "_hash"], how)
    return joined.drop("_hash")
