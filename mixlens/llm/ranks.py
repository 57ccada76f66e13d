"""Places of rows in a total order, without a task that sees all rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mixlens.llm.common import written


def numbered(rows: DataFrame, keys: list[str], within: list[str] | None = None, name: str = "ranks") -> DataFrame:
    """The rows with ``at``, their place from 0 in ascending order of ``keys``, nulls first.

    With ``within`` places start anew for each value of those columns, a null
    being one more value. Ranges of the order go to a task each and are written
    with the place inside the range; what stands before a range is summed over
    one row per range and value. Rows that tie in all keys follow each other in
    no particular order and still spread over ranges.
    """
    within = within or []
    order = [F.col(c).asc_nulls_first() for c in (*within, *keys)] + [F.col("place")]
    ranges = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    # A task numbers its rows in the low 33 bits.
    line = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    table = written(ranges.drop("place").withColumns({"part": F.spark_partition_id(), "line": line}), name)
    runs = table.groupBy("part", *within).agg(F.count("*").alias("n"), F.min("line").alias("first"))
    before = F.sum("n").over(W.partitionBy(*within).orderBy("part")) - F.col("n")
    named = [F.col(c).alias(f"of_{c}") for c in within]
    starts = runs.select(F.col("part").alias("of_part"), *named, (before - F.col("first")).alias("shift"))
    same = F.col("part") == F.col("of_part")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"of_{c}"))
    both = table.join(starts, same)
    return both.select(*rows.columns, (F.col("line") + F.col("shift")).alias("at"))
