"""Sharding by a weighted hash tree of regions, racks and shards.

A row descends from the root: at each level every child draws
``-ln(u) / weight``, u being a hash of the row's id and the child's name, and
the least draw wins. A child is thus chosen in proportion to its weight, and a
draw depends on no other child: if a weight changes, rows move only into or out
of the subtree that holds it.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mixlens.llm.common import hex_number, text_of


class Leaf(NamedTuple):
    """A shard and its place. Shards and racks are numbered over the whole tree."""

    region: int
    rack: int
    shard: int
    weight: float = 1.0


Tree = tuple[Leaf, ...]


def balanced_tree(shards: int, per_rack: int = 2, racks: int = 2) -> Tree:
    """Equal shards, ``per_rack`` in a rack and ``racks`` in a region."""
    return tuple(Leaf(s // (per_rack * racks), s // per_rack, s) for s in range(shards))


def grown(tree: Tree, weight: float = 1.0) -> Tree:
    """The tree with one more shard in a region of its own: rows move into that shard alone.

    A shard that joins an old region moves rows within that region too.
    """
    return (*tree, Leaf(*(1 + max(leaf[i] for leaf in tree) for i in range(3)), weight))


def _winner(key: Column, level: str, children: dict[int, float]) -> Column:
    if len(children) == 1:
        return F.lit(next(iter(children)))

    def draw(name: int, weight: float) -> Column:
        unit = (hex_number(F.md5(F.concat(key, F.lit(f"|{level}{name}"))), 1, 12) + F.lit(0.5)) / F.lit(float(2**48))
        return F.struct((-F.log(unit) / F.lit(float(weight))).alias("draw"), F.lit(name).alias("name"))

    return F.least(*[draw(n, w) for n, w in sorted(children.items())])["name"]


def assign(docs: DataFrame, tree: Tree, name: str = "shard") -> DataFrame:
    """Adds the shard of each row, an int; it depends on doc_id and the tree alone, and needs no shuffle.

    A null id is an id like any other; equal ids share a shard. A shard of
    weight 0 gets no rows.
    """
    live = [leaf for leaf in tree if leaf.weight > 0]
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    out = docs
    chosen: Column | None = None
    above: list[tuple[int | None, list[Leaf]]] = [(None, live)]
    for level, at in (("region", 0), ("rack", 1), ("shard", 2)):
        cases, below = [], []
        for parent, leaves in above:
            weights: dict[int, float] = {}
            for leaf in leaves:
                weights[leaf[at]] = weights.get(leaf[at], 0.0) + leaf.weight
            cases.append((parent, _winner(key, level, weights)))
            below += [(n, [leaf for leaf in leaves if leaf[at] == n]) for n in sorted(weights)]
        # A column per level: its draws are computed once and compared many times below.
        column = name if level == "shard" else f"{name}_{level}"
        if chosen is None:
            out = out.withColumn(column, cases[0][1])
        else:
            pick = F.when(chosen == cases[0][0], cases[0][1])
            for parent, winner in cases[1:]:
                pick = pick.when(chosen == parent, winner)
            out = out.withColumn(column, pick)
        chosen, above = F.col(column), below
    return out.drop(f"{name}_region", f"{name}_rack")


def with_slots(rows: DataFrame, digits: int = 3) -> DataFrame:
    """Numbers the rows of each shard from 0 without a gap, in a new column ``slot``.

    A shard is cut into buckets by leading hex digits of a hash of the rows; rows
    are numbered within a bucket, and each bucket starts where the one before ends, so no task sees
    a whole shard. Rows that are equal in all columns are counted before the
    shuffle and spread out at the end.
    """
    columns = rows.columns
    same = rows.groupBy(*columns).agg(F.count("*").alias("_n"))
    others = [c for c in columns if c != "shard"]
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in others])
    same = same.withColumn("_bucket", F.substring(F.md5(text), 1, digits))
    sums = same.groupBy("shard", "_bucket").agg(F.sum("_n").alias("_rows"))
    ends = F.sum("_rows").over(W.partitionBy("shard").orderBy("_bucket"))
    starts = sums.select("shard", "_bucket", (ends - F.col("_rows")).alias("_start"))
    within = W.partitionBy("shard", "_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in others])
    first = F.sum("_n").over(within.rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")
    placed = same.withColumn("_first", first).join(starts, ["shard", "_bucket"])
    at = F.col("_start") + F.col("_first")
    return placed.withColumn("slot", F.explode(F.sequence(at, at + F.col("_n") - 1))).select(*columns, "slot")


def thin(docs: DataFrame) -> DataFrame:
    """doc_id with the size and checksum of its text: UTF-8 bytes plus 1, and crc32; a null text has none."""
    return docs.select(
        "doc_id",
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
