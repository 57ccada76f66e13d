"""A Merkle manifest of a dataset, and proofs of many of its rows at once.

Rows are leaves of a tree per group (a language, say), in the order of their
ids; the groups' roots are leaves of one more tree. Trees are built storey by
storey: a task turns a block of consecutive nodes into all levels above them up
to one node, which is a node of the next storey.

Proofs are made as multiproofs. The leaves of a block know each other, so most
of what their proofs need can be derived: a block computes which nodes it lacks
(siblings that are neither known nor derivable from what is), asks for those
once, derives all nodes its leaves share, and expands the path of each leaf from
them.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import written
from mixlens.llm.ranks import numbered

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Levels in a storey: a block has 2 ** BITS nodes at most.
BITS = 10

NODES = "tree long, level int, at long, digest string"
PATH = "array<struct<digest:string,left:boolean>>"


def field(value: Column) -> Column:
    """A value as hashed: its bytes in UTF-8, counted, or ``-`` for a null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """The digest of a row's values in this order, as lowercase hex."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def widths(n: int) -> list[int]:
    """Nodes of each level of a tree of n leaves, down to one."""
    found = [n]
    while found[-1] > 1:
        found.append(-(-found[-1] // 2))
    return found


def lacking(places, sizes: list[int], start: int = 0):
    """(level, place) of all nodes that paths from ``places`` of level ``start`` need and that can't be derived from them."""
    import numpy as np

    known, found = np.unique(np.asarray(places, np.int64)), []
    for level in range(start, len(sizes) - 1):
        siblings = known ^ 1
        missing = siblings[(siblings < sizes[level]) & ~np.isin(siblings, known)]
        found += [(level, int(m)) for m in missing]
        known = np.unique(known >> 1)
    return found


def parents(level: dict[int, str], size: int) -> dict[int, str]:
    """The nodes above those of a level; a last one without a sibling is hashed alone."""
    import hashlib

    found = {}
    for at, digest in level.items():
        if at & 1:
            continue
        pair = digest if at + 1 == size else digest + level[at + 1] if at + 1 in level else None
        if pair is not None:
            found[at >> 1] = hashlib.sha256(pair.encode()).hexdigest()
    return found


def _storey(storey: int, bits: int) -> Callable:
    """All nodes above a block of nodes of level storey * bits, up to one that stands for the block."""

    def run(table):
        import pyarrow as pa

        schema = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("at", pa.int64()), ("digest", pa.string())])
        tree, sizes = table.column("tree")[0].as_py(), widths(table.column("n")[0].as_py())
        known = dict(zip(table.column("at").to_pylist(), table.column("digest").to_pylist()))
        first, rows = storey * bits, []
        for level in range(first, min(first + bits, len(sizes) - 1)):
            known = parents(known, sizes[level])
            rows += [(level + 1, at, digest) for at, digest in known.items()]
        levels, places, digests = (list(x) for x in zip(*rows)) if rows else ([], [], [])
        return pa.table([pa.array([tree] * len(rows), pa.int64()), levels, places, digests], schema=schema)

    return run


@dataclass
class Trees:
    """Trees over numbered leaves.

    leaves: tree, n (leaves of the tree), at, digest and all other columns they
    came with. nodes: tree, level, at, digest of all nodes above the leaves; storey
    s has the levels from s * bits on. roots: tree, n, digest.
    """

    leaves: DataFrame
    nodes: DataFrame
    roots: DataFrame
    bits: int


def build(leaves: DataFrame, bits: int = BITS) -> Trees:
    """The trees over leaves that have tree, n, at (0 to n - 1 in each tree) and digest."""
    sizes = written(leaves.select("tree", "n").distinct(), "merkle-sizes")
    most = sizes.agg(F.max("n")).first()[0] or 0
    nodes = leaves.sparkSession.createDataFrame([], f"{NODES}, storey int")
    level = leaves.select("tree", "n", "at", "digest")
    for storey in range(-(-(len(widths(most)) - 1) // bits)):
        blocks = level.groupBy("tree", F.expr(f"shiftright(at, {bits})"))
        made = blocks.applyInArrow(_storey(storey, bits), NODES).withColumn("storey", F.expr(f"int(level div {bits})"))
        made = written(made, "merkle-storey", "storey")
        nodes = nodes.unionByName(made)
        level = made.where(F.col("storey") == storey + 1).join(sizes, "tree").select("tree", "n", "at", "digest")
    height = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)
    tops = nodes.where("at = 0").join(sizes.withColumn("height", height), "tree").where("level = height")
    single = leaves.where("n = 1").select("tree", "n", "digest")
    return Trees(leaves, nodes, written(single.union(tops.select("tree", "n", "digest")), "merkle-roots"), bits)


def _asking(bits: int) -> Callable:
    """What the wanted leaves of a block lack."""

    def run(table):
        import pyarrow as pa

        schema = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("level", pa.int32()), ("at", pa.int64())])
        places, tree = table.column("at").to_numpy(), table.column("tree")[0].as_py()
        asked = lacking(places, widths(table.column("n")[0].as_py()))
        levels, at = (list(x) for x in zip(*asked)) if asked else ([], [])
        block = int(places[0]) >> bits
        return pa.table([pa.array([tree] * len(asked), pa.int64()), pa.array([block] * len(asked), pa.int64()), levels, at], schema=schema)

    return run


def _expanding() -> Callable:
    """The block's leaves with their paths, from the leaves and what they lacked."""

    def run(leaves, fetched):
        import numpy as np
        import pyarrow as pa

        kind = pa.list_(pa.struct([("digest", pa.string()), ("left", pa.bool_())]))
        if not leaves.num_rows:
            return leaves.append_column("path", pa.array([], kind))
        sizes = widths(leaves.column("n")[0].as_py())
        places = leaves.column("at").to_numpy()
        got: dict[int, dict[int, str]] = {}
        for level, at, digest in zip(*(fetched.column(c).to_pylist() for c in ("level", "at", "digest"))):
            got.setdefault(level, {})[at] = digest
        known = dict(zip(places.tolist(), leaves.column("digest").to_pylist()))
        steps = len(sizes) - 1
        digests, left = np.full((len(places), steps), None, object), np.zeros((len(places), steps), bool)
        for level in range(steps):
            known.update(got.get(level, {}))
            at = places >> level
            # A place without a sibling is hashed alone: its step has no digest.
            digests[:, level] = [known[s] if s < sizes[level] else None for s in (at ^ 1).tolist()]
            left[:, level] = at & 1
            known = parents(known, sizes[level])
        flat = pa.StructArray.from_arrays([pa.array(digests.ravel(), pa.string()), pa.array(left.ravel())], names=["digest", "left"])
        ends = pa.array(np.arange(len(places) + 1) * steps, pa.int32())
        return leaves.append_column("path", pa.ListArray.from_arrays(ends, flat))

    return run


def prove(trees: Trees, wanted: DataFrame) -> DataFrame:
    """The wanted leaves (rows of ``trees.leaves``) with ``path``: the steps from the leaf to its tree's root.

    A step has the sibling's digest and whether it stands to the left; a step
    without a digest hashes a node alone.
    """
    block = F.expr(f"shiftright(at, {trees.bits})")
    asked = wanted.groupBy("tree", block.alias("block")).applyInArrow(_asking(trees.bits), "tree long, block long, level int, at long")
    asked = written(asked, "merkle-asked")
    # Nobody asks for low levels if blocks are whole, so their storeys needn't be read.
    low = asked.agg(F.min("level")).first()[0]
    there = trees.nodes.where(F.col("storey") >= (low or 0) // trees.bits).drop("storey")
    if low == 0:
        there = trees.leaves.select("tree", F.lit(0).alias("level"), "at", F.col("digest").alias("digest")).unionByName(there)
    fetched = asked.join(there, ["tree", "level", "at"]).select("tree", "block", "level", "at", "digest")
    groups = wanted.withColumn("block", block).groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block"))
    schema = ", ".join(f"`{n}` {t}" for n, t in wanted.dtypes)
    return groups.applyInArrow(_expanding(), f"{schema}, block long, path {PATH}").drop("block")


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and a path lead to."""

    def step(node: Column, s: Column) -> Column:
        sibling = F.coalesce(s["digest"], F.lit(""))
        return F.sha2(F.when(s["left"], F.concat(sibling, node)).otherwise(F.concat(node, sibling)), 256)

    return F.aggregate(path, digest, step)


def path_digest(path: Column) -> Column:
    """The digest of a path's siblings from the leaf up."""
    siblings = F.filter(F.transform(path, lambda s: s["digest"]), lambda d: d.isNotNull())
    return F.sha2(F.array_join(siblings, ""), 256)


@dataclass
class Manifest:
    """Trees per group, the tree over their roots, and its root (null for an empty table)."""

    groups: Trees
    top: Trees
    root: str | None


def manifest(rows: DataFrame, group: str, keys: list[str], digest: Column, keep: list[str], bits: int = BITS) -> Manifest:
    """The manifest of all rows, in trees by ``group`` and in them by ``keys``, ascending, nulls first.

    ``digest`` is a row's leaf, of any columns; the columns ``keep`` stay with the
    leaf as a struct ``row``, others play no part, so that names can't clash. A
    null group is a tree like any other and comes first; rows that tie in all
    keys follow each other by digest, and equal ones count each. An empty table
    has no root.
    """
    columns = [F.col(group).alias("group"), F.struct(*keys).alias("key"), digest.alias("digest"), F.struct(*keep).alias("row")]
    placed = numbered(rows.select(*columns), ["key", "digest"], ["group"], "merkle-leaves")
    sizes = placed.groupBy("group").agg(F.count("*").alias("n"))
    ranks = written(numbered(sizes, ["group"], name="merkle-ranks").withColumnRenamed("at", "tree"), "merkle-trees")
    ranks = ranks.withColumnRenamed("group", "of_group")
    leaves = placed.drop("key").join(ranks, F.col("group").eqNullSafe(F.col("of_group"))).drop("of_group")
    groups = build(written(leaves, "merkle-placed"), bits)
    n = F.lit(ranks.count()).cast("long").alias("n")
    subroots = groups.roots.select(F.lit(0).cast("long").alias("tree"), n, F.col("tree").alias("at"), "digest")
    top = build(written(subroots, "merkle-top"), bits)
    root = top.roots.first()
    return Manifest(groups, top, root["digest"] if root else None)


def proofs(made: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """row, group, leaf, subroot, root and ``path`` of the wanted leaves, all unless given.

    ``path`` has the steps from the leaf to the root: each with the sibling's
    digest and whether it stands to the left, or without a digest where a node is
    hashed alone.
    """
    mine = prove(made.groups, made.groups.leaves if wanted is None else wanted)
    upper = prove(made.top, made.top.leaves).select(
        F.col("at").alias("of_tree"), F.col("digest").alias("subroot"), F.col("path").alias("upper")
    )
    both = mine.join(upper, mine["tree"] == upper["of_tree"])
    return both.select(
        "row", "group", F.col("digest").alias("leaf"), "subroot", F.lit(made.root).alias("root"), F.concat("path", "upper").alias("path")
    )
