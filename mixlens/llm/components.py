"""Connected components of a table of links, by joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import shared_out, written


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """The least node of each node's component: ``node``, ``root``; only nodes with links to others appear.

    ``links`` has columns a and b of one orderable type, in any order, repeated
    or not; a link with a null is left out. Two steps alternate until no link
    moves: each node's larger neighbours are linked to its least neighbour, then
    its smaller neighbours are. Both keep the components, and the graph ends as
    stars around the least nodes after a few rounds. A hub shows up in as many
    rows as it has links; minima are taken by combining aggregates and the join
    can be split, so no task holds all links of a hub. Links that are no more
    than one task's share, at the start or later, are not dealt out any more.
    """

    def step(edges: DataFrame, smaller: bool) -> DataFrame:
        if smaller:
            rows = edges.where("a > b").select(F.col("a").alias("u"), F.col("b").alias("v"))
        else:
            rows = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = rows.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        joined = rows.join(least, "u")
        if smaller:
            # Smaller neighbours, and the node itself, come under the least one.
            linked = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
        else:
            linked = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return linked.where("a <> b")

    def mark(edges: DataFrame) -> tuple:
        spread = F.xxhash64("a", "b").cast("decimal(38,0)")
        return tuple(edges.agg(F.count("*"), F.sum(spread)).first())

    edges = written(links.select("a", "b").where("a <> b"), "links")
    before = mark(edges)
    edges = shared_out(edges, before[0])
    for _ in range(rounds):
        edges = written(step(step(edges, False).distinct(), True).distinct(), "links")
        after = mark(edges)
        edges = shared_out(edges, after[0])
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return shared_out(nodes.union(edges.select("b", "b").distinct()), after[0])
