"""Similar pairs among the members of buckets, without comparing everybody with everybody."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import SHARE, looked_up, release, shared_out, written
from mixlens.llm.components import components


def pivot_links(
    members: DataFrame,
    compare: Callable[[DataFrame], DataFrame],
    reach: float,
    growth: int = 4,
    links: DataFrame | None = None,
    unlike: Callable[[Column, Column], Column] | None = None,
    rows: int = SHARE + 1,
) -> DataFrame:
    """Links (a, b) that connect all members that similar pairs connect.

    ``members`` has bucket and node (long), each pair once. ``compare`` adds the
    distance ``far``, a metric, to pairs (a, b); beyond twice ``reach`` it may
    give any number above that. Pairs within ``reach`` are similar.

    Members may also have the doubles ``weight``, ``room`` and ``lean``: two of
    them can be similar only if the weight of each fits into the other's room, a
    null fits always; those that lean least become pivots first. A column
    ``sketch`` goes with ``unlike``, which tells from two sketches that their
    members aren't similar; a null leaves it open. What ``links`` (a, b) connect
    already needn't be found again; they are not given back.

    ``rows``: there are no more members than that, if it is known.

    Every round each bucket picks pivots and compares its other members with
    them; a pivot then leaves its bucket. Pairs that can't matter are skipped:
    members that links connect already, and members whose distances to the
    bucket's first pivot differ by more than ``reach``, which the triangle
    inequality rules out. After the first round pivots come from members outside
    the bucket's largest group, and a bucket of one group is done. A group of
    copies thus costs a few comparisons a member. Members that nothing tells
    apart and nothing connects have to be compared; each round takes ``growth``
    times as many pivots, so that rounds stay few, and a bucket with no more
    candidates than that is finished with all of them. A pair is met in the first
    of all buckets it shares at the start: it is compared there when one of the
    two is a pivot, or that bucket ends as one group; so it is met once in all
    rounds. What is left of the buckets is written once a round. Members that are
    no more than one task's share are grouped by one task; their pivots are then
    broadcast, and the comparisons always spread over tasks.
    """
    spark = members.sparkSession
    some = [c if c in members.columns else F.lit(None).cast("double").alias(c) for c in ("weight", "room", "lean", "d0")]
    some += ["sketch"] if unlike else []
    members = members.select("bucket", "node", *some)
    carried = members.columns
    told_by = [c for c in ("root", "d0", "weight", "room", "buckets", "sketch") if c in (*carried, "root", "buckets")]

    def left(members: DataFrame, groups: DataFrame, rows: int) -> tuple[DataFrame, int]:
        """Members (at most ``rows``) of buckets with more than one group, with their root and all buckets they had at the start; their number."""
        members = shared_out(members, rows)
        named = members.join(looked_up(groups, n_links), "node", "left").withColumn("root", F.coalesce("root", "node"))
        mixed = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        rest = named.join(looked_up(mixed.where("low < high").select("bucket"), rows), "bucket")
        if "buckets" in members.columns:
            found = rest.select(*carried, "buckets", "root")
        else:
            places = rest.groupBy("node").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))
            found = rest.select(*carried, "root").join(looked_up(places, rows), "node").select(*carried, "buckets", "root")
        if rows <= SHARE:
            found = found.repartition(spark.sparkContext.defaultParallelism)
        found = written(found, "bucket-members")
        release(spark)
        return found, found.count()

    def may_be_similar(one: DataFrame, pivots: DataFrame, other: str = "node <> pivot") -> DataFrame:
        """(a, b) for members ``one`` and pivots of their buckets, without pairs that can't matter."""
        tried = one.join(pivots, "bucket").where(f"{other} and root <> pivot_root")
        near = F.abs(F.col("d0") - F.col("pivot_d0")) <= reach
        fits = (F.col("weight") <= F.col("pivot_room")) & (F.col("pivot_weight") <= F.col("room"))
        tried = tried.where(F.coalesce(near, F.lit(True)) & F.coalesce(fits, F.lit(True)))
        if unlike:
            tried = tried.where(~F.coalesce(unlike(F.col("sketch"), F.col("pivot_sketch")), F.lit(False)))
        # A pair that shares several buckets is met in the first of them only, also when one of the two has left it.
        tried = tried.where(F.array_min(F.array_intersect("buckets", "pivot_buckets")) == F.col("bucket"))
        return tried.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))

    groups = components(links.select("a", "b")) if links is not None else spark.createDataFrame([], "node long, root long")
    n_links = links.count() if links is not None else 0
    members, rows = left(members, groups, rows)
    known = spark.createDataFrame([], "a long, b long, far double")
    pivots = 1
    while rows:
        every = candidates = shared_out(members, rows)
        if pivots > 1:
            sizes = every.groupBy("bucket", "root").agg(F.count("*").alias("size"))
            largest = sizes.groupBy("bucket").agg(F.max(F.struct("size", "root")).alias("top"), F.sum("size").alias("all"))
            candidates = every.join(looked_up(largest, rows), "bucket").where("root <> top.root")
        part = F.pmod(F.xxhash64("node"), F.lit(pivots))
        if pivots > 1:
            part = F.when(F.col("all") - F.col("top.size") <= pivots, F.col("node")).otherwise(part)
        order = F.struct(F.coalesce("lean", F.lit(0.0)).alias("lean"), "node", *told_by)
        chosen = candidates.groupBy("bucket", part.alias("part")).agg(F.min(order).alias("p")).select("bucket", "p.*")
        chosen = chosen.withColumnsRenamed({"node": "pivot", **{c: f"pivot_{c}" for c in told_by}})
        chosen = written(chosen.drop("lean"), "pivots")
        if pivots > 1:
            gone = chosen.select("bucket", F.col("pivot").alias("node"))
            rest = written(every.join(looked_up(gone, rows), ["bucket", "node"], "left_anti"), "bucket-rest")
            both = chosen.select("bucket", F.col("pivot").alias("node"), *[F.col(f"pivot_{c}").alias(c) for c in told_by])
            tried = may_be_similar(rest, looked_up(chosen, rows))
            tried = tried.union(may_be_similar(both, looked_up(chosen, rows), "node < pivot"))
        else:
            tried = may_be_similar(members, looked_up(chosen, rows))
        tried = written(tried, "pairs")
        n_pairs = tried.count()
        far = written(compare(looked_up(shared_out(tried, n_pairs), n_pairs)).select("a", "b", "far"), "pair-distances")
        if pivots == 1:
            # Distances to the bucket's first pivot serve all later rounds.
            first = chosen.select("bucket", F.col("pivot").alias("p0"))
            rest = every.drop("d0").join(looked_up(first, rows), "bucket").where("node <> p0")
            rest = rest.withColumns({"a": F.least("node", "p0"), "b": F.greatest("node", "p0")})
            rest = rest.join(looked_up(far, n_pairs), ["a", "b"], "left").withColumn("d0", F.col("far"))
            rest = written(rest.select(*carried, "buckets"), "bucket-rest")
        known, n_links = known.unionByName(far), n_links + n_pairs
        found = far.where(F.col("far") <= reach).select("a", "b")
        if not found.isEmpty():
            # The groups so far, as stars, say the same as all links before.
            groups = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).union(found))
        members, rows = left(rest.select(*carried, "buckets"), groups, rows)
        pivots *= growth
    return known.where(F.col("far") <= reach).select("a", "b")
