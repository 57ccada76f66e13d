"""Mixing sources to target weights by thresholds on a hash of each row.

Every row has a fixed draw. A source takes all its rows as often as its target
holds them whole, and once more the rows whose draw lies below a threshold. The
threshold comes from a histogram of words by source and leading digits of the
draw; only the bucket in which the budget ends is split by further digits. Rows
are never sorted, and a larger budget takes all that a smaller one takes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mixlens.llm.common import WORD, hex_number, kept_whole, text_of, written

#: Hex digits of the draw that each level of the histogram reads, and the number of levels.
DIGITS, LEVELS = 3, 3


def with_words(docs: DataFrame) -> DataFrame:
    """Adds ``size``, the number of words, 0 for a null text."""
    return docs.withColumn("size", F.regexp_count(text_of(), F.lit(WORD)).cast("long"))


def with_draw(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """Adds ``draw``, a number of 36 bits from id and text; only equal rows share one but for chance."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_of())
    return docs.withColumn("draw", hex_number(F.md5(key), 1, DIGITS * LEVELS))


def cyclic_weights(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """A weight for each source: the given ones by turns, sources by code point, null last.

    The window has no key: it sees one row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    return sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1))


def targets(sources: DataFrame, share: float, cap: float = 2.0) -> DataFrame:
    """Adds ``target`` to sources with ``source_size`` and ``weight``.

    The sum of all sizes times ``share`` is dealt by weight; no source gets more
    than ``cap`` times its size, and what is above goes to the others by weight.
    Ordered by size per weight, the capped sources come first, so running sums
    find them without iterating. One row per source reaches the window.
    """
    order = W.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    onward = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    full = F.col("source_size") * F.lit(float(cap))
    level = (
        F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum(full).over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    ranked = sources.withColumn("level", level).withColumn("capped", F.col("level") * F.col("weight") >= full)
    # The first source that is not capped sets the level of all that follow.
    first = F.first(F.when(~F.col("capped"), F.col("level")), ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    )
    return ranked.withColumn("target", F.when(F.col("capped"), full).otherwise(first * F.col("weight"))).drop(
        "level", "capped"
    )


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """The draw below which a source's rows make up its budget: ``source``, ``below``.

    ``budgets`` has ``source`` and ``rest``, a number of words below the source's
    size. Each level sums words by source and bucket, looks for the bucket in
    which the budget ends, and goes on with its rows alone. The last bucket
    counts as taken if that brings the sum nearer to the budget.
    """
    found = budgets.select("source", F.lit(0).cast("long").alias("prefix"), "rest")
    bits = 4 * DIGITS
    for level in range(LEVELS):
        shift = bits * (LEVELS - 1 - level)
        bucket = F.shiftright("draw", shift)
        rows = sized.select("source", "size", bucket.alias("bucket"), F.shiftright(bucket, bits).alias("parent"))
        left = found.withColumnRenamed("source", "of")
        inside = rows.join(left, rows.source.eqNullSafe(left.of) & (rows.parent == left.prefix))
        sums = inside.groupBy("source", "bucket").agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        upto = F.sum("words").over(W.partitionBy("source").orderBy("bucket"))
        ends = sums.withColumn("upto", upto).where(F.col("upto") >= F.col("rest"))
        first = F.min(F.struct("bucket", "upto", "words", "rest"))
        found = written(
            ends.groupBy("source")
            .agg(first.alias("e"))
            .select(
                "source",
                F.col("e.bucket").alias("prefix"),
                (F.col("e.rest") - (F.col("e.upto") - F.col("e.words"))).alias("rest"),
                F.col("e.words").alias("words"),
            ),
            f"mix-level{level}",
        ).select("source", "prefix", "rest", "words")
    whole = F.when(2 * F.col("rest") >= F.col("words"), 1).otherwise(0)
    return found.select("source", (F.col("prefix") + whole).alias("below"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    shares: Mapping[str, float] | None = None,
    cap: float = 2.0,
    seed: str = "mix",
) -> tuple[DataFrame, DataFrame]:
    """How often each row is taken: (rows, sources).

    ``rows`` has doc_id, source, size, source_size and for each name in
    ``shares`` (default ``taken``: 1.5) ``<name>_target`` and ``<name>_times``.
    It is a table of its own, without texts; ``sources`` tells for each source
    the same targets, ``<name>_passes`` and ``<name>_below``, so that
    ``copies_of`` can decide on any row that carries its draw.

    Null texts have no words and are taken 0 or more times at no cost; null
    sources form one source; a null id is an id; equal rows share a draw and are
    taken together. A source without words has target 0. Other columns play no
    part.
    """
    sized = written(with_draw(with_words(docs), seed).select("doc_id", "source", "size", "draw"), "mix-sizes")
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = cyclic_weights(sums, weights)
    for name, share in (shares or {"taken": 1.5}).items():
        aims = targets(sources, share, cap)
        passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        aims = written(
            aims.withColumn("passes", passes.cast("long")).withColumn(
                "rest", F.col("target") - F.col("passes") * F.col("source_size")
            ),
            "mix-targets",
        )
        cuts = thresholds(sized, aims.where("rest > 0").select("source", "rest")).withColumnRenamed("source", "of")
        sources = (
            aims.join(cuts, aims.source.eqNullSafe(cuts.of), "left")
            .drop("of", "rest")
            .withColumn("below", F.coalesce("below", F.lit(0).cast("long")))
            .withColumnsRenamed({c: f"{name}_{c}" for c in ("target", "passes", "below")})
        )
    sources = written(sources, "mix-sources")
    return copies_of(sized, sources, list(shares or {"taken": 1.5})), sources


def copies_of(rows: DataFrame, sources: DataFrame, names: Sequence[str] = ("taken",)) -> DataFrame:
    """Adds each source's figures and ``<name>_times``, the number of copies, to rows with source and draw."""
    of = sources.withColumnRenamed("source", "of").drop("weight")
    joined = rows.join(of, rows["source"].eqNullSafe(of["of"])).drop("of")
    return joined.withColumns(
        {
            f"{n}_times": F.col(f"{n}_passes") + F.when(F.col("draw") < F.col(f"{n}_below"), 1).otherwise(0)
            for n in names
        }
    )


def repeat_rows(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5) -> DataFrame:
    """The mixed corpus: each row as often as it is taken, with the columns of ``docs``."""
    _, sources = mix(docs, weights, {"taken": share})
    rows = with_draw(kept_whole(docs, "doc_id", "text", "source")).drop("text")
    copies = copies_of(rows, sources).withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("taken_times").cast("int"))))
    return copies.select("row.*")
