"""Benchmark decontamination: which documents contain a test item.

An item is in a document if at least ``least`` of its distinct five-word shingles
are. Items are partitioned by size, each class twice as large as the one
before. An item is searched by its MinHash sketch, the shingles of least hash;
the class decides how many: one more than a document may lack that still
contains an item of the class's largest size. So every such document holds one of
them, however long it is, which banded signatures of whole documents can't
promise when an item is a thousandth of a document. Candidates are verified by
counting all their shingles.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import kept_whole, let, text_of, words_of, written

WIDTH = 5

log = logging.getLogger(__name__)


def shingles(text: Column, width: int = WIDTH) -> Column:
    """64-bit hashes of all windows of ``width`` words, case set aside; none for a shorter text."""

    def windows(words: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(words) - width)
        hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]))
        return F.when(F.size(words) >= width, hashes).otherwise(F.array().cast("array<bigint>"))

    return let(words_of(F.lower(text)), windows)


def sketches(items: DataFrame, least: float = 0.8, width: int = WIDTH) -> DataFrame:
    """One row per item: item_id, item (its number), all (its distinct shingles), need (how many a document must hold), sketch.

    Rows that share an item_id, or have none, are items of their own; equal rows
    count once. Items of fewer than ``width`` words have no shingle and are left
    out, as there is nothing to search by; ``left_out`` counts them.
    """
    rows = items.select("item_id", F.array_distinct(shingles(text_of(), width)).alias("all")).distinct()
    rows = rows.withColumn("item", F.monotonically_increasing_id())
    size = F.size("all")
    upper = F.pow(F.lit(2), F.length(F.bin(size))) - 1
    draws = F.floor(upper * (1 - least) + 1e-9).cast("int") + 1
    by_hash = F.sort_array(F.transform("all", lambda h: F.struct(F.xxhash64(h).alias("draw"), h.alias("shingle"))))
    return rows.where(size > 0).select(
        "item_id",
        "item",
        "all",
        F.ceil(size * least - 1e-9).cast("int").alias("need"),
        F.transform(F.slice(by_hash, 1, draws), lambda x: x["shingle"]).alias("sketch"),
    )


def left_out(items: DataFrame, width: int = WIDTH) -> int:
    """How many rows have an item that ``search`` can't look for: of fewer than ``width`` words, or none."""
    return items.where(F.size(words_of(text_of())) < width).count()


def search(docs: DataFrame, items: DataFrame, least: float = 0.8, width: int = WIDTH) -> DataFrame:
    """All pairs of a document and an item it contains: doc_id, text_key, item_id, shared, size.

    ``text_key`` is a hash of the document's text, so that rows with the same or
    no doc_id are told apart; equal rows give one pair. Null and empty texts
    contain nothing. An item without an id is searched like any other and reported
    with a null item_id. The number of items that are too short goes to the log.
    Spark broadcasts the sketches if they are small enough for
    its threshold and else shuffles shingles by hash; a shingle of a third of
    all documents is met by as many rows as items that have it.
    """
    short = left_out(items, width)
    if short:
        log.warning("%d items of under %d words are not searched", short, width)
    # Written, so that each item keeps its number.
    items = written(sketches(items, least, width), "items")
    keys = items.select("item", "need", F.explode("sketch").alias("shingle"))
    found = docs.select("doc_id", F.xxhash64(text_of()).alias("text_key"), shingles(text_of(), width).alias("s"))
    probes = found.select("doc_id", "text_key", F.size("s").alias("n"), F.explode("s").alias("shingle"))
    hits = probes.join(keys, (probes["shingle"] == keys["shingle"]) & (probes["n"] >= keys["need"]))
    candidates = written(hits.select("doc_id", "text_key", "item").distinct(), "leak-candidates")
    texts = docs.select("doc_id", F.xxhash64(text_of()).alias("text_key"), text_of().alias("text"))
    # A text goes once to all its candidates.
    of_text = candidates.groupBy("doc_id", "text_key").agg(F.collect_set("item").alias("found_items"))
    both = texts.join(
        of_text.withColumnsRenamed({"doc_id": "of_id", "text_key": "of_key"}),
        texts["doc_id"].eqNullSafe(F.col("of_id")) & (texts["text_key"] == F.col("of_key")),
    )
    whole = both.select("doc_id", "text_key", shingles(F.col("text"), width).alias("s"), F.explode("found_items").alias("item"))
    pairs = whole.join(items.select("item_id", "item", "all", "need"), "item")
    return (
        pairs.withColumn("shared", F.size(F.array_intersect("all", "s")))
        .where("shared >= need")
        .select("doc_id", "text_key", "item_id", F.col("shared").cast("long"), F.size("all").cast("long").alias("size"))
        .distinct()
    )


def clean(docs: DataFrame, items: DataFrame, least: float = 0.8, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    leaks = search(docs, items, least, width).select(F.col("doc_id").alias("leak_id"), "text_key").distinct()
    rows = kept_whole(docs, "doc_id", "text").withColumn("text_hash", F.xxhash64(text_of())).drop("text")
    same = rows["doc_id"].eqNullSafe(leaks["leak_id"]) & (rows["text_hash"] == leaks["text_key"])
    return rows.join(leaks, same, "left_anti").select("row.*")
