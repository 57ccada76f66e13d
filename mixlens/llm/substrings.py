"""Substring deduplication: passages of many words that an earlier document has already.

Seeds are winnowed: of the short word windows inside each passage of ``length``
words the one of least hash is its anchor, so equal passages have equal anchors
and a document has few of them. Only anchors that two documents share are
extended, to both sides, to the passages they stand for; a passage is a repeat
where a document of smaller doc_id has it too. Repeats that overlap make up a
document's maximal repeats, and their words are removed.

A shared anchor is never expanded into pairs of documents: anchors and passages
meet as counts and minima, which combine before they are shuffled, and joins on
them can be split by Spark where a key is hot.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import release, text_of, written
from mixlens.llm.hashing import slices, text_bytes, window_hashes, word_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH, SEED = 13, 5


def least_seeds(seeds, ends, length: int, seed: int):
    """(least seed hash inside each passage, offsets of the texts' passages)."""
    import numpy as np

    span = length - seed + 1
    count = np.maximum(np.diff(ends) - span + 1, 0)
    passages = np.concatenate([[0], np.cumsum(count)])
    if not passages[-1]:
        return np.zeros(0, np.uint64), passages
    n = len(seeds) - span + 1
    least = seeds[:n].copy()
    for i in range(1, span):
        np.minimum(least, seeds[i : i + n], out=least)
    return least[np.repeat(ends[:-1] - passages[:-1], count) + np.arange(passages[-1])], passages


def _anchoring(length: int, seed: int) -> Callable:
    """The anchors of each row, every one once: doc_id, key, anchor."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 2):
                words, bounds, _, _ = word_hashes(*text_bytes(part.column(2)))
                seeds, ends, _ = window_hashes(words, bounds, seed)
                least, passages = least_seeds(seeds, ends, length, seed)
                row = np.repeat(np.arange(len(part)), np.diff(passages))
                order = np.lexsort((least, row))
                least, row = least[order], row[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (least[1:] != least[:-1])
                row = pa.array(row[new])
                columns = [part.column(0).take(row), part.column(1).take(row), pa.array(least[new].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "anchor"])

    return run


def _extending(length: int, seed: int) -> Callable:
    """The passages around shared anchors: doc_id, key, two hashes of the passage, its first word."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 2):
                words, bounds, _, _ = word_hashes(*text_bytes(part.column(2)))
                seeds, ends, _ = window_hashes(words, bounds, seed)
                least, passages = least_seeds(seeds, ends, length, seed)
                shared = part.column(3)
                values, at = shared.values.to_numpy().view(np.uint64), shared.offsets.to_numpy()
                found = [np.zeros(0, np.int64)]
                for i, (a, b) in enumerate(zip(passages[:-1], passages[1:])):
                    if b > a and at[i + 1] > at[i]:
                        found.append(a + np.flatnonzero(np.isin(least[a:b], values[at[i] : at[i + 1]])))
                take = np.concatenate(found)
                row = np.searchsorted(passages, take, side="right") - 1
                one, _, _ = window_hashes(words, bounds, length, 1)
                two, _, _ = window_hashes(words, bounds, length, 2)
                rows = pa.array(row)
                columns = [
                    part.column(0).take(rows),
                    part.column(1).take(rows),
                    pa.array(one[take].view(np.int64)),
                    pa.array((two[take] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                    pa.array((take - passages[row]).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "one", "two", "first"])

    return run


def _removing(length: int) -> Callable:
    """Each row's number of words, its maximal repeats as word ranges, and the words that are left."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        spans = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in slices(batch, 1):
                n, ranges, kept = [], [], []
                for text, copy, firsts in zip(*(part.column(i).to_pylist() for i in (1, 2, 3))):
                    words = text.encode().split()
                    merged: list[list[int]] = []
                    if copy and len(words) >= length:
                        merged = [[0, len(words)]]
                    for first in sorted(firsts or ()) if not merged else ():
                        if merged and first <= merged[-1][1]:
                            merged[-1][1] = first + length
                        else:
                            merged.append([first, first + length])
                    left, at = [], 0
                    for a, b in merged:
                        left += words[at:a]
                        at = b
                    left += words[at:]
                    n.append(len(words))
                    ranges.append([{"first": a, "end": b} for a, b in merged])
                    kept.append(b" ".join(left).decode())
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ranges, spans), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "repeats", "kept"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, repeats (array of word ranges) and kept (the words that are left, by one space) of each row.

    A document with another's whole text and a larger id loses all its words, if
    it has ``length``; only the least id of each text takes part in the search.
    Null texts have no words. Rows of one id are not smaller than each other, so
    they don't repeat each other; a null id is neither smaller nor larger than
    any. Equal rows get equal results. Other columns play no part.
    """
    spark = docs.sparkSession
    kind = docs.schema["doc_id"].dataType.simpleString()
    # The hash tells rows of one id apart, and an anchor in two texts from one in two copies of a text.
    rows = docs.select("doc_id", F.xxhash64(text_of()).alias("key"), text_of().alias("text"))
    digests = rows.select("doc_id", "key", F.unhex(F.md5("text")).alias("digest"))
    least = digests.groupBy("digest").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")).where("n > 1")
    copies = digests.join(least, "digest").where("doc_id > least_id").select("doc_id", "key").distinct()
    copies = written(copies, "repeat-copies")

    anchors = rows.mapInArrow(_anchoring(length, seed), f"doc_id {kind}, key long, anchor long")
    of_texts = anchors.groupBy("anchor").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    shared = written(of_texts.where("low < high").select("anchor"), "repeat-anchors")
    release(spark)
    seeds = anchors.join(shared, "anchor").groupBy("doc_id", "key").agg(F.collect_set("anchor").alias("anchors"))
    seeds = written(seeds, "repeat-seeds")
    release(spark)

    searched = seeds.join(copies, _same(seeds, copies), "left_anti")
    both = rows.join(searched, _same(rows, searched)).select(rows["doc_id"], rows["key"], "text", "anchors")
    passages = both.mapInArrow(_extending(length, seed), f"doc_id {kind}, key long, one long, two int, first int")
    passages = written(passages, "repeat-passages")
    release(spark)
    first = passages.groupBy("one", "two").agg(F.min("doc_id").alias("least_id"), F.max("doc_id").alias("last_id"))
    # As a table of its own it is joined right after its shuffle, so that Spark can split a hot passage.
    first = written(first.where("least_id < last_id").drop("last_id"), "repeat-first")
    release(spark)
    repeated = passages.join(first, ["one", "two"])
    starts = repeated.where("doc_id > least_id").groupBy("doc_id", "key").agg(F.collect_set("first").alias("firsts"))
    starts = written(starts, "repeat-starts")
    release(spark)

    found = starts.withColumn("copy", F.lit(False)).unionByName(
        copies.select("doc_id", "key", F.array().cast("array<int>").alias("firsts"), F.lit(True).alias("copy"))
    )
    given = rows.join(found, _same(rows, found), "left").select(rows["doc_id"], "text", F.coalesce("copy", F.lit(False)).alias("copy"), "firsts")
    return given.mapInArrow(
        _removing(length), f"doc_id {kind}, n_words long, repeats array<struct<first: int, end: int>>, kept string"
    )


def _same(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["key"] == b["key"])
