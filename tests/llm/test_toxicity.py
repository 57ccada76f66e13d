from __future__ import annotations

import math
import random
import zlib

import pyarrow as pa
import pytest
from names import CLASHING
from pyspark.sql import functions as F

from mixlens.llm import toxicity


def segments(scores, cost=0.5):
    """All maximal segments by definition, over every pair of ends."""
    sums = [0.0]
    for s in scores:
        sums.append(sums[-1] + s - cost)
    n = len(scores)

    def good(a, b):
        # Every proper beginning and end of a segment has a positive sum.
        return all(sums[k] > sums[a] for k in range(a + 1, b + 1)) and all(sums[k] < sums[b] for k in range(a, b))

    fits = [(a, b) for a in range(n) for b in range(a + 1, n + 1) if good(a, b)]
    return [(a, b - 1) for a, b in fits if not any((c <= a and b <= d) and (c, d) != (a, b) for c, d in fits)]


def test_maximal_segments_against_the_definition():
    rng = random.Random(2)
    table = {"aaaa": 2.0, "bbbb": 0.9, "cccc": -1.5, "dddd": 5.0}
    texts, want = [], []
    for _ in range(300):
        words = [rng.choice([*table, "none", "none", "none", "none"]) for _ in range(rng.randrange(30))]
        texts.append(" ".join(words))
        want.append(segments([table.get(w, 0.0) for w in words]))
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts)], names=["doc_id", "text"])
    (out,) = toxicity._scoring(table, 0.5)(iter([batch]))
    got = [[(s["first"], s["last"]) for s in row] for row in out.column(2).to_pylist()]
    assert got == want


def test_held_out_rows(spark):
    df = spark.range(50).select(toxicity.held_out(F.col("id")).alias("h"))
    assert [r.h for r in df.collect()] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(50)]


def planted(documents, spark, n=900):
    rng = random.Random(7)
    plain = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(400)]
    bad = ["scoundrel", "nitwit", "blockhead"]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(plain, k=rng.randrange(5, 200))
        toxic = i % 6 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(bad) + rng.choice(["", ",", "!"]) if k % 4 == 0 else rng.choice(plain) for k in range(20)]
        elif i % 10 == 1:
            words[rng.randrange(len(words))] = rng.choice(bad)
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return documents(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy_and_passages(spark, documents):
    docs, labels = planted(documents, spark)
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    assert len(got) > 200
    assert sum((r.score >= 0.7) == bool(r.toxic) for r in got) / len(got) > 0.97
    found = [max(r.segments, key=lambda s: s.score) for r in got if r.toxic]
    assert all(10 <= s.last - s.first <= 40 for s in found)
    # The labels of held-out rows are not used.
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit(docs, flipped) == model


def test_law_of_chance(spark):
    """lambda solves its equation."""
    rows = [(100, [3.0, 1.0])] * 10 + [(1000, [])] * 5
    rate = toxicity.decay_rate(spark.createDataFrame(rows, "n long, hits array<double>"))
    mean = (10 * (math.exp(rate * 2.9) + math.exp(rate * 0.9)) + 5980 * math.exp(-0.1 * rate)) / 6000
    assert mean == pytest.approx(1.0, abs=1e-6)


def test_edges(spark, documents):
    schema = "doc_id long, toxic int"
    none = toxicity.fit(documents([]), spark.createDataFrame([], schema))
    assert toxicity.score(documents([]), none).count() == 0
    docs = documents([(1, None), (1, None), (None, ""), (2, "word " * 100_000)], CLASHING)
    odd = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 1), (2, 0), (9, 1)], schema)
    got = toxicity.score(docs, toxicity.fit(docs, odd)).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)


def test_words_are_looked_up_once_and_single_scores_left_out():
    class Counting(dict):
        asked = 0

        def __contains__(self, word):
            Counting.asked += 1
            return super().__contains__(word)

    table = Counting({"vile": 2.0, "good": -1.5, "vilif*": 1.25, "goodly": 0.0})
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["vile", "good", "vilified", "goodly", "goodness", "plain"], k=400)) for _ in range(20)] + [""]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    (short,) = toxicity._scoring(table, 0.1, single=False)(iter([batch]))
    assert Counting.asked < 50 and short.schema.names == ["doc_id", "n", "segments"]
    (long,) = toxicity._scoring(table, 0.1)(iter([batch]))
    assert short.column(1).to_pylist() == long.column(1).to_pylist() and long.schema.names[-1] == "hits"
    assert short.column(2).to_pylist() == long.column(2).to_pylist() and short.column(2)[0].as_py()
