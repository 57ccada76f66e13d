from __future__ import annotations

import re
from collections import Counter

import pytest
from names import CLASHING
from pyspark.sql import functions as F

from mixlens.llm import quality
from mixlens.llm.common import text_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The contract's counts, one text at a time."""
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    symbols = sum((text or "").count(c) for c in quality.SYMBOLS)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


ODD = [
    None, "", " \n\t", "a", "a b c d", "a b c d e", "a b c d e a b c d e", "x x x x x x x x x", "é 😀 ü\x0b\x0cñ\r\nz\n\n \nz",
    "#*$%&|<> ##", "l1\nl2\nl1\n\n\nl2\nl1", "\x1c\x85   a b", "a b c d e f " * 300, " ".join(f"w{i % 97}" for i in range(5000)),
]


def test_counts_against_brute_force(spark, documents, given):
    data = list(enumerate(ODD)) + [(i + 100, t) for i, t in given("documents", "doc_id, text")]
    got = {r.doc_id: r for r in quality.assess(documents(data)).collect()}
    assert len(got) == len(data)
    for i, text in data:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(text), repr(text)[:80]
        assert not (r.kept and r.base_failed)


def test_against_labels(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.assess(docs).join(labels, "doc_id").where("not base_failed").collect()
    good = [r.kept for r in got if r.quality == 1]
    bad = [r.kept for r in got if r.quality == 0]
    assert sum(good) / len(good) > 0.97
    assert sum(bad) / max(1, len(bad)) < 0.2


def test_estimation_finds_planted_accuracies(spark):
    """Rules of known rates on a known class, drawn by hash."""
    names = [f"r{i}" for i in range(5)]
    rates = {"r0": (0.9, 0.1), "r1": (0.8, 0.2), "r2": (0.85, 0.3), "r3": (0.95, 0.15), "r4": (0.7, 0.4)}

    def draw(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10_000)) / 10_000

    df = spark.range(20_000).withColumn("good", draw("class") < 0.7)
    for n in names:
        rate = F.when(F.col("good"), rates[n][0]).otherwise(rates[n][1])
        df = df.withColumn(n, F.when(draw(n) < rate, 1).otherwise(-1))
    model = quality.fit(df, names, rounds=100, belief=0.0)
    assert model.share == pytest.approx(0.7, abs=0.05)
    for n in names:
        assert model.up[n] == pytest.approx(rates[n], abs=0.06)
    p = quality.posterior({n: F.col(n) for n in names}, model)
    right = df.where((p >= 0.5) == F.col("good")).count()
    assert right > 0.93 * 20_000


def test_edges(documents):
    assert quality.assess(documents([])).count() == 0
    assert quality.keep_good(documents([])).count() == 0
    prose = "Here are quite enough ordinary words to make one sentence of common prose, and it ends now."
    docs = documents([(1, prose), (1, prose), (None, prose + " Another one follows."), (2, None)], CLASHING)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 1]
    assert docs.select(quality.counts(text_of())["n_words"]).count() == 4


def test_estimation_follows_a_corpus_of_few_good_documents(spark, caplog):
    names = [f"r{i}" for i in range(5)]

    def draw(salt):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(10_000)) / 10_000

    df = spark.range(20_000).withColumn("good", draw("class") < 0.3)
    for n in names:
        df = df.withColumn(n, F.when(draw(n) < F.when(F.col("good"), 0.9).otherwise(0.2), 1).otherwise(-1))
    model = quality.fit(df, names, rounds=100)
    assert model.share == pytest.approx(0.3, abs=0.05)
    assert not caplog.text
    quality.fit(df, names, rounds=2)
    assert "after 2 rounds" in caplog.text
