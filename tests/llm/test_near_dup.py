from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from names import CLASHING
from pyspark.sql import functions as F

from mixlens.llm import near_dup
from mixlens.llm.components import components
from mixlens.llm.pivots import pivot_links


class Groups(dict):
    def find(self, x):
        self.setdefault(x, x)
        while self[x] != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self[max(a, b)] = min(a, b)


def brute(docs):
    """Classes by comparing all pairs of texts: weights by definition, weighted Jaccard similarity."""
    texts = [(t or "").encode().split() for _, t in docs]
    sets = [Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else []) for w in texts]
    df = Counter(g for s in sets for g in s)
    n = len(docs)

    def weight(g, times, full):
        idf = 0.0
        if df[g] > max(1.0, 0.01 * n) and not full:
            idf = math.log2(0.02 + 0.98 * max(0, min(1, math.log(min(1, df[g] / n)) / math.log(0.01))) ** 2)
        return 2 ** (np.rint((np.log2(times) + np.float32(idf)) * 4) / 4)

    weights = [[{g: weight(g, k, full) for g, k in s.items()} for s in sets] for full in (False, True)]

    def similar(a, b, full):
        wa, wb = weights[full][a], weights[full][b]
        least = sum(min(w, wb[g]) for g, w in wa.items() if g in wb)
        total = sum(wa.values()) + sum(wb.values()) - least
        return bool(total) and least / total >= 0.8 - 1e-9

    groups = Groups()
    for a in range(n):
        groups.find(a)
        for b in range(a):
            if (docs[a][1] or "") == (docs[b][1] or "") or similar(a, b, False) or similar(a, b, True):
                groups.join(a, b)
    return {docs[i][0]: docs[groups.find(i)][0] for i in range(n)}


def corpus(seed=1, n=220):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs = []
    for i in range(n):
        if docs and rng.random() < 0.45:
            words = list(docs[rng.randrange(len(docs)) if rng.random() < 0.7 else 0][1].split())
            for _ in range(rng.choice([0, 1, 1, 2, 4, 8])):
                if words:
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = rng.choices(vocabulary, k=rng.choice([1, 3, 6, 40, 90, 150, 400]))
            if rng.random() < 0.3:
                words += [f"common{k}" for k in range(60)]
        docs.append((i, " ".join(words)))
    return docs + [(n, None), (n + 1, ""), (n + 2, "w1 " * 3000)]


def test_a_large_group_of_near_copies_beside_a_shared_passage(documents):
    rng = random.Random(8)
    words = [f"u{i}" for i in range(120)]
    docs = []
    for i in range(400):
        if i % 4 == 0:
            mine = list(words)
            mine[rng.randrange(120)] = f"x{i}"
        else:
            mine = [f"p{k}" for k in range(60)] + [f"o{i}w{k}" for k in range(40)]
        docs.append((i, " ".join(mine)))
    got = {r.doc_id: r.class_id for r in near_dup.classes(documents(docs)).collect()}
    assert got == {i: 0 if i % 4 == 0 else i for i in range(400)}


def test_copies_that_differ_more_and_more(documents):
    """A crowd of variants of one text, from near copies to hardly alike ones, some of a variant that is no copy itself."""
    rng = random.Random(14)
    words, docs, texts = [f"u{i}" for i in range(150)], [], []
    for i in range(260):
        mine = list(rng.choice(texts)) if texts and i % 4 == 0 else list(words)
        for _ in range(rng.choice([1, 2, 3, 5, 6, 7, 9, 14, 30])):
            at = rng.randrange(len(mine))
            mine[at : at + rng.choice([1, 1, 1, 4])] = [rng.choice(words)] if rng.random() < 0.2 else [f"x{i}-{rng.randrange(10**6)}"]
        texts.append(mine)
        docs.append((i, " ".join(mine)))
    docs += [(300 + i, " ".join(f"o{i}w{k}" for k in range(60))) for i in range(40)]
    got = {r.doc_id: r.class_id for r in near_dup.classes(documents(docs)).collect()}
    assert got == brute(docs)
    sizes = Counter(got.values()).values()
    assert max(sizes) > 40 and sum(s == 1 for s in sizes) > 60 and sum(1 < s < 10 for s in sizes) > 2


def test_classes_against_all_pairs(documents):
    docs = corpus()
    got = {r.doc_id: r.class_id for r in near_dup.classes(documents(docs)).collect()}
    assert got == brute(docs)
    assert len(set(got.values())) < len(got) - 40


def test_draws_agree_as_often_as_sets_are_similar():
    """The sampling scheme's promise, over sets with different weights."""
    rng = np.random.default_rng(5)
    shingles = near_dup.keys(400, 9)
    a, b = rng.integers(-4, 9, 400), rng.integers(-4, 9, 400)
    b[:200] = a[:200]
    mine, other = np.arange(0, 320), np.arange(80, 400)
    wa, wb = np.zeros(400), np.zeros(400)
    wa[mine], wb[other] = 2.0 ** (a[mine] / 4), 2.0 ** (b[other] / 4)
    similarity = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    own, equal = near_dup.mixed(shingles) >> np.uint64(32), 0
    for k in range(600):
        pool = near_dup._pool(k)
        at = (near_dup.mixed(shingles + np.uint64(k)) >> np.uint64(64 - near_dup.POOL_BITS)).astype(np.int64)
        one = (near_dup.sampled(pool, at[mine], a[mine].astype(float)) ^ own[mine]).min()
        two = (near_dup.sampled(pool, at[other], b[other].astype(float)) ^ own[other]).min()
        equal += one == two
    assert equal / 600 == pytest.approx(similarity, abs=0.07)


def test_sketches_part_pairs_by_their_similarity(spark):
    """They differ as often as the draws' law says: similar pairs pass, those far below the limit don't."""
    rows, similarity = [], []
    for i, replaced in enumerate([0, 1, 5, 12, 13, 40, 60] * 40):
        words = [f"q{i}w{k}" for k in range(120)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[: 120 - replaced] + [f"z{i}w{k}" for k in range(replaced)]))]
        similarity.append((116 - replaced) / (116 + replaced))
    texts = spark.createDataFrame(rows, "node long, text string")
    sketches = texts.mapInArrow(near_dup._sketching(b""), "node long, sketch array<long>")
    pairs = sketches.where("node % 2 = 0").selectExpr("node div 2 as i", "sketch as one")
    pairs = pairs.join(sketches.where("node % 2 = 1").selectExpr("node div 2 as i", "sketch as other"), "i")
    told = {r.i: r.told for r in pairs.select("i", near_dup.unlike()(F.col("one"), F.col("other")).alias("told")).collect()}
    assert len(told) == 280
    for i, s in enumerate(similarity):
        assert not told[i] if s >= 0.8 else told[i] or s > 0.55
    assert near_dup.most_apart(1.0) == 0 and near_dup.most_apart(0.8) == 118


def test_sketches_follow_weights(spark):
    """Common shingles weigh less in the draws as well: texts whose rare words agree pass, in full they don't."""
    common, own = [f"c{k}" for k in range(130)], [f"o{k}" for k in range(64)]
    other = [f"d{k}" for k in range(130)]
    both = [(0, " ".join(own + common)), (1, " ".join(own + other))]
    data = [np.frombuffer(" ".join(x).encode(), np.uint8) for x in (common, other)]
    shingles = np.unique(np.concatenate([near_dup.shingle_sets(d, np.array([0, len(d)]))[0] for d in data]))
    idf = shingles.tobytes() + np.full(len(shingles), math.log2(0.02), np.float32).tobytes()
    texts = spark.createDataFrame(both, "node long, text string")
    told = []
    for weights in (idf, b""):
        rows = texts.mapInArrow(near_dup._sketching(weights), "node long, sketch array<long>").orderBy("node").collect()
        pair = spark.createDataFrame([(rows[0].sketch, rows[1].sketch)], "one array<long>, other array<long>")
        told.append(pair.select(near_dup.unlike()(F.col("one"), F.col("other"))).first()[0])
    assert told == [False, True]


def test_one_of_each(documents):
    docs = corpus(2, 120)
    want = sorted(set(brute(docs).values()))
    df = documents(docs + docs[:10], CLASHING)
    got = near_dup.one_of_each(df)
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == want


def test_edges(documents):
    same = "one two three four five six seven"
    docs = documents([(4, same), (2, same), (2, same), (None, same), (None, "other words"), (9, None), (8, "")])
    got = sorted(((r.doc_id, r.class_id, r.n_copies) for r in near_dup.classes(docs).collect()), key=str)
    assert got == sorted([(4, 2, 4), (2, 2, 4), (2, 2, 4), (None, 2, 4), (None, None, 1), (9, 8, 2), (8, 8, 2)], key=str)
    assert near_dup.classes(documents([])).count() == 0
    assert near_dup.one_of_each(documents([])).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(i, i + 1) for i in range(300, 340)]
    edges += [(900, 500 + i) for i in range(30)]
    groups = Groups()
    for a, b in edges:
        if a != b:
            groups.join(a, b)
    frame = spark.createDataFrame([*edges, (None, 5)], "a long, b long")
    assert {r.node: r.root for r in components(frame).collect()} == {x: groups.find(x) for x in list(groups)}


@pytest.mark.parametrize("share", [None, 0])
def test_few_links_are_one_tasks_share(spark, monkeypatch, share):
    from mixlens.llm import common

    if share is not None:
        monkeypatch.setattr(common, "SHARE", share)
    links = [(x, x + 1) for x in range(40)] + [(100, 102), (101, 102)]
    context, held = spark.sparkContext, {"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    context.setJobGroup(f"few-links-{share}", "")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        context.setLocalProperty("spark.jobGroup.id", None)
    assert found == {**{x: 0 for x in range(41)}, **{x: 100 for x in (100, 101, 102)}}
    told = context.statusTracker()
    jobs = [told.getJobInfo(j) for j in told.getJobIdsForGroup(f"few-links-{share}")]
    stages = [told.getStageInfo(s) for j in jobs for s in j.stageIds]
    # Dealt out to all shuffle partitions, each round takes some hundred tasks.
    assert (max(s.numTasks for s in stages if s) < 211) == (share is None)


def test_pivots_lose_no_link(spark):
    """Points on a line in random buckets: everything that close pairs connect is connected."""
    rng = random.Random(6)
    points = {i: rng.choice([0, 3, 3.5, 9, 20]) + rng.random() * rng.choice([0.2, 4]) for i in range(120)}
    members = {(rng.randrange(6), i) for i in points for _ in range(2)}
    where = spark.createDataFrame(list(points.items()), "id long, x double")

    def compare(pairs):
        both = pairs.join(where.toDF("a", "xa"), "a").join(where.toDF("b", "xb"), "b")
        return both.selectExpr("a", "b", "abs(xa - xb) as far")

    links = pivot_links(spark.createDataFrame(sorted(members), "bucket long, node long"), compare, 0.3).collect()
    got, want = Groups(), Groups()
    for a, b in links:
        assert abs(points[a] - points[b]) <= 0.3
        got.join(a, b)
    for k, a in members:
        for j, b in members:
            if k == j and a < b and abs(points[a] - points[b]) <= 0.3:
                want.join(a, b)
    assert {i: got.find(i) for i in points} == {i: want.find(i) for i in points}
    assert len({got.find(i) for i in points}) < 100


def test_a_crowd_that_nothing_tells_apart_meets_each_pair_once(spark, monkeypatch):
    """All members are pivots in the end, and share buckets; nobody is near anybody."""
    from mixlens.llm import pivots

    tables = []

    def noted(df, name, *folders):
        found = real(df, name, *folders)
        tables.append((name, found))
        return found

    real = pivots.written
    monkeypatch.setattr(pivots, "written", noted)
    members = [(b, i) for b in (1, 2, 3) for i in range(60) if b < 3 or i % 2]
    frame = spark.createDataFrame(members, "bucket long, node long")
    assert pivot_links(frame, lambda pairs: pairs.withColumn("far", F.lit(1.0)), 0.2, 8).count() == 0
    met = Counter((r.a, r.b) for name, t in tables if name == "pairs" for r in t.collect())
    assert set(met.values()) == {1} and len(met) == 60 * 59 // 2
    # 1, 8 and 64 pivots: the last round takes all that are left.
    assert sum(name == "pivots" for name, _ in tables) == 3


def test_draws_of_all_bands_take_few_tables():
    """The tables that a Python worker keeps, and bands that meet as often as the law says, for sets of similarity 0.8 and 0.4."""
    import pyarrow as pa

    texts, n = [], 400
    for i in range(n):
        words = [f"m{i}w{k}" for k in range(184)]
        for changed in (20, 77):
            texts += [" ".join(words), " ".join(words[: 184 - changed] + [f"z{i}c{changed}w{k}" for k in range(changed)])]
    np.__dict__.pop("_kept_draws", None)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    bands = [np.array(x) for out in near_dup._signing(b"")([batch]) for x in out.column(2).to_pylist()]
    held = [x for tables in np.__dict__.pop("_kept_draws").values() for pool, ready in tables for x in (*pool, ready)]
    assert sum(x.nbytes for x in held) < 16 << 20
    for start, similarity in ((0, 160 / 200), (2, 103 / 257)):
        same = np.array([bands[4 * i + start] == bands[4 * i + start + 1] for i in range(n)])
        assert same.mean() == pytest.approx(similarity**near_dup.ROWS, abs=0.03)
        missed = (1 - similarity**near_dup.ROWS) ** near_dup.BANDS
        assert (~same.any(axis=1)).mean() == pytest.approx(missed, abs=0.08 if missed > 0.01 else 0.005)
