from __future__ import annotations

import random

import numpy as np
import pytest
from names import CLASHING
from pyspark.sql import functions as F

from mixlens.llm import topk, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows, extra=()):
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], SCHEMA)
    for name in extra:
        df = df.withColumn(name, F.lit(-7))
    return df


def whole(e):
    return e is not None and all(c is not None and np.isfinite(c) for c in e)


def brute(rows, k=20, every=20):
    """All scores of each query, sorted."""
    some = [(i, [int(np.floor(64 * float(np.float32(c)))) for c in e]) for i, e in rows if whole(e)]
    found = []
    for a, (i, x) in enumerate(some):
        if i is None or i % every:
            continue
        scores = [(-sum(p * q for p, q in zip(x, y)), j is None, j or 0, j) for b, (j, y) in enumerate(some) if a != b]
        for rank, (s, _, _, j) in enumerate(sorted(scores)[:k], 1):
            found.append((i, rank, j, -s))
    return sorted(found, key=str)


def search(spark, rows, k=20, every=20, extra=(), **sizes):
    grid = vectors.on_grid(frame(spark, rows, extra), 64)
    df = topk.top_k(grid, F.col("vec_id") % every == 0, k, **sizes)
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_against_all_products(spark, spread):
    """Vectors of like and of very different lengths, groups of near and of equal ones, in many small buckets."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12)) * np.exp(spread * rng.normal(size=(400, 1)))
    x[100:220] = x[0] + rng.normal(size=(120, 12)) * 0.02 * np.linalg.norm(x[0])
    x[220:300] = x[1]
    rows = [(int(i), [float(c) for c in e]) for i, e in zip(rng.permutation(400), x)]
    assert search(spark, rows, 7, 5, CLASHING, bucket=32, block=128) == brute(rows, 7, 5)


def test_edges(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(30)]
    rows += [(40, [0.0] * 4), (None, [0.5] * 4), (None, [0.5] * 4), (20, rows[20][1]), (-20, [0.9] * 4)]
    rows += [(60, None), (61, [None, 1.0, 1.0, 1.0]), (62, [float("nan")] * 4), (63, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(80, [0.25]), (81, []), (100, [0.5, 0.5, 0.5, 0.5, 0.5])]
    assert search(spark, rows, 50) == brute(rows, 50)
    assert search(spark, rows, 3, bucket=4, block=8) == brute(rows, 3)
    assert search(spark, []) == []
    assert search(spark, [(1, [1.0])]) == []
    assert search(spark, [(20, [1.0])]) == []


def test_large_numbers(spark):
    """Beyond what doubles hold exactly."""
    rows = [(i, [float(2**22 + i), float(3 * i), -float(2**21)]) for i in range(0, 60)]
    assert search(spark, rows, 4) == brute(rows, 4)


def test_confines():
    """No unit vector with the cosine or more is outside."""
    rng = np.random.default_rng(8)
    u, v = rng.normal(size=(2, 3000, 5))
    u, v = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (u, v))
    cosine = (u * v).sum(axis=1)
    for f in range(5):
        low, high = topk.confines(cosine, u[:, f])
        assert (low <= v[:, f]).all() and (v[:, f] <= high).all()


def test_a_cell_looks_at_few(monkeypatch):
    """High thresholds confine coordinates; low ones leave a beginning by length."""
    import pyarrow as pa

    rng = np.random.default_rng(9)
    x = np.rint(rng.normal(size=(300, 8)) * 400).astype(int)
    x[20:100] = np.tile(x[:20], (4, 1)) + rng.integers(-9, 9, (80, 8))
    x = np.rint(x * (1000 / np.linalg.norm(x, axis=1, keepdims=True))).astype(int)
    counted = {"confined": 0, "products": 0}
    for name in counted:
        plain = getattr(topk, name)

        def count(queries, *rest, name=name, plain=plain):
            counted[name] += len(queries)
            return plain(queries, *rest)

        monkeypatch.setattr(topk, name, count)
    scores = x[:20] @ x.T
    np.fill_diagonal(scores, -(10**9))
    for share in (0.2, 1.0):
        least = [int(s * share) for s in np.sort(scores, axis=1)[:, -3]]
        queries = pa.table({"q": range(20), "query_id": range(20), "x": x[:20].tolist(), "least": least})
        candidates = pa.table({"at": range(300), "vec_id": range(300), "x": x.tolist()})
        got = topk._cell(3)(queries, candidates).to_pylist()
        want = {(i, int(j)) for i in range(20) for j in np.lexsort((np.arange(300), -scores[i]))[:3]}
        assert {(r["q"], r["vec_id"]) for r in got} == want
    assert counted["confined"] > 5 and counted["products"] > 5


def test_query(spark, small, given):
    from mixlens.llm.queries import QUERIES

    got = sorted((tuple(r) for r in QUERIES["op11_top_products"](spark, small).collect()), key=str)
    assert got == brute(given("embeddings", "vec_id, embedding"))
