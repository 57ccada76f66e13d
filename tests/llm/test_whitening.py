from __future__ import annotations

from fractions import Fraction

import numpy as np
import pytest
from names import CLASHING
from pyspark.sql import functions as F

from mixlens.llm import whitening


def frame(spark, rows, extra=()):
    df = spark.createDataFrame([(i, e, 0) for i, e in rows], "vec_id long, embedding array<float>, label int")
    for name in extra:
        df = df.withColumn(name, F.lit(-7))
    return df.repartition(3)


def whole(e):
    return e is not None and all(c is not None and np.isfinite(c) for c in e)


def brute(rows, components=4):
    """(vec_id, component, n, deviation, whitened, explained) of each row, by fractions and another solver."""
    some = [(i, tuple(int(np.floor(256 * float(np.float32(c)))) for c in e)) for i, e in rows if whole(e)]
    points = sorted(set(x for _, x in some))
    n, d = len(points), len(points[0])
    sums = [sum(x[j] for x in points) for j in range(d)]
    z = np.array([[n * x[j] - sums[j] for j in range(d)] for x in points], object)
    exact = z.T @ z
    v = np.array([[float(Fraction(int(c), n**3)) for c in row] for row in exact])
    e, q = np.linalg.eigh(v)
    order = np.argsort(-e)[:components]
    found = []
    for i, x in some:
        away = np.array([n * x[j] - sums[j] for j in range(d)], object)
        for c, k in enumerate(order, 1):
            w = float((away / n).astype(float) @ q[:, k] / np.sqrt(e[k]))
            found.append((i, c, n, int(away @ away), w, float(e[k] / np.trace(v))))
    return found, q[:, order]


def check(got, want, components=4):
    """Equal up to the sign of each component."""
    assert len(got) == len(want)
    def key(r):
        return (str(r[0]), r[1], r[3], abs(r[4]))
    got, want = sorted(got, key=key), sorted(want, key=key)
    for c in range(1, components + 1):
        a, b = ([r for r in rows if r[1] == c] for rows in (got, want))
        assert [r[:4] for r in a] == [r[:4] for r in b]
        wa, wb = np.array([r[4] for r in a]), np.array([r[4] for r in b])
        sign = np.sign(wa @ wb)
        np.testing.assert_allclose(wa * sign, wb, rtol=0, atol=1e-9)
        np.testing.assert_allclose([r[5] for r in a], [r[5] for r in b], rtol=1e-10)


def run(spark, rows, extra=()):
    df = frame(spark, rows, extra)
    out = whitening.whiten(df, whitening.fit(df))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return out.collect()


def test_against_another_solver(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 9)) @ rng.normal(size=(9, 9)) * 0.3 + 3
    rows = [(i, [float(c) for c in e]) for i, e in enumerate(x)] + [(1000 + i, [float(c) for c in x[7]]) for i in range(150)]
    rows += [(2000, None), (2001, [None] * 9), (2002, [float("nan")] * 9), (2003, [float("-inf")] * 9), (None, [float(c) for c in x[8]])]
    got = run(spark, rows, CLASHING)
    want, _ = brute(rows)
    check([(r[0], r[1], r[2], int(r[3]), r[4], r[5]) for r in got], want)
    errors = {r.identity_error for r in got}
    assert len(errors) == 1 and 0 <= errors.pop() < 1e-10


def test_leading_eigenvalues():
    rng = np.random.default_rng(6)
    for d in (1, 2, 3, 10, 64):
        for _ in range(6):
            a = rng.normal(size=(d, 2 * d))
            v = a @ a.T
            e, q = np.linalg.eigh(v)
            values, found = whitening.leading(v, 4)
            np.testing.assert_allclose(values, e[::-1][:4], rtol=1e-11)
            np.testing.assert_allclose(np.abs((found * q[:, ::-1][:, : len(values)]).sum(axis=0)), 1, rtol=1e-11)


def test_close_and_equal_eigenvalues():
    rng = np.random.default_rng(7)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    for e in ([5, 5 - 1e-7, 5 - 2e-7, 5 - 3e-7, 1], [3, 3, 3, 3, 3, 1], [2, 2, 1, 1, 0.5], [4, 0, 0, 0, 0], [0] * 5):
        v = (q[:, : len(e)] * e) @ q[:, : len(e)].T
        v = (v + v.T) / 2
        values, found = whitening.leading(v, 4)
        np.testing.assert_allclose(values, e[:4], atol=1e-12)
        np.testing.assert_allclose(found.T @ found, np.eye(4), atol=1e-7)
        np.testing.assert_allclose(v @ found, found * values, atol=1e-11)


def test_inertia():
    rng = np.random.default_rng(8)
    for d in (1, 2, 5, 20):
        for _ in range(20):
            a = rng.normal(size=(d, d))
            v = a + a.T
            e = np.linalg.eigvalsh(v)
            for shift in (-1.0, 0.0, 0.3, 2.5):
                assert whitening.above(v, shift) == (e > shift).sum()
    zeros = np.zeros((6, 6))
    zeros[0, 5] = zeros[5, 0] = zeros[2, 3] = zeros[3, 2] = 1
    assert whitening.above(zeros, 0.0) == 2


def test_products_are_exact():
    rng = np.random.default_rng(9)
    for most in (300, 10**7, 10**9):
        y = rng.integers(-most, most, (50, 3))
        assert (whitening.products_of(y) == y.astype(object).T @ y.astype(object)).all()


def test_edges(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, [])]) == []
    # One vector alone, and repeated: nothing varies.
    got = run(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    assert [(r.vec_id, r.component, r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in sorted(got)] == [
        (i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)
    ]
    # Two vectors: one direction has all variance, others have none.
    got = sorted(run(spark, [(1, [0.5, 0.25, 1.0]), (2, [0.25, 0.25, 1.0])]))
    assert [(r.vec_id, r.component) for r in got] == [(i, c) for i in (1, 2) for c in (1, 2, 3)]
    assert [abs(r.whitened) if r.whitened is not None else None for r in got] == [pytest.approx(1.0), None, None] * 2
    assert [r.explained for r in got][:3] == [1.0, 0.0, 0.0] and got[0].identity_error < 1e-12
    # Other lengths than the commonest take no part; large values stay exact.
    rows = [(i, [float(2**30 + 4096 * i * i), 128.0 * (i % 5) - 2.0**29]) for i in range(40)] + [(50, [1.0]), (51, [])]
    got = run(spark, rows)
    want, _ = brute(rows[:40], 2)
    check([(r[0], r[1], r[2], int(r[3]), r[4], r[5]) for r in got], want, 2)


def test_query(spark, small, given):
    from mixlens.llm.queries import QUERIES

    got = QUERIES["op13_whiten"](spark, small).collect()
    want, _ = brute(given("embeddings", "vec_id, embedding"))
    check([(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in got], want)
    assert got[0].identity_error < 1e-10
