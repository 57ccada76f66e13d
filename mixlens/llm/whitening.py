"""Whitening of vectors by the leading eigenvectors of their covariance, found by spectrum slicing.

Vectors lie on a grid of whole numbers, so sums and covariances are exact
however Spark spreads the rows: tasks add whole products, and only the final
quotient is rounded. Eigenvalues are found on the driver, which holds one matrix
of the vectors' dimensions: the inertia of the shifted covariance, from its
LDL^T factors, tells how many eigenvalues lie above the shift; bisection
isolates each leading eigenvalue, Rayleigh quotient iteration converges to it,
and two more counts certify its number.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import written
from mixlens.llm.vectors import matrix, on_grid

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE, COMPONENTS = 256, 4
#: Below this value a pivot counts less than what stands beside it (Bunch and Kaufman).
ALPHA = (1 + 17**0.5) / 8


@dataclass
class Whitening:
    """n fitted vectors with sums per dimension; eigenvalues, falling, and unit eigenvectors as columns; what they explain."""

    n: int
    sums: list[int]
    values: list[float]
    vectors: list[list[float]]
    trace: float
    identity_error: float | None


def above(v, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above the shift.

    By Sylvester's law of inertia these are the positive ones of D in the LDL^T
    factors of the shifted matrix; pivots are single numbers or blocks of two,
    which have one eigenvalue of each sign.
    """
    import numpy as np

    a = np.array(v, np.float64) - shift * np.eye(len(v))
    k = positive = 0
    while k < len(a):
        beside = np.abs(a[k + 1 :, k])
        most = beside.max(initial=0.0)
        if not most:
            positive += int(a[k, k] > 0)
            k += 1
            continue
        double = False
        if abs(a[k, k]) < ALPHA * most:
            r = k + 1 + int(beside.argmax())
            column = np.abs(a[k:, r])
            column[r - k] = 0
            if abs(a[k, k]) * column.max() < ALPHA * most**2:
                double = abs(a[r, r]) < ALPHA * column.max()
                to = k + 1 if double else k
                a[[to, r]] = a[[r, to]]
                a[:, [to, r]] = a[:, [r, to]]
        if double:
            c = a[k + 2 :, k : k + 2]
            a[k + 2 :, k + 2 :] -= c @ np.linalg.solve(a[k : k + 2, k : k + 2], c.T)
            positive += 1
            k += 2
        else:
            c = a[k + 1 :, k]
            a[k + 1 :, k + 1 :] -= np.outer(c, c / a[k, k])
            positive += int(a[k, k] > 0)
            k += 1
    return positive


def leading(v, count: int):
    """(eigenvalues, unit eigenvectors as columns) of the ``count`` greatest eigenvalues of a symmetric matrix, falling.

    A value that differs from its neighbours by less than rounding is one of a
    cluster; its vectors are then any orthonormal ones of the cluster's space. The
    entry of greatest magnitude of each vector is positive.
    """
    import numpy as np

    v = np.array(v, np.float64)
    d = len(v)
    count = min(count, d)
    bound = float(np.abs(v).sum(axis=1).max(initial=0.0))
    if not bound:
        return np.zeros(count), np.eye(d)[:, :count]
    # By Gershgorin no eigenvalue is beyond the bound. What is closer than ``blur`` can't be told apart.
    blur = 4 * d * np.finfo(float).eps * bound
    counts = {-2 * bound: d, 2 * bound: 0}

    def number(shift: float) -> int:
        if shift not in counts:
            counts[shift] = above(v, shift)
        return counts[shift]

    values, vectors = [], np.zeros((d, 0))
    for i in range(1, count + 1):
        low = max(s for s, c in counts.items() if c >= i)
        high = min(s for s, c in counts.items() if c < i)

        def halve(low: float, high: float) -> tuple[float, float]:
            middle = (low + high) / 2
            return (middle, high) if number(middle) >= i else (low, middle)

        while high - low > blur and (counts[low] > i or counts[high] < i - 1):
            low, high = halve(low, high)
        x = np.sin(np.arange(1, d + 1) * (1.0 + i))
        shift, before = (low + high) / 2, np.inf
        for _ in range(200):
            alone = high - low > blur
            try:
                y = np.linalg.solve(v - shift * np.eye(d), x)
            except np.linalg.LinAlgError:
                y = np.full(d, np.inf)
            if not np.isfinite(y).all():
                # The shift is an eigenvalue to the last bit.
                shift += blur / 8
                continue
            y /= np.abs(y).max()
            if not alone:
                y -= vectors @ (vectors.T @ y)
            x = y / np.linalg.norm(y)
            rho = float(x @ v @ x)
            residual = float(np.linalg.norm(v @ x - rho * x))
            if low - blur <= rho <= high + blur and (residual > blur or residual < before / 2):
                # Cubic convergence inside the slice; stops when rounding is all that is left.
                shift, before = rho, residual
            elif low - blur <= rho <= high + blur and number(rho - 2 * blur) >= i and number(rho + 2 * blur) < i:
                break
            else:
                # It went for a neighbour: a narrower slice has this one nearer to its middle.
                if alone:
                    low, high = halve(low, high)
                shift, before = (low + high) / 2, np.inf
        else:
            raise RuntimeError(f"eigenvalue {i} did not settle")
        x = x * np.sign(x[np.abs(x).argmax()])
        values.append(rho)
        vectors = np.column_stack([vectors, x])
    return np.array(values), vectors


def products_of(y):
    """The exact products of a matrix of whole numbers, transposed, with itself, as Python's numbers."""
    import numpy as np

    total = np.zeros((y.shape[1], y.shape[1]), object)
    most = float(np.abs(y.astype(np.float64)).max(initial=1.0))
    step = int(2**53 / most**2)
    if not step:
        big = y.astype(object)
        return total + big.T @ big
    for a in range(0, len(y), step):
        part = y[a : a + step].astype(np.float64)
        total += (part.T @ part).astype(np.int64).astype(object)
    return total


def _summing() -> Callable:
    """Number (at place -1) and sums per dimension of the task's vectors."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        n, total = 0, 0
        for batch in batches:
            x = matrix(batch.column(0))
            n += len(x)
            total = total + x.astype(object).sum(axis=0) if np.abs(x.astype(float)).max(initial=0) > 2**40 else total + x.sum(axis=0).astype(object)
        values = [n, *(total if n else [])]
        sums = pa.array([Decimal(int(t)) for t in values], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(values) - 1), pa.int32()), sums], names=["i", "total"])

    return run


def _multiplying(centre: list[int]) -> Callable:
    """Sums of products of the task's vectors, less the centre."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = 0
        for batch in batches:
            total = total + products_of(matrix(batch.column(0)) - np.array(centre, np.int64))
        if isinstance(total, int):
            return
        i, j = np.triu_indices(len(centre))
        sums = pa.array([Decimal(int(t)) for t in total[i, j]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), sums], names=["i", "j", "total"])

    return run


def projected(x, n: int, sums: list[int], values: list[float], vectors: list[list[float]]):
    """(whole numbers n * x - sums, whitened components) of a matrix of vectors."""
    import numpy as np

    bound = n * float(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, sums), default=0)
    if len(sums) * bound**2 < 2**62:
        away = n * x - np.array(sums, np.int64)
    else:
        away = n * x.astype(object) - np.array(sums, object)
    with np.errstate(divide="ignore", invalid="ignore"):
        whitened = (away / n).astype(np.float64) @ np.array(vectors) / np.sqrt(np.array(values))
    return away, whitened


def _whitening(n: int, sums: list[int], values: list[float], vectors: list[list[float]]) -> Callable:
    """vec_id, deviation and the components of each row; components without variance are null."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            away, whitened = projected(matrix(batch.column(1)), n, sums, values, vectors)
            deviation = pa.array([Decimal(int(t)) for t in (away * away).sum(axis=1)], pa.decimal128(38, 0))
            flat = pa.array(whitened.ravel(), pa.float64(), mask=np.tile(np.array(values) <= 0, len(whitened)))
            ends = pa.array(np.arange(len(whitened) + 1) * len(values), pa.int32())
            columns = [batch.column(0), deviation, pa.ListArray.from_arrays(ends, flat)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "deviation", "whitened"])

    return run


def _commonest_length(x: DataFrame) -> int:
    """The length that most vectors have, the greater one of a tie; 0 if there are none."""
    found = x.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return found["d"] if found else 0


def _rows(x: DataFrame, fitted: Whitening) -> DataFrame:
    parts = (fitted.n, fitted.sums, fitted.values, fitted.vectors)
    rows = x.where(F.size("x") == len(fitted.sums)).select("vec_id", "x")
    return rows.mapInArrow(_whitening(*parts), "vec_id long, deviation decimal(38,0), whitened array<double>")


def fit(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> Whitening | None:
    """The whitening of the distinct grid vectors of ``rows`` (vec_id, embedding); None if there are none.

    Vectors that are null or hold a null or non-finite component take no part,
    nor do vectors of another length than the commonest one. The covariance has
    the divisor n and is centred before it is multiplied: at the whole numbers
    nearest the means, the rest of which, half a unit or less, is taken off
    exactly. Components of zero variance have the value 0.
    """
    import numpy as np

    x = on_grid(rows, scale)
    d = _commonest_length(x)
    if not d:
        return None
    points = written(x.where(F.size("x") == d).select("x").distinct(), "whitening-points")
    partial = points.mapInArrow(_summing(), "i int, total decimal(38,0)").groupBy("i").agg(F.sum("total").alias("total"))
    found = {r["i"]: int(r["total"]) for r in partial.collect()}
    n, sums = found[-1], [found[i] for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    partial = points.mapInArrow(_multiplying(centre), "i int, j int, total decimal(38,0)")
    v = np.zeros((d, d))
    for r in partial.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        i, j = r["i"], r["j"]
        # Python rounds the quotient of whole numbers once.
        v[i, j] = v[j, i] = (n * int(r["total"]) - rest[i] * rest[j]) / (n * n)
    values, vectors = leading(v, components)
    trace = float(np.trace(v))
    values = [float(e) if e > 8 * d * np.finfo(float).eps * trace else 0.0 for e in values]
    fitted = Whitening(n, sums, values, vectors.tolist(), trace, None)
    some = [c for c, e in enumerate(values) if e > 0]
    if some:
        whitened = _rows(points.select(F.lit(None).cast("long").alias("vec_id"), "x"), fitted)
        columns = whitened.select(*[F.col("whitened")[c].alias(f"w{c}") for c in some])
        # Spark's covariance keeps running means and multiplies what is centred.
        pairs = [(a, b) for a in some for b in some if a <= b]
        measured = columns.agg(*[F.covar_pop(f"w{a}", f"w{b}").alias(f"c{a}_{b}") for a, b in pairs]).first()
        fitted.identity_error = max(abs(m - (a == b)) for m, (a, b) in zip(measured, pairs))
    return fitted


def whiten(rows: DataFrame, fitted: Whitening | None, scale: int = SCALE) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per vector and component.

    ``deviation`` is the exact sum over dimensions of (n * x - S)^2, a
    decimal(38,0). Vectors that ``fit`` left out give no row, an empty table none;
    rows that repeat are given as often, and other columns play no part. A
    component of zero variance has a null whitened value and explains 0; if no
    vectors differ, ``explained`` and ``identity_error`` are null.
    """
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if fitted is None:
        return rows.sparkSession.createDataFrame([], schema)
    explained = F.array(*[F.lit(e / fitted.trace if fitted.trace else None).cast("double") for e in fitted.values])
    each = _rows(on_grid(rows, scale), fitted).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(fitted.identity_error).cast("double").alias("identity_error"),
    )
