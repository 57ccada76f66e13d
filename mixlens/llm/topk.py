"""Exact top-k inner products by buckets of vectors of like length.

All vectors are put in order of length and cut into buckets. A query meets a
bucket only if its length times the bucket's greatest one reaches the query's
threshold, the k-th best score known so far. Inside a bucket the threshold
becomes a cosine: what a candidate's direction has to reach at least. If that
cosine confines a candidate's coordinates, only candidates inside the confines
of the query's strongest coordinates are looked at; else those that are long
enough. Products of what is left are computed exactly.

Queries and buckets meet in cells of bounded size, so no task holds a bucket
for all queries or a query for all buckets. Two rounds: the longest bucket and
the query's own, where its near copies are, give the thresholds; all others
follow with these.
"""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mixlens.llm.common import written
from mixlens.llm.ranks import numbered
from mixlens.llm.vectors import matrix, widened

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors in a bucket, and consecutive vectors whose queries form a block; a cell has at most as many rows as both.
BUCKET, BLOCK = 4096, 16384
#: So many lengths at most come to the driver, whatever the number of buckets.
LENGTHS = 4096
#: Strongest coordinates of a query that are looked at, and products computed at a time.
FOCUS, PRODUCTS = 3, 1 << 19
#: For lengths and cosines, which are rounded; scores are not.
SLACK = 1e-9

HITS = "q long, query_id long, vec_id long, score long"


def exact(a, b, most: float):
    """Both matrices in a type in which their products are exact, as none of the sums that make them passes ``most``."""
    import numpy as np

    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else object
    return a.astype(kind), b.astype(kind)


def confines(cosine, focus):
    """(least, most) of a unit vector's coordinate, if its angle to another with coordinate ``focus`` has that cosine or more."""
    import numpy as np

    angle, reach = np.arccos(np.clip(focus, -1, 1)), np.arccos(np.clip(cosine, -1, 1))
    return np.cos(np.minimum(np.pi, angle + reach)) - SLACK, np.cos(np.maximum(0, angle - reach)) + SLACK


def best(rows, columns, scores, k: int):
    """The k first of each row's hits, by falling score and rising column."""
    import numpy as np

    order = np.lexsort((columns, -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    first = np.searchsorted(rows, rows)
    some = np.arange(len(rows)) - first < k
    return rows[some], columns[some], scores[some]


def products(queries, candidates, own, least, long_enough, order, k: int):
    """(query, candidate, score) of the k best candidates of each query, among as many as are long enough, from ``least`` on.

    Candidates stand in order of length; ``order`` has their places by id, which decide ties.
    """
    import numpy as np

    n, found = len(candidates), []
    step = max(1, PRODUCTS // max(1, n))
    for a in range(0, len(queries), step):
        part = slice(a, a + step)
        width = int(long_enough[part].max(initial=0))
        scores = (queries[part] @ candidates[:width].T).astype(np.float64 if queries.dtype != object else object)
        fits = (np.arange(width) < long_enough[part, None]) & (np.arange(width) != own[part, None])
        fits &= scores >= least[part, None]
        for i in np.flatnonzero(fits.sum(axis=1) > k):
            # The k-th best of the row, to leave out what is below at once; what ties with it stays.
            mine = np.flatnonzero(fits[i])
            fits[i, mine] = scores[i, mine] >= np.partition(scores[i, mine], -k)[-k]
        rows, columns = np.nonzero(fits)
        found.append(best(rows + a, order[columns], scores[rows, columns], k))
    return tuple(np.concatenate(x) for x in zip(*found))


def confined(queries, candidates, own, least, focus, low, high, unit, order, k: int):
    """As ``products``, for queries whose threshold confines the coordinates ``focus`` of a candidate's direction."""
    import numpy as np

    lists: dict = {}
    found = []
    for i in range(len(queries)):
        f = focus[i, 0]
        if f not in lists:
            rising = np.argsort(unit[:, f], kind="stable")
            lists[f] = (rising, unit[rising, f])
        rising, values = lists[f]
        some = rising[np.searchsorted(values, low[i, 0]) : np.searchsorted(values, high[i, 0], "right")]
        for f, a, b in zip(focus[i, 1:], low[i, 1:], high[i, 1:]):
            some = some[(unit[some, f] >= a) & (unit[some, f] <= b)]
        some = some[some != own[i]]
        scores = candidates[some] @ queries[i]
        scores, some = scores[scores >= least[i]], some[scores >= least[i]]
        found.append(best(np.full(len(some), i), order[some], scores, k))
    return tuple(np.concatenate(x) for x in zip(*found))


def _cell(k: int) -> Callable:
    """The k best candidates of one bucket for each query of a block, leaving out what can't reach the query's threshold."""

    def run(queries, candidates):
        import numpy as np
        import pyarrow as pa

        def long_column(table, name):
            return table.column(name).to_numpy().astype(np.int64)

        schema = pa.schema([("q", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        # Ties go to the smaller id, a null one last; so columns stand for ids, and lengths are looked up.
        candidates = candidates.sort_by([("vec_id", "ascending")])
        qx, cx = matrix(queries.column("x")), matrix(candidates.column("x"))
        width = max(qx.shape[1], cx.shape[1])
        qx, cx = widened(qx, width), widened(cx, width)
        qn, cn = (np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) for x in (qx, cx))
        least = queries.column("least").fill_null(-(2**63)).to_numpy()
        at, rows = long_column(candidates, "at"), long_column(queries, "q")
        by_at = np.argsort(at)
        place = np.minimum(np.searchsorted(at[by_at], rows), len(at) - 1)
        own = np.where(at[by_at[place]] == rows, by_at[place], -1)
        # What stands in order of length: a query looks at a beginning of it.
        order = np.argsort(-cn, kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        own = np.where(own >= 0, back[own], -1)
        cn, cx = cn[order], cx[order]
        a, b = exact(qx, cx, float(qn.max() * cn.max()))
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(least > 0, least / qn, -np.inf) * (1 - SLACK)
            cosine = np.where(least > 0, least / (qn * cn[0]), -1.0) - SLACK
            unit_q = np.where(qn[:, None] > 0, qx / qn[:, None], 0.0)
        long_enough = np.searchsorted(-cn, -needed, "right")
        strong = np.argsort(-np.abs(unit_q), axis=1, kind="stable")[:, :FOCUS]
        value = np.take_along_axis(unit_q, strong, axis=1)
        # Then candidates need the query's sign in its strongest coordinate, and few have all that is asked.
        strongest = value[:, 0] if width else np.zeros(len(qx))
        by_coordinate = (cosine > 0) & (cosine**2 + strongest**2 > 1) & (long_enough > 0)
        found = [(np.zeros(0, np.int64),) * 3]
        some = np.flatnonzero(~by_coordinate & (long_enough > 0))
        if len(some):
            hits = products(a[some], b, own[some], least[some], long_enough[some], order, k)
            found.append((some[hits[0]], *hits[1:]))
        some = np.flatnonzero(by_coordinate)
        if len(some):
            with np.errstate(divide="ignore", invalid="ignore"):
                unit = np.where(cn[:, None] > 0, cx / cn[:, None], 0.0)
            low, high = confines(cosine[some, None], value[some])
            hits = confined(a[some], b, own[some], least[some], strong[some], low, high, unit, order, k)
            found.append((some[hits[0]], *hits[1:]))
        rows, columns, scores = (np.concatenate(x) for x in zip(*found))
        score = pa.array([int(s) for s in scores], pa.int64())
        ids = candidates.column("vec_id").combine_chunks().take(pa.array(columns))
        own_ids = queries.select(["q", "query_id"]).take(pa.array(rows))
        return pa.table([own_ids.column("q"), own_ids.column("query_id"), ids, score], schema=schema)

    return run


def _meet(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """The hits of queries (bucket, block, q, query_id, x, least) in the buckets they name."""
    cells = queries.select(F.col("bucket").alias("cell"), F.col("block").alias("of_block")).distinct()
    there = vectors.join(cells, F.col("bucket") == F.col("cell"))
    there = there.select(F.col("cell").alias("bucket"), F.col("of_block").alias("block"), "at", "vec_id", "x")
    both = queries.groupBy("bucket", "block").cogroup(there.groupBy("bucket", "block"))
    return both.applyInArrow(_cell(k), HITS)


def _last_buckets(vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """The queries with ``last``: beyond that bucket no vector is long enough for their threshold."""
    import numpy as np

    buckets = vectors.agg(F.max("bucket")).first()[0]
    group = -(-(buckets + 1) // LENGTHS)
    sums = vectors.groupBy(F.expr(f"bucket div {group}").alias("g")).agg(F.max("norm").alias("norm")).collect()
    # Falling lengths, negated so that they rise.
    lengths = np.sort([-r["norm"] for r in sums])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            least = batch.column("least").fill_null(-(2**63)).to_numpy(zero_copy_only=False)
            norm = batch.column("norm").to_numpy(zero_copy_only=False)
            with np.errstate(divide="ignore"):
                needed = np.where(least > 0, least / norm, -np.inf) * (1 - SLACK)
            last = np.minimum(np.searchsorted(lengths, -needed, "right") * group - 1, buckets)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(last, pa.int64())], names=[*batch.schema.names, "last"])

    schema = ", ".join(f"`{n}` {t}" for n, t in queries.dtypes)
    return queries.mapInArrow(run, f"{schema}, last long")


def top_k(rows: DataFrame, is_query: Column, k: int = 20, bucket: int = BUCKET, block: int = BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k best candidates of each query: all rows but its own.

    ``rows`` has vec_id (long) and ``x``, a list of longs without nulls (see
    ``on_grid``); ``is_query`` picks the queries by vec_id. Scores are inner
    products, exact; ties go to the smaller vec_id, null ids last. A vector
    that is shorter than others ends with zeros, and an empty one scores 0. Rows
    that repeat an id are rows of their own, as queries and as candidates. If there
    are fewer than k candidates, all are given; an empty table gives no row.
    Scores have to fit a long.
    """
    norm = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    sized = rows.select("vec_id", "x", F.sqrt(norm).alias("norm")).withColumn("short", -F.col("norm"))
    vectors = numbered(sized, ["short", "vec_id"], name="lengths")
    vectors = vectors.withColumns({"bucket": F.expr(f"at div {bucket}"), "block": F.expr(f"at div {block}")})
    spark = rows.sparkSession
    queries = written(
        vectors.where(is_query).select(F.col("at").alias("q"), F.col("vec_id").alias("query_id"), "x", "norm", "bucket", "block"),
        "queries",
    )
    if queries.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    first = queries.withColumn("least", F.lit(None).cast("long"))
    first = first.withColumn("bucket", F.explode(F.array_distinct(F.array(F.lit(0).cast("long"), "bucket"))))
    known = written(_meet(first, vectors, k), "first-hits")
    of_query = W.partitionBy("q").orderBy(F.col("score").desc())
    kth = known.withColumn("n", F.row_number().over(of_query)).where(F.col("n") == k)
    aimed = queries.join(kth.select("q", F.col("score").alias("least")), "q", "left")
    aimed = _last_buckets(vectors, aimed.select(*queries.columns, "least"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), "last"), lambda b: (b != 0) & (b != F.col("bucket")))
    rest = aimed.where("last >= 0").select("q", "query_id", "x", "least", "block", F.explode(others).alias("bucket"))
    hits = known.unionByName(_meet(rest, vectors, k))
    order = W.partitionBy("q").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
