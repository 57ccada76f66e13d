"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

A document is a weighted set of five-word shingles: occurrences times inverse
document frequency. Improved consistent weighted sampling draws from each set so
that two documents share a draw with the probability of their weighted Jaccard
similarity. Rows of draws form bands; documents that share a band meet in a
bucket and are verified by their exact weighted similarity.

In a bucket nobody meets everybody: members are compared with pivots, and the
distance (1 - similarity) is a metric that rules out most other pairs. What a
text of a crowded bucket shares with no other one rules out more of them, and
a longer sketch of draws tells most of the rest that are not similar enough.

Shingles of more than a hundredth of all documents count less, so that passages
that very many documents share don't make those alike. In a group of near copies
of that size the copies' own words would count less than what tells them apart;
so all documents are sampled and compared once more, with all shingles counting
in full. Either similarity makes a link.
"""

from __future__ import annotations

import functools
import math
import sys
from collections.abc import Callable, Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import kept_whole, release, text_of, written
from mixlens.llm.components import components
from mixlens.llm.hashing import keys, mixed, slices, text_bytes, window_hashes, word_hashes
from mixlens.llm.pivots import pivot_links

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH, LEAST = 5, 0.8
#: Bands and draws in each. At similarity 0.8 a pair shares no band with probability 3e-5.
BANDS, ROWS = 20, 4
#: Document frequencies tell from this share of all documents on.
COMMON = 0.01
#: Counters that pick the shingles worth counting: so many a shingle that may be common, and bits of their number.
SPARE, LEAST_BITS, MOST_BITS = 8, 12, 22
#: Counters a row when tasks are summed, and exact counts a task holds before it gives them away.
CHUNK, HELD = 1 << 11, 1 << 20
#: Random triples of the sampling scheme per draw (bits), and steps of weights per doubling.
POOL_BITS, STEPS = 15, 4
#: Buckets of so many texts are searched only as far as what their texts share allows.
CROWD = 8
#: Draws in the sketches of their texts, bits kept of each, and triples (sets of them) that all draws take by turns.
DRAWS, BITS, POOLS = 512, 2, 8
#: Probability that sketches rule out a pair that is only just similar.
MISS = 1e-6

SIGNATURE = ["doc_id", "text_key", "bands", "full_bands", "total", "full_total"]


def shingles_of(data, offsets, width: int = WIDTH):
    """(shingle, number of its text) of all windows of the texts, repeated ones too, in no order.

    A text of fewer words has one shingle, all its words; a text without words has none.
    """
    import numpy as np

    words, bounds, _, _ = word_hashes(data, offsets)
    windows, ends, _ = window_hashes(words, bounds, width)
    count = np.diff(bounds)
    short = np.flatnonzero((count > 0) & (count < width))
    text = np.repeat(np.arange(len(count)), np.diff(ends))
    if len(short):
        own = [np.add.reduce(words[bounds[i] : bounds[i + 1]] * keys(count[i], 211)) for i in short]
        windows, text = np.append(windows, mixed(np.array(own, np.uint64))), np.append(text, short)
    return windows, text


def distinct_shingles(windows, text):
    """(shingles, texts, occurrences): each text's shingles once, sorted by text and hash."""
    import numpy as np

    order = np.lexsort((windows, text))
    windows, text = windows[order], text[order]
    new = np.ones(len(windows), bool)
    new[1:] = (windows[1:] != windows[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return windows[at], text[at], np.diff(np.append(at, len(windows)))


def shingle_sets(data, offsets, width: int = WIDTH):
    """(shingles, occurrences, offsets): the distinct shingles of each text, sorted by hash within the text."""
    import numpy as np

    shingles, text, times = distinct_shingles(*shingles_of(data, offsets, width))
    return shingles, times, np.searchsorted(text, np.arange(len(offsets)))


def rarities(shingles, idf: bytes):
    """Base-2 logarithm of each shingle's weight: what ``inverse_frequencies`` gave for it, and 0 for all others."""
    import numpy as np

    n = len(idf) // 12
    common, weight = np.frombuffer(idf, np.uint64, n), np.frombuffer(idf, np.float32, n, 8 * n)
    found = np.zeros(len(shingles), np.float32)
    if n:
        at = np.minimum(np.searchsorted(common, shingles), n - 1)
        hit = common[at] == shingles
        found[hit] = weight[at[hit]]
    return found


def steps_of(times, rarity):
    """Weights as whole steps: occurrences times the inverse frequency, rounded to a grid."""
    import numpy as np

    return np.rint((np.log2(times) + rarity) * STEPS).astype(np.int64)


def weights_of(times, rarity):
    """The weights that the steps stand for."""
    import numpy as np

    return np.exp2(steps_of(times, rarity) / STEPS)


def _places(shingles, bits: int):
    """Each shingle's counter in two rows of 2 ** bits counters, one after the other."""
    import numpy as np

    high = (shingles >> np.uint64(64 - bits)).astype(np.int64)
    return high, (shingles & np.uint64((1 << bits) - 1)).astype(np.int64) + (1 << bits)


def _bounding(bits: int) -> Callable:
    """Counters of the task's shingles, repeated ones too: no shingle is in more texts than its counters say."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros(2 << bits, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for place in _places(shingles_of(*text_bytes(part.column(0)))[0], bits):
                    total += np.bincount(place, minlength=len(total))
        rows = np.minimum(total, (1 << 31) - 1).astype(np.int32).reshape(-1, CHUNK)
        some = np.flatnonzero(rows.any(axis=1))
        counters = pa.array([rows[i].tobytes() for i in some], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), counters], names=["chunk", "counters"])

    return run


def _summing(above: float) -> Callable:
    """Which counters of a chunk are above the limit in all, as bits."""

    def run(rows):
        import numpy as np
        import pyarrow as pa

        total = np.zeros(CHUNK, np.int64)
        for x in rows.column("counters"):
            total += np.frombuffer(x.as_buffer(), np.int32)
        bits = np.packbits(total > above).tobytes()
        return pa.table({"chunk": rows.column("chunk")[:1], "above": pa.array([bits], pa.binary())})

    return run


def _counting(above: bytes, bits: int) -> Callable:
    """How many texts of the task hold each shingle whose counters are above the limit."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        may = np.unpackbits(np.frombuffer(above, np.uint8)).astype(bool)
        held, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                windows, text = shingles_of(*text_bytes(part.column(0)))
                high, low = _places(windows, bits)
                wanted = may[high] & may[low]
                new, _, _ = distinct_shingles(windows[wanted], text[wanted])
                both, at = np.unique(np.append(held, new), return_inverse=True)
                times = np.bincount(at, np.append(times, np.ones(len(new))), len(both)).astype(np.int64)
                held = both
                if len(held) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(times)], names=["shingle", "df"])
                    held, times = held[:0], times[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(times)], names=["shingle", "df"])

    return run


def inverse_frequencies(docs: DataFrame) -> bytes:
    """Common shingles, sorted, and the base-2 logarithms of their weights as 32-bit floats.

    Frequencies are counted over all rows, copies included, each text once. Up to
    ``COMMON`` of all documents a shingle counts in full, from there the weight
    falls with the square of the inverse frequency's logarithm, to a fiftieth for
    a shingle of all documents. The counts are exact: a first reading only bounds
    them by two rows of counters, as many as documents are long, and a second one
    counts the shingles whose bounds are above the share. Only common shingles
    come to the driver; there are fewer than shingles in an average document
    divided by the share.
    """
    import numpy as np

    n, size = docs.agg(F.count("*"), F.sum(F.octet_length(text_of()))).first()
    if not n:
        return b""
    limit = max(1.0, COMMON * n)
    # A word and the space behind it have some five bytes or more.
    bits = math.ceil(math.log2(max(1.0, SPARE * size / 5 / n / COMMON)))
    bits = min(MOST_BITS, max(LEAST_BITS, bits))
    texts = docs.select(text_of().alias("text"))
    counters = texts.mapInArrow(_bounding(bits), "chunk long, counters binary")
    above = bytearray((2 << bits) // 8)
    for r in counters.groupBy("chunk").applyInArrow(_summing(limit), "chunk long, above binary").collect():
        above[r["chunk"] * CHUNK // 8 : (r["chunk"] + 1) * CHUNK // 8] = r["above"]
    counts = texts.mapInArrow(_counting(bytes(above), bits), "shingle long, df long")
    sums = counts.groupBy("shingle").agg(F.sum("df").alias("df"))
    rows = sums.where(F.col("df") > limit).collect()
    common = np.array([r["shingle"] for r in rows], np.int64).view(np.uint64)
    rare = [math.log(min(1.0, r["df"] / n)) / math.log(COMMON) for r in rows]
    weight = [math.log2(0.02 + 0.98 * max(0.0, min(1.0, x)) ** 2) for x in rare]
    order = np.argsort(common)
    return common[order].tobytes() + np.array(weight, np.float32)[order].tobytes()


def _pool(draw: int):
    """r, ln c and beta of the draw's random triples."""
    import numpy as np

    unit = [(mixed(keys(1 << POOL_BITS, 1000 + 8 * draw + i)) >> np.uint64(11)) + np.uint64(1) for i in range(5)]
    u = [x.astype(np.float64) / float(2**53 + 1) for x in unit]
    return -np.log(u[0] * u[1]), np.log(-np.log(u[2] * u[3])), u[4]


def sampled(pool, index, steps):
    """What the triples ``index`` of a draw give shingles of the weights: rank (less wins) and grid cell in one number."""
    import numpy as np

    r, log_c, beta = (x[index] for x in pool)
    cell = np.floor(steps * (math.log(2.0) / STEPS) / r + beta)
    rank = np.exp(log_c - r * (cell - beta) - r).astype(np.float32)
    # The rank's bits lead, the cell's hash follows; a shingle's own bits are joined to it by exclusive or.
    lead = rank.view(np.uint32).astype(np.uint64) << np.uint64(32)
    return lead | (mixed((cell + 2.0**31).astype(np.uint64)) >> np.uint64(32))


def _signing(idf: bytes) -> Callable:
    """doc_id, text key and band hashes of each row: by weight, and in full where that differs."""

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa

        pick = keys(BANDS * ROWS, 5)
        # Worker processes outlive tasks; the library's module holds the draws for the next task. Nearly all
        # weights are 1: for those, what each triple gives is kept ready. A band's draws are of different pools;
        # draws of one pool differ in the triples that they give a shingle.
        kept = np.__dict__.setdefault("_kept_draws", {})
        name = ("bands", POOLS, POOL_BITS, STEPS)
        if name not in kept:
            pools, every = [_pool(k) for k in range(POOLS)], np.arange(1 << POOL_BITS)
            kept[name] = [(p, sampled(p, every, np.zeros(len(every)))) for p in pools]
        draws = kept[name]

        def banded(found) -> np.ndarray:
            bands = np.zeros((len(found), BANDS), np.uint64)
            weights = keys(ROWS, 6)
            for b in range(BANDS):
                low = found[:, b * ROWS : (b + 1) * ROWS] * weights
                bands[:, b] = mixed(low.sum(axis=1, dtype=np.uint64) + pick[b])
            return bands

        def sign(shingles, steps, full, ends) -> tuple[np.ndarray, np.ndarray]:
            """Bands for weights of both kinds; they part where a draw meets a shingle that weighs less."""
            begin = ends[:-1]
            found = np.zeros((2, len(begin), BANDS * ROWS), np.uint64)
            if not len(begin):
                return banded(found[0]), banded(found[1])
            other, less = np.flatnonzero(full), np.flatnonzero(steps != full)
            own = mixed(shingles) >> np.uint64(32)
            short = (shingles >> np.uint64(32)).astype(np.uint32)
            for k in range(BANDS * ROWS):
                pool, ready = draws[k % POOLS]
                index = (short * np.uint32(pick[k] >> np.uint64(32) | np.uint64(1))) >> np.uint32(32 - POOL_BITS)
                value = ready[index]
                if len(other):
                    value[other] = sampled(pool, index[other], full[other].astype(np.float64))
                found[1, :, k] = found[0, :, k] = np.minimum.reduceat(value ^ own, begin)
                if len(less):
                    value[less] = sampled(pool, index[less], steps[less].astype(np.float64))
                    found[0, :, k] = np.minimum.reduceat(value ^ own, begin)
            return banded(found[0]), banded(found[1])

        for batch in batches:
            # Small parts: what is done to them for each draw stays in the processor's cache.
            for part in slices(batch, 1, 1 << 19):
                data, offsets = text_bytes(part.column(1))
                shingles, times, ends = shingle_sets(data, offsets)
                count = np.diff(ends)
                rarity = rarities(shingles, idf)
                common = np.concatenate([[0], np.cumsum(rarity < 0)])
                has = count > 0
                differs = common[ends[1:]] > common[ends[:-1]]
                columns = [part.column(0)]
                digest = [hashlib.md5(data[a:b].tobytes()).digest() for a, b in zip(offsets[:-1], offsets[1:])]
                columns.append(pa.array(digest, pa.binary()))
                begins = np.concatenate([[0], np.cumsum(count[has])])
                both = sign(shingles, steps_of(times, rarity), steps_of(times, np.float32(0)), begins)
                for bands, mine in zip(both, (has, differs)):
                    at = np.concatenate([[0], np.cumsum(mine * BANDS)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(at, pa.array(bands[mine[has]].view(np.int64).ravel())))
                for weight in (weights_of(times, rarity), weights_of(times, np.float32(0))):
                    total = np.zeros(len(count))
                    if len(weight):
                        total[has] = np.add.reduceat(weight, ends[:-1][has])
                    columns.append(pa.array(total))
                yield pa.RecordBatch.from_arrays(columns, names=SIGNATURE)

    return run


def _comparing(idf: bytes) -> Callable:
    """Distance of each pair: 1 - weighted Jaccard similarity."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def sets(part, column: int) -> list:
            # A pivot's text comes many times.
            named = part.column(column).dictionary_encode()
            shingles, times, ends = shingle_sets(*text_bytes(named.dictionary))
            weight = weights_of(times, rarities(shingles, idf))
            each = [(shingles[a:b], weight[a:b]) for a, b in zip(ends[:-1], ends[1:])]
            return [each[i] for i in named.indices.to_pylist()]

        for batch in batches:
            for part in slices(batch, 2, 1 << 21):
                far = []
                for (a, wa), (b, wb) in zip(sets(part, 2), sets(part, 3)):
                    at = np.minimum(np.searchsorted(b, a), max(0, len(b) - 1))
                    same = b[at] == a if len(b) else np.zeros(len(a), bool)
                    least = np.minimum(wa[same], wb[at[same]]).sum() if len(b) else 0.0
                    total = wa.sum() + wb.sum() - least
                    far.append(1.0 - least / total if total else 0.0)
                columns = [part.column(0), part.column(1), pa.array(far, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "far"])

    return run


def _weighing(idf: bytes) -> Callable:
    """Each text's distinct shingles with their weights."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, 1, 1 << 21):
                shingles, times, ends = shingle_sets(*text_bytes(part.column(1)))
                weight = weights_of(times, rarities(shingles, idf))
                of = part.column(0).take(pa.array(np.repeat(np.arange(len(ends) - 1), np.diff(ends))))
                yield pa.RecordBatch.from_arrays([of, pa.array(shingles.view(np.int64)), pa.array(weight)], names=["node", "shingle", "weight"])

    return run


def most_apart(least: float = LEAST, draws: int = DRAWS, bits: int = BITS, miss: float = MISS) -> int:
    """In so many places the sketches of similar texts may differ; in more they do with probability ``miss`` at most."""
    # A draw differs with probability 1 - similarity, and the bits kept of it may agree by chance.
    p = (1.0 - least) * (1.0 - 0.5**bits)
    if p <= 0.0:
        return 0
    tail = 0.0
    for k in range(draws, 0, -1):
        ways = math.lgamma(draws + 1) - math.lgamma(k + 1) - math.lgamma(draws - k + 1)
        tail += math.exp(ways + k * math.log(p) + (draws - k) * math.log1p(-p))
        if tail > miss:
            return k
    return 0


def _sketching(idf: bytes) -> Callable:
    """Each text's sketch: a few bits of many draws, those of equal rank together in 64-bit words."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        kept = np.__dict__.setdefault("_kept_draws", {})
        name = ("sketch", POOLS, POOL_BITS, STEPS)
        if name not in kept:
            pools, every = [_pool(5000 + k) for k in range(POOLS)], np.arange(1 << POOL_BITS)
            kept[name] = [(p, sampled(p, every, np.zeros(len(every)))) for p in pools]
        draws, pick = kept[name], keys(DRAWS, 12)
        for batch in batches:
            for part in slices(batch, 1, 1 << 19):
                shingles, times, ends = shingle_sets(*text_bytes(part.column(1)))
                steps = steps_of(times, rarities(shingles, idf))
                count = np.diff(ends)
                has = count > 0
                places = np.zeros((len(count), DRAWS), np.uint8)
                own, other = mixed(shingles) >> np.uint64(32), np.flatnonzero(steps)
                weight = steps[other].astype(np.float64)
                for k in range(DRAWS if len(shingles) else 0):
                    pool, ready = draws[k % POOLS]
                    index = (shingles * pick[k] >> np.uint64(64 - POOL_BITS)).astype(np.int64)
                    value = ready[index]
                    if len(other):
                        value[other] = sampled(pool, index[other], weight)
                    found = np.minimum.reduceat(value ^ own, ends[:-1][has])
                    places[has, k] = (mixed(found + pick[k]) >> np.uint64(64 - BITS)).astype(np.uint8)
                planes = [np.packbits(places >> bit & 1, axis=1) for bit in range(BITS)]
                words = np.concatenate(planes, axis=1).view(np.int64)
                at = np.arange(len(count) + 1, dtype=np.int32) * words.shape[1]
                sketch = pa.ListArray.from_arrays(at, pa.array(words.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), sketch], names=["node", "sketch"])

    return run


def unlike(least: float = LEAST) -> Callable[[Column, Column], Column]:
    """Whether two sketches differ in more places than those of similar texts."""
    words, most = DRAWS // 64, most_apart(least)

    def told(one: Column, other: Column) -> Column:
        differ = F.lit(0)
        for w in range(words):
            places = [one[w + words * bit].bitwiseXOR(other[w + words * bit]) for bit in range(BITS)]
            differ = differ + F.bit_count(functools.reduce(Column.bitwiseOR, places))
        return differ > most

    return told


def narrowed(members: DataFrame, texts: DataFrame, idf: bytes, least: float = LEAST) -> DataFrame:
    """Members with what ``pivot_links`` tells them apart by, without those that nothing in their bucket can resemble.

    What only one text of all crowded buckets holds can't be shared. Similar
    texts share ``least`` / (1 + ``least``) of both weights together; so what a
    text doesn't have alone limits the weight of the texts it may resemble, and
    if it has more than 1 - ``least`` alone, there are none. This tells apart the
    members of a large group of near copies that differ too much, each of
    which would have to be compared with all others. Those that lack words
    rather than have others hold little alone; they get a sketch.
    """
    crowded = written(members.where(F.col("n") >= CROWD).select("node").distinct(), "crowded-nodes")
    shingles = texts.join(crowded, "node").select("node", "text").mapInArrow(_weighing(idf), "node long, shingle long, weight double")
    held = shingles.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"), F.min("weight").alias("weight"))
    own = written(held.where("n = 1").groupBy("node").agg(F.sum("weight").alias("own")), "own-weights")
    known = members.join(own, "node", "left").withColumn("own", F.coalesce("own", F.lit(0.0)))
    shared = F.col("total") - F.col("own")
    # Weights are sums of floats: so much rounding lets a pair through, never out.
    slack = F.col("total") * 1e-9
    possible = known.where((F.col("n") < CROWD) | (shared >= least * F.col("total") - slack))
    in_crowd = F.col("n") >= CROWD
    some = texts.join(possible.where(in_crowd).select("node").distinct(), "node").select("node", "text")
    sketches = written(some.mapInArrow(_sketching(idf), "node long, sketch array<long>"), "text-sketches")
    return possible.join(sketches, "node", "left").select(
        "bucket",
        "node",
        F.when(in_crowd, F.col("total")).alias("weight"),
        F.when(in_crowd, shared * (1 + least) / least - F.col("total") + 4 * slack).alias("room"),
        F.when(in_crowd, F.col("own") / F.col("total")).alias("lean"),
        "sketch",
    )


def links_of(
    members: DataFrame, texts: DataFrame, idf: bytes, least: float = LEAST, links: DataFrame | None = None
) -> DataFrame:
    """Links between similar nodes that share a bucket, enough of them to connect all that are connected.

    ``members`` has bucket and its number n of members, node and its weight
    total; ``texts`` has node and text. What ``links`` connect isn't searched again.
    """

    def compare(pairs: DataFrame) -> DataFrame:
        first = pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
        both = first.join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b")
        return both.select("a", "b", "text_a", "text_b").mapInArrow(_comparing(idf), "a long, b long, far double")

    narrow = narrowed(members, texts, idf, least)
    return pivot_links(narrow, compare, 1.0 - least + 1e-9, 32, links, unlike(least), members.count())


def classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, text_key and class_id of each row: the least doc_id of all rows that links and copies connect.

    Equal texts, also null and empty ones, are copies. Rows may repeat and ids
    may be null or repeated; the class of null ids alone is null. Other columns
    play no part. Columns n_copies and n_links tell how many rows share the text
    and how many verified links its text has; links that follow from others
    are not all counted.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    idf = inverse_frequencies(rows)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_key binary, bands array<long>, full_bands array<long>, total double, full_total double"
    signed = written(rows.mapInArrow(_signing(idf), schema), "dup-signatures")
    # Bands follow from the text, so equal texts fall together; the node's number is fixed by writing it.
    distinct = signed.groupBy("text_key", "bands", "full_bands")
    totals = [F.min(c).alias(c) for c in ("total", "full_total")]
    distinct = distinct.agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n_copies"), *totals)
    nodes = written(distinct.withColumn("node", F.monotonically_increasing_id()), "dup-nodes")
    # Texts without common shingles have the same bands and similarities by weight and in full.
    alike = F.size("full_bands") == 0
    full = F.when(alike, F.col("bands")).otherwise(F.col("full_bands"))
    members = []
    for total, done, bands in (("total", F.lit(False), F.col("bands")), ("full_total", alike, full)):
        banded = nodes.select("node", F.col(total).alias("total"), done.alias("alike"), F.explode(bands).alias("bucket"))
        counted = banded.groupBy("bucket").agg(F.count("*").alias("n"), F.bool_and("alike").alias("done"))
        shared = counted.where("n > 1 and not done").select("bucket", "n")
        members.append(written(banded.select("bucket", "node", "total").join(shared, "bucket"), "dup-buckets"))
    either = members[0].select("node").union(members[1].select("node")).distinct()
    wanted = either.join(nodes.select("node", "text_key"), "node")
    keyed = rows.select(F.unhex(F.md5("text")).alias("text_key"), "text").join(wanted, "text_key")
    texts = written(keyed.groupBy("node").agg(F.first("text").alias("text")), "dup-texts")
    release(docs.sparkSession)
    by_weight = written(links_of(members[0], texts, idf, least), "dup-links")
    # A bucket whose members the first search has connected has nothing left to find.
    named = members[1].join(components(by_weight), "node", "left").withColumn("root", F.coalesce("root", "node"))
    ends = named.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    left = written(members[1].join(ends.where("low < high").select("bucket"), "bucket"), "dup-buckets")
    links = by_weight.union(links_of(left, texts, b"", least, by_weight))
    links = written(links.distinct(), "dup-links")
    found = components(links)
    ends = links.select(F.col("a").alias("node")).union(links.select("b"))
    n_links = ends.groupBy("node").agg(F.count("*").alias("n_links"))
    placed = nodes.join(found, "node", "left").join(n_links, "node", "left")
    placed = placed.withColumn("root", F.coalesce("root", "node"))
    least_id = placed.groupBy("root").agg(F.min("first_id").alias("class_id"))
    of_text = placed.join(least_id, "root").select(
        "text_key", "node", "root", "first_id", "class_id", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links")
    )
    return signed.select("doc_id", "text_key").join(of_text, "text_key")


def one_of_each(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """One row of each class with all its columns: that of the least doc_id; of rows with equal id and text, any one."""
    found = classes(docs, least)
    # The class's text is that of its least id; ties go to the text of least number.
    order = F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id"), F.col("node"))
    best = found.groupBy("root").agg(F.min(order).alias("best")).select(F.col("best.first_id").alias("id"), F.col("best.node").alias("node"))
    keep = best.join(found.select("node", "text_key").distinct(), "node").select("id", "text_key")
    rows = kept_whole(docs, "doc_id", "text").select("row", "doc_id", F.unhex(F.md5(text_of())).alias("key"))
    kept = rows.join(keep, rows["doc_id"].eqNullSafe(keep["id"]) & (rows["key"] == keep["text_key"]))
    return kept.groupBy("doc_id", "key").agg(F.first("row").alias("row")).select("row.*")
