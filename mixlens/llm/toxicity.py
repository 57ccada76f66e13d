"""Toxic passages as maximal-scoring segments of word log-odds, calibrated by extreme-value statistics.

Words and beginnings of words score by their log-odds between toxic and clean
training documents, with a Dirichlet prior in proportion to their overall use; a
word counts by its longest known beginning. What doesn't differ significantly
scores nothing, and every word costs a little. All maximal segments
of a document's scores are found in one pass. A segment's score is significant
against chance: the number of segments as good in a clean text of n words is
``K n exp(-lambda S)``. A document's evidence is the sum of what its segments
exceed that by, and a logistic curve turns it into a probability.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import text_of, written

#: At most about so many labelled rows are learned from, and so many words get a score.
SAMPLE, VOCABULARY = 50_000, 10_000
#: What every word costs, the z-value from which a word scores, and the weight of the prior in documents.
COST, SIGNIFICANT, PRIOR = 0.1, 4.0, 100.0
#: Lengths of the beginnings of words that are learned beside whole words.
STEMS = (4, 5, 6, 7, 8)


@dataclass(frozen=True)
class Model:
    """Scores of words; lambda and K of the extreme-value law; intercept and slope of the probability."""

    scores: dict[str, float]
    rate: float
    scale: float
    intercept: float
    slope: float


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 when divided by 3; null is empty."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _counting(stems: tuple[int, ...]) -> Callable:
    """In how many documents each word and each beginning (with a star) occurs, by label, summed up within a batch."""

    def run(batches: Iterator) -> Iterator:
        import re
        from collections import Counter

        import pyarrow as pa

        words = re.compile(r"[^\W\d_]+").findall
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen = set(words(text.lower()))
                counts[toxic].update(seen)
                for k in stems:
                    counts[toxic].update({w[:k] + "*" for w in seen if len(w) > k})
            every = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(every, pa.string())] + [pa.array([c[w] for w in every], pa.int64()) for c in counts]
            yield pa.RecordBatch.from_arrays(columns, names=["word", "clean", "toxic"])

    return run


#: So many different words' scores are remembered by a task before it starts anew.
REMEMBERED = 200_000


def _scoring(scores: dict[str, float], cost: float, stems: tuple[int, ...] = STEMS, single: bool = True) -> Callable:
    """Adds to each batch the number of words, all maximal-scoring segments (first and last word, score) and single scores.

    A word's score is looked up once per task, so that the time hardly depends on how many words score.
    Without ``single`` the single scores are left out.
    """

    def run(batches: Iterator) -> Iterator:
        import re

        import pyarrow as pa

        words = re.compile(r"[^\W\d_]+").findall
        least = min(stems)
        begin = {w[:least] for w in scores}

        def value(word: str) -> float:
            if word in scores:
                return scores[word]
            for k in sorted(stems, reverse=True):
                if len(word) > k and word[:k] + "*" in scores:
                    return scores[word[:k] + "*"]
            return 0.0

        class Known(dict):
            """Words and their scores, null for words that begin like no known one."""

            def __missing__(self, word: str) -> float | None:
                self[word] = score = value(word) if word[:least] in begin else None
                return score

        known = Known()

        def maximal(hits: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
            # Candidates with the sums before and after them; each new one is merged to the left while that gains.
            found: list[tuple[int, int, float, float]] = []
            total, at = 0.0, 0
            for i, score in hits:
                left = total - cost * (i - at)
                total, at = left + score - cost, i + 1
                if total <= left:
                    continue
                first, right = i, total
                while True:
                    k = len(found) - 1
                    while k >= 0 and found[k][2] >= left:
                        k -= 1
                    if k < 0 or found[k][3] >= right:
                        break
                    first, left = found[k][0], found[k][2]
                    del found[k:]
                found.append((first, i, left, right))
            return [(a, b, r - l) for a, b, l, r in found]

        def lists(ends: list[int], values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), values)

        for batch in batches:
            n, ends, firsts, lasts, gains, single_ends, values = [], [], [], [], [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                tokens = words(text.lower())
                n.append(len(tokens))
                hits = [(i, s) for i, s in enumerate(map(known.__getitem__, tokens)) if s is not None]
                if single:
                    values += [s for _, s in hits]
                    single_ends.append(len(values))
                for first, last, gain in maximal(hits):
                    firsts.append(first)
                    lasts.append(last)
                    gains.append(gain)
                ends.append(len(firsts))
                if len(known) > REMEMBERED:
                    known.clear()
            fields = [pa.array(firsts, pa.int32()), pa.array(lasts, pa.int32()), pa.array(gains, pa.float64())]
            segments = pa.StructArray.from_arrays(fields, names=["first", "last", "score"])
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            columns += [pa.array(n, pa.int64()), lists(ends, segments)]
            if single:
                columns.append(lists(single_ends, pa.array(values, pa.float64())))
            names = [*batch.schema.names[:-1], "n", "segments", *(["hits"] if single else [])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


SEGMENTS = "n long, segments array<struct<first: int, last: int, score: double>>"


def training_rows(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """Labelled documents outside the held-out part: toxic, half (0 or 1), text.

    If there are more than ``most``, a hash of the id picks about so many; that
    bound is why their ids may be broadcast. A document with several labels
    counts as toxic if at least half of them say so; null labels and ids are
    left out.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    each = known.groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    n = each.count()
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    picked = each.where(draw < F.lit(math.ceil((1 << 30) * min(1.0, most / max(1, n)))))
    half = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("half")), F.lit(2)).cast("int").alias("half")
    ids = picked.select(F.col("doc_id").alias("id"), "toxic", half)
    return docs.join(F.broadcast(ids), docs["doc_id"] == ids["id"]).select("toxic", "half", text_of().alias("text"))


def word_scores(train: DataFrame, most: int = VOCABULARY) -> dict[str, float]:
    """Log-odds of the words and beginnings that differ most, at most ``most``."""
    n = {r["toxic"]: float(r["count"]) for r in train.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return {}
    counts = train.select("toxic", "text").mapInArrow(_counting(STEMS), "word string, clean long, toxic long")
    counts = counts.groupBy("word").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = (F.col("clean") + F.col("toxic")) / F.lit(n[0] + n[1])
    odds, spread = {}, F.lit(0.0)
    for name, docs in (("clean", n[0]), ("toxic", n[1])):
        have = F.col(name) + PRIOR * share
        odds[name] = F.log(have) - F.log(F.greatest(docs + PRIOR - have, F.lit(0.5)))
        spread = spread + 1 / have
    delta = odds["toxic"] - odds["clean"]
    scored = counts.select("word", delta.alias("delta"), (delta / F.sqrt(spread)).alias("z"))
    best = scored.where(F.abs("z") >= SIGNIFICANT).orderBy(F.abs("z").desc(), "word").limit(most)
    return {r["word"]: r["delta"] for r in best.collect()}


def decay_rate(clean: DataFrame) -> float:
    """lambda of scored clean documents: the mean of exp(lambda * score) over their words is 1.

    Scores to two digits bound the rows that come to the driver.
    """
    n = clean.agg(F.sum("n")).first()[0] or 1
    hits = clean.select(F.explode("hits").alias("s")).groupBy(F.round("s", 2).alias("s")).count().collect()
    rates = [(r["count"] / n, r["s"] - COST) for r in hits]
    rest = max(0.0, 1 - sum(p for p, _ in rates))

    def mean(rate: float) -> float:
        return sum(p * math.exp(min(50.0, rate * s)) for p, s in rates) + rest * math.exp(-COST * rate)

    low, high = 1e-6, 20.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (low, mid) if mean(mid) > 1 else (mid, high)
    return low


def evidence(rate: float, scale: float) -> Column:
    """What all segments exceed chance by: the sum of the positive values of ``lambda S - ln(K n)``."""
    chance = F.log(F.greatest(F.col("n"), F.lit(1)) * F.lit(scale))
    parts = F.transform("segments", lambda s: F.greatest(F.lit(0.0), s["score"] * rate - chance))
    return F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)


def _logistic(rows: list[tuple[float, int, int]]) -> tuple[float, float]:
    """Intercept and slope by Newton steps from (value, label, count), with a little weight on no slope."""
    a = b = 0.0
    for _ in range(50):
        ga, gb, haa, hab, hbb = 0.0, -1e-3 * b, 1e-6, 0.0, 1e-3
        for x, y, n in rows:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x))))
            ga, gb = ga + n * (y - p), gb + n * (y - p) * x
            w = n * p * (1 - p)
            haa, hab, hbb = haa + w, hab + w * x, hbb + w * x * x
        det = haa * hbb - hab * hab
        if det <= 1e-12:
            break
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a + max(-2.0, min(2.0, da)), b + max(-2.0, min(2.0, db))
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


#: Evidence beyond this adds nothing to the probability.
ENOUGH = 40.0


def fit(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """Learns words from one half of the labelled rows and the rest from the other half.

    Without rows of both labels no word scores and every document gets the share
    of toxic ones, a half if there is no label at all.
    """
    rows = written(training_rows(docs, labels, most), "toxic-training")
    scores = word_scores(rows.where("half = 0"))
    second = rows.where("half = 1").select("toxic", "text")
    found = written(second.mapInArrow(_scoring(scores, COST), f"toxic int, {SEGMENTS}, hits array<double>"), "toxic-segments")
    rate = decay_rate(found.where("toxic = 0"))
    top = F.coalesce(F.array_max(F.transform("segments", lambda s: s["score"])), F.lit(0.0))
    clean = found.where("toxic = 0").agg(
        F.sum(F.when(F.size("segments") > 0, 1).otherwise(0)).alias("hit"), F.sum(F.col("n") * F.exp(-rate * top)).alias("mass")
    )
    got = clean.first()
    scale = max(got["hit"] or 0, 1) / max(got["mass"] or 0.0, 1.0)
    x = F.least(F.lit(ENOUGH), F.round(4 * evidence(rate, scale)) / 4)
    bins = found.groupBy(x.alias("x"), "toxic").count().collect()
    intercept, slope = _logistic([(r["x"], r["toxic"], r["count"]) for r in bins])
    return Model(scores, rate, scale, intercept, max(0.0, slope))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n, segments, evidence and score (0 to 1) of each row; the text alone decides.

    Null and empty texts have no segments and get the score of no evidence; equal
    texts get equal scores; other columns play no part.
    """
    texts = docs.select("doc_id", text_of().alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(_scoring(model.scores, COST, single=False), f"doc_id {kind}, {SEGMENTS}")
    given = found.withColumn("evidence", evidence(model.rate, model.scale))
    odds = model.intercept + model.slope * F.least(F.lit(ENOUGH), F.col("evidence"))
    return given.withColumn("score", 1 / (1 + F.exp(-odds)))
