"""Quality by weak supervision: rules vote or abstain, and their accuracies are learned from their agreement.

Each rule looks at counts of a document and votes good (1), bad (-1) or nothing
(0). Documents with equal votes count as one pattern, so the corpus shrinks to
3 to the power of the number of rules at most before expectation-maximisation
reads it. The rules' accuracies among good and among bad documents and the
share of good documents give each pattern its posterior probability.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixlens.llm.common import kept_whole, let, text_of, words_of, written

WINDOW = 5
#: Punctuation that counts as a symbol.
SYMBOLS = "#*$%&|<>"

log = logging.getLogger(__name__)


def _count(text: Column, others: str) -> Column:
    """Number of characters that the class ``others`` doesn't hold."""
    return F.length(F.regexp_replace(text, F.lit(others), F.lit(""))).cast("long")


def _repeated(words: Column) -> Column:
    """Number of words inside windows that occur twice or more.

    Windows are compared by a 64-bit hash. Only a text that repeats a window
    has its windows sorted; no step is worse than n log n.
    """
    n = F.size(words)

    def covered(grams: Column) -> Column:
        pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            twice = F.filter(
                s, lambda x, k: F.get(s, k - 1)["h"].eqNullSafe(x["h"]) | F.get(s, k + 1)["h"].eqNullSafe(x["h"])
            )
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def union(at: Column) -> Column:
            steps = F.transform(
                at, lambda x, k: F.least(F.lit(WINDOW), x - F.coalesce(F.get(at, k - 1), x - F.lit(WINDOW)))
            )
            return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(
            let(let(pairs, positions), union)
        )

    grams = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])
    )
    return F.when(n < WINDOW, F.lit(0)).otherwise(let(grams, covered)).cast("long")


def counts(text: Column) -> Column:
    """Counts of a text as a struct: the basis of all rules."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    of_lines = let(
        lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("distinct"))
    )
    of_words = let(
        words_of(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.size(F.filter(w, lambda x: F.substring(x, -1, 1).isin(".", "!", "?"))).cast("long").alias("n_ends"),
            _repeated(w).alias("n_repeat_words"),
        ),
    )
    return let(
        F.struct(of_lines.alias("l"), of_words.alias("w")),
        lambda c: F.struct(
            c["w"]["n_words"].alias("n_words"),
            c["w"]["word_chars"].alias("word_chars"),
            _count(text, f"[^{SYMBOLS}]+").alias("n_symbols"),
            (c["l"]["all"] - c["l"]["distinct"]).cast("long").alias("n_dup_lines"),
            c["w"]["n_repeat_words"].alias("n_repeat_words"),
            c["l"]["all"].cast("long").alias("n_lines"),
            c["w"]["n_ends"].alias("n_ends"),
            _count(text, r"[^\p{Lu}]+").alias("n_upper"),
            _count(text, "[^!]+").alias("n_shouts"),
            _count(text, r"[^\p{L}\p{N}]+").alias("n_letters"),
        ),
    )


def base_failed(c: Column) -> Column:
    """Too short, or more than a fifth of the words inside repeated windows."""
    return (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])


def rules(c: Column) -> dict[str, Column]:
    """The votes of all rules on the counts of a document.

    That a fault is missing says little, so most rules only vote bad or abstain;
    each fault is seen by two rules at least, so that they can confirm each other.
    """

    def vote(bad: Column, good: Column | None = None) -> Column:
        voted = F.when(bad, -1)
        return (voted if good is None else voted.when(good, 1)).otherwise(0)

    words, chars = c["n_words"], c["word_chars"]
    return {
        "length": vote(words < 10, words >= 50),
        "sentences": vote(2 * c["n_ends"] > words, (c["n_ends"] > 0) & (4 * c["n_ends"] <= words)),
        "letters": vote(10 * c["n_letters"] < 9 * chars, 20 * c["n_letters"] >= 19 * chars),
        "symbols": vote(10 * c["n_symbols"] > words),
        "word_length": vote((words >= 30) & ((2 * chars < 5 * words) | (2 * chars > 15 * words))),
        "case": vote(10 * c["n_upper"] > 3 * chars),
        "shouts": vote(10 * c["n_shouts"] > 3 * words),
        "lines": vote(10 * c["n_dup_lines"] > 3 * c["n_lines"]),
        "repeats": vote(100 * c["n_repeat_words"] > 10 * words),
    }


@dataclass(frozen=True)
class Model:
    """The share of good documents and how often each rule votes up and down, on good and on bad ones.

    What a rule's votes are worth follows from these rates: a vote that is as
    frequent on good as on bad documents counts for nothing.
    """

    share: float
    up: dict[str, tuple[float, float]]
    down: dict[str, tuple[float, float]]


#: Where the estimation starts: rules are believed to be better than chance.
START = (0.8, (0.8, 0.3), (0.01, 0.3))


def posterior(votes: dict[str, Column], model: Model) -> Column:
    """Probability that a document with these votes is good; abstaining says nothing."""
    odds = F.lit(math.log(model.share / (1 - model.share)))
    for name, vote in votes.items():
        up, down = (math.log(good / bad) for good, bad in (model.up[name], model.down[name]))
        odds = odds + F.when(vote > 0, F.lit(up)).when(vote < 0, F.lit(down)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def fit(votes: DataFrame, names: list[str], rounds: int = 30, close: float = 1e-6, belief: float = 0.02) -> Model:
    """Expectation-maximisation over vote columns.

    Every round reads the patterns, at most 3 ** len(names) rows, and brings one
    row of sums to the driver. The starting rates stay in the estimate with the
    weight of ``belief`` of all documents, so that a rule that hardly votes
    keeps them; so does the starting share, which keeps the estimate off 0 and 1
    (without belief, by a millionth) and else lets it follow the data. An empty
    table gives the starting values. A warning goes to the log if the estimate
    still moves by ``close`` or more after ``rounds``.
    """
    patterns = written(votes.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "vote-patterns")
    model = Model(START[0], dict.fromkeys(names, START[1]), dict.fromkeys(names, START[2]))
    for _ in range(rounds):
        q = posterior({n: F.col(n) for n in names}, model)
        weighted = patterns.select("*", (F.col("n") * q).alias("good"), (F.col("n") * (1 - q)).alias("bad"))
        sums = {"n": F.sum("n"), "good": F.sum("good"), "bad": F.sum("bad")}
        for n in names:
            for kind in ("good", "bad"):
                sums[f"{n}_up_{kind}"] = F.sum(F.when(F.col(n) > 0, F.col(kind)).otherwise(0.0))
                sums[f"{n}_down_{kind}"] = F.sum(F.when(F.col(n) < 0, F.col(kind)).otherwise(0.0))
        got = weighted.agg(*[v.alias(k) for k, v in sums.items()]).first()
        if not got["n"]:
            return model
        own = belief * got["n"]

        def rates(name: str, way: str, start: tuple[float, float]) -> tuple[float, float]:
            return tuple(
                (got[f"{name}_{way}_{kind}"] + own * s) / (got[kind] + own)
                for kind, s in zip(("good", "bad"), start, strict=True)
            )

        new = Model(
            min(1 - 1e-6, max(1e-6, (got["good"] + own * START[0]) / (got["n"] + own))),
            {n: rates(n, "up", START[1]) for n in names},
            {n: rates(n, "down", START[2]) for n in names},
        )
        moved = abs(new.share - model.share) + sum(abs(new.down[n][1] - model.down[n][1]) for n in names)
        model = new
        if moved < close:
            break
    else:
        log.warning("the votes' rates still moved by %.2g after %d rounds", moved, rounds)
    return model


def judge(counted: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Adds base_failed, p_good and kept to rows with a struct ``c`` of counts."""
    c = F.col("c")
    failed = base_failed(c)
    return counted.withColumns({"base_failed": failed, "p_good": posterior(rules(c), model)}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= least)
    )


def fit_counts(counted: DataFrame) -> Model:
    """Fits the rules to the rows with a struct ``c`` of counts that pass the base rule: those need a verdict."""
    votes = rules(F.col("c"))
    passed = counted.where(~base_failed(F.col("c")))
    return fit(passed.select(*[v.alias(n) for n, v in votes.items()]), list(votes))


def assess(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, p_good and kept of each row.

    The texts are read once; the counts go through a table without texts. A null
    text has no words and fails the base rule; equal rows get equal results; ids
    and other columns play no part.
    """
    counted = written(docs.select("doc_id", counts(text_of()).alias("c")), "quality-counts")
    return judge(counted, fit_counts(counted)).select("doc_id", "c.*", "base_failed", "p_good", "kept")


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows that are kept, with all their columns. The texts are counted twice: to fit and to filter."""
    model = fit_counts(docs.select(counts(text_of()).alias("c")))
    rows = kept_whole(docs, "text").select("row", counts(text_of()).alias("c"))
    return judge(rows, model).where("kept").select("row.*")
