"""Near copies beside common passages, against all pairs by weight and in full, without conditions on shares."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from test_near_dup import Groups

from mixlens.llm import near_dup


def brute(docs):
    """Classes by comparing all pairs: weighted Jaccard similarity by weight or in full."""
    words = [t.split() for _, t in docs]
    sets = [Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) for w in words]
    df, n = Counter(g for s in sets for g in s), len(docs)

    def idf(g):
        if df[g] <= max(1.0, 0.01 * n):
            return np.float32(0)
        return np.float32(math.log2(0.02 + 0.98 * (math.log(df[g] / n) / math.log(0.01)) ** 2))

    weights = [
        [{g: 2 ** (np.rint((np.log2(k) + (0 if full else idf(g))) * 4) / 4) for g, k in s.items()} for s in sets]
        for full in (False, True)
    ]
    totals = [[sum(s.values()) for s in of] for of in weights]
    groups = Groups()
    for a in range(n):
        groups.find(a)
        for b in range(a):
            same = sets[a].keys() & sets[b].keys()
            for of, total in zip(weights, totals):
                least = sum(min(of[a][g], of[b][g]) for g in same)
                if least >= (0.8 - 1e-9) * (total[a] + total[b] - least):
                    groups.join(a, b)
    return {docs[i][0]: docs[groups.find(i)][0] for i in range(n)}


def named(name, n):
    return [f"{name}{k}" for k in range(n)]


def classes(documents, docs):
    return {r.doc_id: r.class_id for r in near_dup.classes(documents(docs)).collect()}


def test_templated_pages_are_searched_by_weight(documents):
    """Pages of 94 % common passages whose own words agree: similar by weight, not in full."""
    template, ends = named("a", 140), (named("b", 20), named("c", 20))
    texts = [named(f"o{i}w", 40) + template + ends[i % 2] for i in range(200)]
    texts += [named(f"r{i}w", 90) for i in range(98)]
    texts += [named("own", 10) + template + end for end in ends]
    docs = [(i, " ".join(w)) for i, w in enumerate(texts)]
    got = classes(documents, docs)
    assert got[299] == 298 and len(set(got.values())) == 299
    assert got == brute(docs)


def test_near_copies_with_a_shared_passage_are_searched_in_full(documents):
    """Pairs that hold a passage of a third of all rows as 20 to 79 % of their shingles, with words of it changed."""
    rng = random.Random(11)
    passage, texts, pairs = named("p", 154), [], {}
    for share in (0.2, 0.35, 0.5, 0.65, 0.75, 0.79):
        for changes in (1, 3, 5, 8):
            own = named(f"s{share}c{changes}w", round(150 / share) - 150)
            other = list(passage)
            for at in rng.sample(range(5, 149), changes):
                other[at] = f"x{share}c{changes}a{at}"
            pairs[share, changes] = len(texts)
            texts += [passage + own, other + own]
    texts += [passage + named(f"o{i}w", 200) for i in range(52)]
    texts += [named(f"r{i}w", 90) for i in range(200)]
    docs = [(i, " ".join(w)) for i, w in enumerate(texts)]
    got = classes(documents, docs)
    at = pairs[0.75, 3]
    assert got[at + 1] == got[at] == at
    assert got == brute(docs)


def test_frequencies_are_exact_in_long_texts(documents):
    """Long texts of shingles that occur once, and passages in a few of them: only those are common."""
    rng = random.Random(12)
    passages = [named(f"p{k}w", 30) for k in range(8)]
    texts = []
    for i in range(150):
        words = [f"{i}-{rng.randrange(10**9)}" for _ in range(3000)]
        for k in range(8):
            if i % (k + 2) == 0 or i < k:
                words += passages[k] * (1 + i % 2)
        texts.append(" ".join(words))
    idf = near_dup.inverse_frequencies(documents(list(enumerate(texts))))
    df = Counter()
    for text in texts:
        data = np.frombuffer(text.encode(), np.uint8)
        df.update(near_dup.shingle_sets(data, np.array([0, len(data)]))[0].tolist())
    common = {g: k for g, k in df.items() if k > 1.5}
    n = len(idf) // 12
    got = dict(zip(np.frombuffer(idf, np.uint64, n).tolist(), np.frombuffer(idf, np.float32, n, 8 * n).tolist()))
    rare = {g: math.log(k / 150) / math.log(0.01) for g, k in common.items()}
    assert got == {g: float(np.float32(math.log2(0.02 + 0.98 * max(0, min(1, x)) ** 2))) for g, x in rare.items()}
    assert 8 * 26 <= n < 2000
