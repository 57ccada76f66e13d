from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from names import CLASHING

from mixlens.llm import substrings
from mixlens.llm.hashing import slices, text_bytes, window_hashes, word_hashes


def brute(docs, length):
    """What is left of each text, by the rule."""
    words = [(d, (t or "").encode().split()) for d, t in docs]
    least = {}
    for d, w in words:
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            if d is not None:
                least[key] = min(d, least.get(key, d))
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if d is not None and least[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        out.append((d, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def result(docs, **kwargs):
    rows = substrings.remove_repeats(docs, **kwargs).collect()
    return sorted(((r.doc_id, r.n_words, sum(s.end - s.first for s in r.repeats), r.kept) for r in rows), key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "b", "é", "dd", "e\x1cf"])
    passages = [[word() for _ in range(rng.randrange(8, 60))] for _ in range(12)]
    docs = []
    for d in range(120):
        words = []
        for _ in range(rng.randrange(6)):
            words += rng.choice(passages) if rng.random() < 0.6 else [rng.choice("abcdefghij") + str(rng.randrange(500)) for _ in range(rng.randrange(30))]
        docs.append((rng.randrange(1000) if d % 9 else d, rng.choice(["\n", " ", "\x0b\t"]).join(words)))
    return [*docs, docs[3], (docs[3][0], "x " + docs[4][1]), (None, docs[5][1]), (5, None), (6, ""), (7, docs[5][1])]


def test_against_brute_force(documents):
    for seed, length, short in ((1, 13, 5), (2, 13, 5), (3, 7, 3), (4, 6, 6)):
        docs = corpus(seed)
        assert result(documents(docs), length=length, seed=short) == brute(docs, length)


def test_edges(documents):
    assert result(documents([])) == []
    long = " ".join(f"w{i % 9000}" for i in range(120_000))
    docs = [(1, long), (2, "start " + long + " end"), (3, "w1 w2 w3"), (4, "z " * 40), (5, "z " * 13), (6, "z " * 12)]
    assert result(documents(docs, CLASHING)) == brute(docs, 13)


def test_maximal_repeats(documents):
    passage = " ".join(f"p{i}" for i in range(60))
    docs = documents([(1, passage), (2, f"a b {passage} c"), (3, " ".join(passage.split()[:20]) + " x " + " ".join(passage.split()[30:]))])
    got = {r.doc_id: [tuple(s) for s in r.repeats] for r in substrings.remove_repeats(docs).collect()}
    assert got == {1: [], 2: [(2, 62)], 3: [(0, 20), (21, 51)]}


def test_word_and_window_hashes():
    rng = random.Random(1)
    texts = [None, "", " \n", "a", "ab c\td\x0be\x0cf\rg", " x y ", "é ü", "k" * 300_000]
    texts += ["".join(rng.choice("ab \n\tc") for _ in range(rng.randrange(60))) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["t"]).slice(1)
    assert sum(len(p) for p in slices(batch, 0, 100)) == len(texts) - 1
    hashes, bounds, start, stop = word_hashes(*text_bytes(batch.column(0)))
    windows, ends, first = window_hashes(hashes, bounds, 3)
    data, _ = text_bytes(batch.column(0))
    words, grams = {}, {}
    for i, text in enumerate(texts[1:]):
        split = (text or "").encode().split()
        assert bounds[i + 1] - bounds[i] == len(split)
        assert ends[i + 1] - ends[i] == max(0, len(split) - 2)
        for k, w in enumerate(split):
            at = bounds[i] + k
            assert data[start[at] : stop[at]].tobytes() == w and words.setdefault(w, hashes[at]) == hashes[at]
        for k in range(len(split) - 2):
            at = ends[i] + k
            assert first[at] == bounds[i] + k and grams.setdefault(tuple(split[k : k + 3]), windows[at]) == windows[at]
    assert len(set(words.values())) == len(words) and len(set(grams.values())) == len(grams)
    assert window_hashes(np.zeros(0, np.uint64), np.zeros(1, np.int64), 3)[0].size == 0
