from __future__ import annotations

import hashlib
import random

import pytest
from names import CLASHING
from pyspark.sql import functions as F
from test_near_dup import Groups

from mixlens.llm import lines
from mixlens.llm.queries import QUERIES


def distance(a, b, most):
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def brute(docs, edits, least):
    """What is left of each text: the first line of each class, by id and place."""
    distinct = sorted({x for _, t in docs for x in (t or "").split("\n") if len(x) >= least})
    groups = Groups()
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if distance(a, b, edits) <= edits:
                groups.join(a, b)
    first = {}
    for d, t in docs:
        for k, x in enumerate((t or "").split("\n")):
            if len(x) >= least:
                key = groups.find(x)
                first[key] = min(first.get(key, (True, 0, 0)), (d is None, d or 0, k)) if key in first else (d is None, d or 0, k)
    out = []
    for d, t in docs:
        rows = (t or "").split("\n")
        left = [x for k, x in enumerate(rows) if len(x) < least or first[groups.find(x)] == (d is None, d or 0, k)]
        out.append((d, len(rows), len(rows) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def result(docs, **kwargs):
    got = lines.remove_near_lines(docs, **kwargs).collect()
    return sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept) for r in got), key=str)


def corpus(seed, edits):
    rng = random.Random(seed)
    letters = "abcdefghé😀 "
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(15, 50))) for _ in range(40)]

    def changed(line):
        line = list(line)
        for _ in range(rng.randrange(edits + 2)):
            at = rng.randrange(len(line))
            line[at : at + rng.randrange(2)] = rng.choice(["", rng.choice(letters), rng.choice(letters)])
        return "".join(line)

    docs = [(d, "\n".join(changed(rng.choice(base)) if rng.random() < 0.7 else rng.choice(["", "short", "-" * 30]) for _ in range(rng.randrange(8)))) for d in range(60)]
    return [*docs, (900, None), (901, ""), (None, base[0] + "\n" + base[0])]


@pytest.mark.parametrize("edits", [0, 1, 2, 3])
def test_against_brute_force(documents, edits):
    docs = corpus(edits, edits)
    got = result(documents(docs, CLASHING), edits=edits)
    assert got == brute(docs, edits, lines.LEAST_CHARS)
    assert sum(n for _, _, n, _ in got) > 20


def test_probes_are_as_few_as_the_bound():
    for edits in (1, 2, 3, 4):
        for longer in range(edits + 1):
            assert sum(p[0] == longer for p in lines.probes(edits)) == (edits * edits - longer * longer) // 2 + edits + 1


def test_edges(documents):
    assert result(documents([])) == []
    long = "".join(chr(97 + i * i % 23) for i in range(60_000))
    docs = [(1, long), (2, long[:30_000] + "#" + long[30_001:]), (3, long[3:]), (4, "x" * 25 + "\r\n" + "x" * 25)]
    assert result(documents(docs)) == [(1, 1, 0, long), (2, 1, 1, ""), (3, 1, 0, long[3:]), (4, 2, 1, "x" * 25 + "\r")]
    twice = [(7, "the very same line of text\nthe very same line of text")] * 2
    assert [r[2] for r in result(documents(twice))] == [1, 1]


@pytest.mark.parametrize("edits", [0, 1, 2, 4])
def test_sketches_never_part_similar_lines(spark, edits):
    """Few edits leave few bits changed, for any code points and lengths; many edits are told nearly always."""
    rng = random.Random(edits)
    letters = "abcdef é😀中"
    pairs = []
    for length in [0, 1, 2, 3, *[rng.randrange(4, 110) for _ in range(120)]]:
        for most in (edits, 60):
            b = a = [rng.choice(letters) for _ in range(length)]
            for _ in range(most):
                at = rng.randrange(len(b) + 1)
                b = b[:at] + rng.choice([[], [rng.choice(letters)], [rng.choice(letters)] + b[at : at + 1]]) + b[at + 1 :]
            pairs.append(("".join(a), "".join(b), most == edits))
    frame = spark.createDataFrame(pairs, "a string, b string, near boolean")
    told = lines.unlike(edits)(lines.sketch(F.col("a")), lines.sketch(F.col("b")))
    got = frame.select("a", "b", "near", told.alias("apart")).collect()
    assert not any(r.apart for r in got if r.near)
    exact = [distance(r.a, r.b, 25) for r in got]
    assert not any(r.apart for r, far in zip(got, exact) if far <= edits)
    told = [r.apart for r, far in zip(got, exact) if far > 4 * edits + 8]
    assert len(told) > 20 and sum(told) > 0.9 * len(told)


def test_a_template_with_many_fillings_needs_few_comparisons(spark, documents, monkeypatch):
    """Lines that share most segments but differ by a word each are told apart without the edit distance."""
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(150)]
    base = [" ".join(rng.choice(words) for _ in range(30)) for _ in range(3)]
    docs = []
    for d in range(240):
        text = base[d % 3].split(" ")
        text[rng.randrange(30)] = "".join(rng.choice("qrstuvwxyz") for _ in range(9))
        docs.append((d, " ".join(text)))
    docs.append((900, docs[0][1][:40] + "Q" + docs[0][1][41:]))
    compared = []
    searched = lines.pivot_links

    def counted(members, compare, *args):
        def also(pairs):
            compared.append(pairs.count())
            return compare(pairs)

        return searched(members, also, *args)

    monkeypatch.setattr(lines, "pivot_links", counted)
    # A word of other letters takes more edits than are allowed, so only the last line has a near one.
    assert result(documents(docs)) == sorted([*((d, 1, 0, t) for d, t in docs[:-1]), (900, 1, 1, "")], key=str)
    assert sum(compared) < 1000


def test_short_lines_go_only_if_equal(spark, documents, tmp_path):
    """The query removes short boilerplate that an earlier line equals; empty and merely similar lines stay."""
    long = "a line of text that is long enough for edits"
    docs = [(1, f"Read more\n{long}\n"), (2, f"Share this\n\nRead more\n{long}!"), (3, "Read mare\nShare this\nShare this\n")]
    documents(docs).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in QUERIES["op10_near_lines"](spark, str(tmp_path)).collect()}
    left = {1: docs[0][1], 2: "Share this\n", 3: "Read mare\n"}
    assert {i: r.kept_sha256 for i, r in got.items()} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in left.items()}
    assert {i: (r.n_removed, r.first_ids or "") for i, r in got.items()} == {1: (0, ""), 2: (2, "1"), 3: (2, "2")}
