from __future__ import annotations

import hashlib
import random
import zlib

from names import CLASHING
from pyspark.sql import functions as F

from mixlens.llm import merkle

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"

PLAIN = merkle.manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def proof_of(nodes, at):
    """[(sibling or None, is it left)] up to the root, and the root."""
    path = []
    while len(nodes) > 1:
        other = at ^ 1
        path.append((nodes[other] if other < len(nodes) else None, bool(at & 1)))
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        at >>= 1
    return path, nodes[0]


def brute(rows):
    """Rows of the query, by definition."""
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda v: (v is not None, (v or "").encode()))
    for lang in langs:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    leaves = {lang: [leaf_of(r) for r in trees[lang]] for lang in langs}
    subroots = [proof_of(leaves[lang], 0)[1] for lang in langs]
    found = []
    for t, lang in enumerate(langs):
        upper, root = proof_of(subroots, t)
        for at, r in enumerate(trees[lang]):
            path, subroot = proof_of(leaves[lang], at)
            node = leaves[lang][at]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                node = leaf_of((*r[:3], r[3] + 1, r[4]))
            for sibling, left in path + upper:
                node = h(sibling or "", node) if left else h(node, sibling or "")
            siblings = [s for s, _ in path + upper if s]
            found.append((r[0], leaves[lang][at], subroot, root, h(*siblings), node, node == root))
    return sorted(found, key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    some = ["x", "", None, "zwei Wörter\n", "long " * 500]
    return [
        (i * 3 - 5, rng.choice(["a", "b", None]), rng.choice(["en", "de", "\U0001f600", "￿", None, "en", "en", ""]),
         rng.choice([None, 7, 123]), rng.choice(some))
        for i in range(n)
    ]


def run(spark, rows, monkeypatch, bits=merkle.BITS, extra=()):
    """The registered query over a table of these rows."""
    from mixlens.llm import queries

    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in extra:
        df = df.withColumn(name, F.lit(-7))
    monkeypatch.setattr(queries, "read", lambda *_: df)
    monkeypatch.setattr(merkle, "manifest", lambda *a: PLAIN(*a, bits))
    got = queries.op12_merkle_manifest(spark, "")
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_against_single_proofs(spark, monkeypatch):
    """Storeys of two levels, ragged ends, trees of one leaf."""
    rows = corpus(150) + [(1000, "a", "fr", 4, "alone"), (7, "s", "it", None, "x"), (8, "s", "it", None, "x")]
    assert run(spark, rows, monkeypatch, 2, CLASHING) == brute(rows)


def test_edges(spark, monkeypatch):
    rows = corpus(40, 2)
    rows += rows[:6] + [(None, None, None, None, None)] * 3 + [(4, "other", "en", 9, "t"), (4, "a", "en", 9, "t")]
    assert run(spark, rows, monkeypatch, 3) == brute(rows)
    assert run(spark, [], monkeypatch) == []
    one = [(7, "a", None, 3, "text")]
    assert run(spark, one, monkeypatch) == brute(one)


def test_lacking_is_minimal():
    """What is lacking and the leaves give the root, and nothing that is lacking can be left out."""
    rng = random.Random(3)
    for n in (1, 2, 3, 5, 8, 13, 33, 64):
        leaves = [h(str(i)) for i in range(n)]
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
        sizes = merkle.widths(n)
        assert sizes == [len(x) for x in levels]
        for _ in range(6):
            wanted = sorted(rng.sample(range(n), rng.randint(1, n)))
            asked = merkle.lacking(wanted, sizes)
            assert len(set(asked)) == len(asked)

            def root(asked):
                known = {i: leaves[i] for i in wanted}
                for level in range(len(sizes) - 1):
                    known.update({at: levels[lv][at] for lv, at in asked if lv == level})
                    known = merkle.parents(known, sizes[level])
                return known.get(0)

            assert root(asked) == levels[-1][0]
            assert all(root([a for a in asked if a != left]) is None for left in asked)


def test_proofs_of_some_rows(spark):
    """Few wanted leaves: siblings come from all levels, and each path leads to the root."""
    rows = [(i, "s", "en" if i % 3 else "de", i, str(i)) for i in range(300)]
    df = spark.createDataFrame(rows, SCHEMA)
    made = merkle.manifest(df, "lang", ["doc_id"], merkle.leaf_digest(*[F.col(c) for c in COLUMNS]), ["doc_id"], 4)
    wanted = made.groups.leaves.where("row.doc_id % 37 = 5")
    got = merkle.proofs(made, wanted).collect()
    trees = {lang: [leaf_of(r) for r in rows if r[2] == lang] for lang in ("de", "en")}
    subroots = [proof_of(trees[lang], 0)[1] for lang in ("de", "en")]
    assert sorted(r.row.doc_id for r in got) == [i for i in range(300) if i % 37 == 5]
    for r in got:
        t = ["de", "en"].index(r.group)
        path, _ = proof_of(trees[r.group], trees[r.group].index(leaf_of(rows[r.row.doc_id])))
        assert [tuple(s) for s in r.path] == path + proof_of(subroots, t)[0]
        assert r.leaf == leaf_of(rows[r.row.doc_id]) and r.root == h(*subroots)


def test_query(spark, small, given):
    from mixlens.llm.queries import QUERIES

    got = sorted((tuple(r) for r in QUERIES["op12_merkle_manifest"](spark, small).collect()), key=str)
    assert got == brute([tuple(r) for r in given("documents", ", ".join(COLUMNS))])
    assert {r[-1] for r in got} == {True, False}
