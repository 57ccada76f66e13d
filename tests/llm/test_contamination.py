from __future__ import annotations

import random

from names import CLASHING

from mixlens.llm import contamination


def shingles(text):
    words = (text or "").lower().encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, items, least=0.8):
    sets = {(i, t): shingles(t) for i, t in items}
    out = set()
    for d, text in docs:
        mine = shingles(text)
        for (i, _), s in sets.items():
            if s and len(s & mine) >= least * len(s) - 1e-9:
                out.add((d, i, len(s & mine), len(s)))
    return out


def cases():
    rng = random.Random(3)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + rng.choice("qrstuv")
    items = [(i, " ".join(word() for _ in range(rng.randrange(3, 70)))) for i in range(40)] + [(40, None), (41, "")]
    docs = []
    for d in range(150):
        words = [word() for _ in range(rng.randrange(0, 900))]
        for i, text in rng.sample(items[:40], rng.randrange(3)):
            part = text.split()
            for k in range(len(part)):
                if rng.random() < 0.03:
                    part[k] = "changed"
            at = rng.randrange(len(words) + 1)
            words[at:at] = [w.upper() for w in part] if d % 5 == 0 else part
        docs.append((d, "\n".join([" ".join(words[:50]), " ".join(words[50:])])))
    return docs, items


def found(spark, docs, items, **kwargs):
    frame = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id, r.shared, r.size) for r in contamination.search(docs, frame, **kwargs).collect()}


def test_every_contained_item_is_found(spark, documents):
    docs, items = cases()
    for least in (0.8, 0.5, 1.0):
        got = found(spark, documents(docs), items, least=least)
        assert got == brute(docs, items, least) and len(got) > 20


def test_clean_keeps_the_rest_and_all_columns(spark, documents):
    docs, items = cases()
    frame = spark.createDataFrame(items, "item_id long, text string")
    hit = {d for d, *_ in brute(docs, items)}
    df = documents(docs + docs[:3] + [(None, docs[0][1]), (None, None), (0, "other text of the same id")], CLASHING)
    got = contamination.clean(df, frame)
    assert got.columns == df.columns
    ids = [r.doc_id for r in got.collect()]
    assert {i for i in ids if i is not None and i > 2} == {d for d, _ in docs if d not in hit and d > 2}
    assert 0 in ids and None in ids


def test_edges(spark, documents):
    text = "one two three four five six seven eight"
    long = "filler " * 200_000 + text
    docs = documents([(1, text), (1, text), (2, None), (3, ""), (None, text), (4, long)], CLASHING)
    got = found(spark, docs, [(7, text), (7, text), (8, "one two"), (None, text)])
    assert got == {(d, i, 4, 4) for d in (1, None, 4) for i in (7, None)} or got == {(d, 7, 4, 4) for d in (1, None, 4)}
    assert found(spark, documents([]), [(7, text)]) == set()
    assert found(spark, docs, []) == set()


def test_items_without_an_id_are_found_and_short_ones_counted(spark, documents, caplog):
    one, two = "one two three four five six seven eight", "red green blue black white grey brown"
    docs = documents([(1, f"x {one} y"), (2, two), (3, "nothing of it"), (4, f"{one} {two}")], CLASHING)
    items = [(None, one), (None, two), (5, two), (6, "one two"), (7, None)]
    got = found(spark, docs, items)
    assert got == {(1, None, 4, 4), (2, None, 3, 3), (2, 5, 3, 3), (4, None, 4, 4), (4, None, 3, 3), (4, 5, 3, 3)}
    assert "2 items of under 5 words" in caplog.text
    frame = spark.createDataFrame(items, "item_id long, text string")
    assert contamination.left_out(frame) == 2
    assert [r.doc_id for r in contamination.clean(docs, frame.where("item_id is null")).collect()] == [3]
