from __future__ import annotations

import math
import zlib
from collections import Counter
from hashlib import md5

from names import CLASHING

from mixlens.llm import sharding


def walk(doc_id, tree):
    """The shard by the definition, one row at a time."""
    key, at = "null" if doc_id is None else str(doc_id), [x for x in tree if x.weight > 0]
    for i, level in enumerate(("region", "rack", "shard")):
        weights = Counter()
        for leaf in at:
            weights[leaf[i]] += leaf.weight
        draw = {
            n: -math.log((int(md5(f"{key}|{level}{n}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48) / w
            for n, w in weights.items()
        }
        best = min(draw, key=draw.get)
        at = [leaf for leaf in at if leaf[i] == best]
    return at[0].shard


def test_the_definition_and_movement(documents):
    tree = sharding.balanced_tree(16)
    more = sharding.grown(tree)
    heavier = tuple(x._replace(weight=3.0) if x.shard == 5 else x for x in tree)
    docs = documents([(i, "x") for i in range(2000)] + [(None, "x"), (-3, None)])
    got = docs
    for name, t in (("s", tree), ("m", more), ("h", heavier)):
        got = sharding.assign(got, t, name)
    got = got.collect()
    assert all((r.s, r.m) == (walk(r.doc_id, tree), walk(r.doc_id, more)) for r in got)
    assert {r.m for r in got if r.m != r.s} == {16}
    # A heavier shard draws rows into its region; others keep theirs.
    assert {r.h // 4 for r in got if r.h != r.s} == {1}
    counts = Counter(r.m for r in got)
    assert set(counts) == set(range(17)) and max(counts.values()) < 2 * min(counts.values())


def test_empty_weights_get_no_rows(documents):
    tree = (sharding.Leaf(0, 0, 0, 0.0), sharding.Leaf(0, 0, 1, 1.0), sharding.Leaf(1, 1, 2, 2.0))
    got = sharding.assign(documents([(i, "") for i in range(300)]), tree)
    assert {r.shard for r in got.collect()} == {1, 2}


def test_slots_have_no_gap_also_with_repeated_rows(documents):
    docs = documents([(i % 50, f"t{i % 60}") for i in range(500)] + [(7, "same")] * 400 + [(None, None)] * 3)
    placed = sharding.assign(sharding.thin(docs), sharding.balanced_tree(4))
    got = sharding.with_slots(placed).collect()
    assert len(got) == 903
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.with_slots(sharding.assign(sharding.thin(documents([])), sharding.balanced_tree(4))).count() == 0


def test_thin(documents):
    got = {r.doc_id: r for r in sharding.thin(documents([(1, "é\n"), (2, None), (3, "")], CLASHING)).collect()}
    assert got[1].size == 4 and got[1].text_crc32 == zlib.crc32("é\n".encode())
    assert got[2].size == got[3].size == 1 and got[2].text_crc32 == 0
    docs = documents([(1, "é")], [c for c in CLASHING if c != "shard"])
    assert sharding.assign(docs, sharding.balanced_tree(4)).columns == [*docs.columns, "shard"]
