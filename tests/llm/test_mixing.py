from __future__ import annotations

import pytest
from names import CLASHING

from mixlens.llm import mixing


def taken(docs, **kwargs):
    rows, _ = mixing.mix(docs, **kwargs)
    return {(r.doc_id, r.source): r for r in rows.collect()}


def fill(sizes, share, cap=2.0, weights=(5, 2, 1)):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, full, budget = set(names), {}, share * sum(sizes.values())
    while left:
        rest = budget - sum(full.values())
        part = {n: rest * weight[n] / sum(weight[m] for m in left) for n in left}
        over = {n for n in left if part[n] >= cap * sizes[n]}
        if not over:
            return {**full, **part}
        full.update({n: cap * sizes[n] for n in over})
        left -= over
    return full


def test_targets_and_taken_words(documents):
    data = [(i, "w " * (1 + i % 7), ["a", "b", "é", None][i % 4 if i % 5 else 0]) for i in range(600)]
    got = taken(documents(data))
    sizes = {}
    for i, text, source in data:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = fill(sizes, 1.5)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for source, size in sizes.items():
        mine = [r for r in got.values() if r.source == source]
        assert {r.source_size for r in mine} == {size}
        assert mine[0].taken_target == pytest.approx(want[source])
        assert sum(r.size * r.taken_times for r in mine) == pytest.approx(want[source], abs=7)
    assert max(r.taken_times for r in got.values()) <= 2
    assert got == taken(documents(data))


def test_larger_budgets_take_all_that_smaller_ones_take(documents):
    docs = documents([(i, "x y z " * (1 + i % 3), "ab"[i % 2]) for i in range(300)])
    rows, _ = mixing.mix(docs, shares={"small": 0.4, "large": 0.9})
    both = rows.collect()
    assert all(r.small_times <= r.large_times for r in both)
    assert sum(r.small_times for r in both) < sum(r.large_times for r in both)


def test_edges(documents):
    got = taken(documents([(1, None, "a"), (2, "", "b"), (None, " \t\x0b", None), (3, "one two", "a"), (3, "one two", "a")]))
    assert got[(1, "a")].size == 0 and got[(None, None)].taken_target == 0
    assert got[(3, "a")].source_size == 4 and got[(3, "a")].taken_times in (1, 2)
    assert mixing.mix(documents([]))[0].count() == 0
    assert mixing.repeat_rows(documents([])).count() == 0


def test_repeated_rows_keep_their_columns(documents):
    docs = documents([(i, "a b c", "s") for i in range(10)], CLASHING)
    got = mixing.repeat_rows(docs, (1,), 2.0)
    assert got.columns == docs.columns
    assert got.orderBy("doc_id").collect() == docs.union(docs).orderBy("doc_id").collect()
