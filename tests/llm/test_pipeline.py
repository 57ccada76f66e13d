from __future__ import annotations

import os

import compare
import pytest
from names import CLASHING
from test_contamination import brute as leaks
from test_near_dup import brute as near

import __spark_entry__ as entry
import corpus_pipeline
from mixlens.llm import mixing, quality, sharding
from mixlens.llm.oracle import ORACLE_SQL
from mixlens.llm.queries import QUERIES


def test_the_stages_follow_each_other(spark, small):
    """Each stage against brute force over what the stage before has kept."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, small).cache()
    kept = {r.doc_id for r in quality.assess(docs).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and good.columns == docs.columns
    one = stages["near_copies"](spark, good, small).cache()
    rest = sorted((i, texts[i]) for i in kept)
    firsts = set(near(rest).values())
    assert sorted(r.doc_id for r in one.collect()) == sorted(firsts)
    clean = stages["decontamination"](spark, one, small).cache()
    found = {d for d, *_ in leaks([(i, texts[i]) for i in firsts], items)}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(firsts - found)
    mixed = stages["mixing"](spark, clean, small).cache()
    times = {r.doc_id: r.taken_times for r in mixing.mix(clean)[0].collect()}
    ids = [r.doc_id for r in mixed.collect()]
    assert {i: ids.count(i) for i in times} == times and mixed.columns == docs.columns
    sharded = stages["sharding"](spark, mixed, small)
    tree = sharding.balanced_tree(16)
    assert sharded.columns == [*docs.columns, "shard"]
    where = {r.doc_id: r.shard for r in sharding.assign(mixed.select("doc_id"), tree).collect()}
    assert sorted((r.doc_id, r.shard) for r in sharded.collect()) == sorted((i, where[i]) for i in ids)


def test_stages_take_odd_tables(spark, documents, small):
    prose = "Here are quite enough ordinary words to make a sentence of common prose, so that it passes as number {}."
    rows = [(i, prose.format(" ".join(f"v{i}x{k}" for k in range(20))), None if i % 3 else "s") for i in range(12)]
    odd = documents([*rows, rows[0], (None, None), (5, ""), (None, rows[1][1])], CLASHING)
    for _, stage in corpus_pipeline.STAGES:
        got = stage(spark, odd, small)
        assert got.columns[: len(odd.columns)] == odd.columns
        got.collect()
        empty = stage(spark, odd.limit(0), small)
        assert empty.count() == 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    path = "/root/testdata/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("the tables are not here")
    assert compare.difference(QUERIES[name](spark, path), compare.connect(path), ORACLE_SQL[name]) is None


def test_all_are_registered():
    names = list(entry.queries())
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(ORACLE_SQL) <= set(entry.oracle_sql())
