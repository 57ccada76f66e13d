"""Every registered query against its SQL on another engine."""

from __future__ import annotations

import os

import compare
import pytest

import __spark_entry__ as entry
from mixlens.plans.oracle import oracle_sql
from mixlens.plans.queries import QUERIES

SQL = oracle_sql()
# Fits need a few hundred campaigns; the smallest tables leave channels without any spend.
FITTED = ("m5", "m6", "m7", "m8", "m9", "m10", "m11", "m12", "m13", "m14", "m15", "m16", "m20", "m22")


@pytest.fixture(scope="module")
def connections():
    return {}


def directory(name):
    return "/root/testdata/sf0.01" if name.startswith(FITTED) else "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, connections, name):
    path = directory(name)
    if not os.path.isdir(path):
        pytest.skip("the tables are not here")
    if path not in connections:
        connections[path] = compare.connect(path)
    assert compare.difference(QUERIES[name](spark, path), connections[path], SQL[name]) is None


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark, small):
    df = entry.entry(spark)
    assert df.count() > 0 and "roas" in df.columns
