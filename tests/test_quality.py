from __future__ import annotations

import pytest
from support import rows
from pyspark.sql import types as T

from mixlens.operators import quality as q


@pytest.fixture(scope="module")
def tables(spark):
    return {
        "child": spark.createDataFrame(
            [(1, "a", "x"), (1, "b", "x"), (2, None, None), (None, "zz", "y"), (3, "zz", "y"), (None, "a", "x")],
            "id int, parent_id string, kind string",
        ),
        "parent": spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "pid string"),
    }


def failing(result):
    return {r["check"]: r["failing_rows"] for r in result.collect()}


def test_every_kind(tables):
    result = q.run_checks(
        tables,
        [
            *q.not_null("child", "id", "kind"),
            q.unique("child", "id"),
            q.unique("parent", "pid", severity="warn"),
            q.relationship("child", "parent_id", "parent", "pid"),
            q.unique_combination("child", "id", "kind"),
        ],
    )
    assert failing(result) == {
        "not_null_child_id": 2,
        "not_null_child_kind": 1,
        "unique_child_id": 1,
        "unique_parent_pid": 1,
        "relationship_child_parent_id_to_parent": 2,
        "unique_combination_child_id_kind": 1,
    }
    with pytest.raises(q.ChecksFailed, match="not_null_child_id: 2 rows"):
        q.assert_checks(result)


def test_columns_read_by_checks():
    checks = [*q.not_null("child", "id", "kind"), q.relationship("child", "parent_id", "parent", "pid"), q.unique("child", "id")]
    assert q.columns_read([checks[:2], *checks[2:]]) == {"child": ["id", "kind", "parent_id"], "parent": ["pid"]}


def test_warnings_do_not_raise(tables):
    result = q.run_checks(tables, [q.unique("parent", "pid", severity="warn"), q.not_null("child", "parent_id", severity="warn")])
    assert rows(q.assert_checks(result).select("check"), "check") == [("not_null_child_parent_id",), ("unique_parent_pid",)]


def test_empty_tables_pass(tables):
    empty = {name: df.where("false") for name, df in tables.items()}
    result = q.run_checks(empty, [*q.not_null("child", "id"), q.unique("child", "id"), q.relationship("child", "parent_id", "parent", "pid")])
    assert set(failing(result).values()) == {0}


def test_declared_checks_are_complete():
    kinds = [c.kind for c in [*q.MART_CHECKS, *q.MIX_CHECKS]]
    assert len(kinds) == 30
    assert [kinds.count(k) for k in ("not_null", "unique", "relationship", "unique_combination")] == [18, 5, 4, 3]
    assert sum(c.severity == "warn" for c in q.MART_CHECKS) == 3


def test_checks_from_schema():
    checks = q.checks_from_schema("fact_business_report")
    assert [(c.kind, c.columns) for c in checks] == [
        ("not_null", ("snapshot_date",)),
        ("not_null", ("asin",)),
        ("unique_combination", ("snapshot_date", "asin")),
        ("relationship", ("asin",)),
    ]


def test_schema_drift(tables):
    expected = T.StructType.fromDDL("id bigint, parent_id string, channel string")
    got = q.schema_drift(tables["child"], expected, {"id": (2, None), "parent_id": ("a", "b"), "absent": (0, 1)})
    assert rows(got, "problem", "column") == [
        ("channel", "missing", "string", None),
        ("id", "range", "outside [2, ]", 2),
        ("parent_id", "range", "outside [a, b]", 2),
        ("id", "type", "bigint -> int", None),
        ("kind", "unexpected", "string", None),
    ]
    assert q.schema_drift(tables["child"], tables["child"].schema).count() == 0
