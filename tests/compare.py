"""Compare registered queries with their SQL counterparts on DuckDB."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date().isoformat()
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: [(v is None, str(type(v)), str(v)) for v in r])


def difference(df, con, sql: str) -> str | None:
    """What differs between a Spark result and a SQL result, or None."""
    result = con.execute(sql)
    sql_columns = [c[0] for c in result.description]
    expected = result.fetchall()
    got = df.collect()
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} vs {sorted(sql_columns)}"
    if len(got) != len(expected):
        return f"{len(got)} rows vs {len(expected)}"
    a, b = _rows(df.columns, got), _rows(sql_columns, expected)
    bad = [(x, y) for x, y in zip(a, b) if [(v, type(v)) for v in x] != [(v, type(v)) for v in y]]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, columns {sorted(df.columns)}, first {bad[0][0]} vs {bad[0][1]}"
    return None


def main(sf_dir: str, names: list[str]) -> None:
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as e
    from mixlens.session import build_session

    spark = build_session(master="local[8]", conf={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = connect(sf_dir), e.oracle_sql()
    queries = e.queries()
    print("no SQL:", sorted(set(queries) - set(sqls)), "no query:", sorted(set(sqls) - set(queries)))
    bad = 0
    for name, fn in queries.items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                problem = difference(df, con, sqls[name])
            else:
                problem = None if len(df.collect()) else "no rows"
        except Exception as error:  # noqa: BLE001 - every failure is reported
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
