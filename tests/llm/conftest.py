from __future__ import annotations

import os
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A frame from (doc_id, text) or (doc_id, text, source)."""

    def make(rows, extra=()):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", 0) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        # Names that operators use inside must not get into each other's way.
        for name in extra:
            df = df.withColumn(name, F.lit(-7))
        return df

    return make


@pytest.fixture(scope="session")
def given(small):
    """Rows of a given small table."""

    def read(name, columns):
        return duckdb.sql(f"select {columns} from '{small}/{name}.parquet' order by all").fetchall()

    return read

