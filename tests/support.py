"""What several tests use."""

from __future__ import annotations


def rows(df, *order):
    """Rows as tuples, sorted by the given columns."""
    got = df.orderBy(*order).collect() if order else df.collect()
    return [tuple(r) for r in got]
