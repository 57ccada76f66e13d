"""Vectors on a grid of whole numbers, in Spark and as NumPy matrices."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def on_grid(rows: DataFrame, scale: int, column: str = "embedding") -> DataFrame:
    """vec_id and ``x``, floor(scale * c) of each component c as a long, of vectors that are whole.

    A vector that is null or holds a null, NaN or infinite component is left out.
    """

    def finite(c):
        return c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))

    value = F.col(column)
    x = F.transform(value, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))
    return rows.where(value.isNotNull() & F.forall(value, finite)).select("vec_id", x.alias("x"))


def matrix(column):
    """An Arrow list column as a matrix of 64-bit integers; shorter lists end with zeros."""
    import numpy as np
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    length = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(length.max(initial=0))
    if (length == width).all():
        return flat.reshape(len(length), width)
    full = np.zeros((len(length), width), np.int64)
    full[np.arange(width) < length[:, None]] = flat
    return full


def widened(x, width: int):
    """The matrix with zero columns up to a width."""
    import numpy as np

    return x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1])))
