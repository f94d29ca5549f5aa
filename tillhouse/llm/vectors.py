"""Vectors in Arrow columns as numpy matrices, and which vectors can be compared at all."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def matrix(column: pa.ChunkedArray | pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """A list column, every list of ``width`` numbers, as one matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(-1, width)


def lists(values: np.ndarray) -> pa.Array:
    """A matrix as a list column."""
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width, pa.int32()), pa.array(values.reshape(-1)))


def finite(vector: Column) -> Column:
    """True for a vector whose components are all there and finite; never null."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))
