"""Vectors as whole numbers, and exact sums of them, for the operators on embeddings."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Scaled entries from here on are no 64-bit whole numbers whose differences still are.
LIMIT = float(1 << 62)


def whole_numbers(column: pa.Array, scale: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column with exactly ``dim`` entries, none NULL, non-finite or beyond
    ``LIMIT`` when scaled: their places, and floor(scale * entry) as 64-bit integers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.list_(pa.float64()))
    long = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(column.filter(pa.array(long)))
    x = scale * flat.to_numpy(zero_copy_only=False).reshape(-1, dim)  # NULL entries become NaN
    good = (np.abs(x) < LIMIT).all(axis=1)  # false for NaN and infinities
    return np.flatnonzero(long)[good], np.floor(x[good]).astype(np.int64)


def column_sums(x: np.ndarray) -> np.ndarray:
    """Exact column sums of 64-bit integers, as Python integers."""
    high, low = (x >> 31).sum(axis=0), (x & ((1 << 31) - 1)).sum(axis=0)
    return high.astype(object) * (1 << 31) + low.astype(object)


def decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))


def lists(x: np.ndarray) -> pa.Array:
    """A matrix as an Arrow column of lists."""
    n, dim = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * dim), pa.array(x.ravel()))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A column of lists of ``dim`` entries each as a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, dim)
