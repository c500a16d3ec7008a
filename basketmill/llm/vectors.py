"""Vectors of Arrow batches as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: str) -> Column:
    """Whether a vector has components and all of them are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & finite


def finite_rows(column: pa.ListArray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the vectors that `is_finite` keeps, and these vectors as a matrix of doubles.

    One of another size than `size` is an error.
    """
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null is a NaN
    ends = np.cumsum(lengths)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    kept = (lengths > 0) & (bad[ends] == bad[ends - lengths])
    odd = lengths[kept & (lengths != size)]
    if len(odd):
        raise ValueError(f"vectors of {odd[0]} and of {size} components")
    return np.flatnonzero(kept), values[np.repeat(kept, lengths)].reshape(-1, size)


def scaled_floor(matrix: np.ndarray, scale: int, limit: int) -> np.ndarray:
    """floor(scale * x) of each component as a whole number below `limit` in size; a larger one is an error."""
    whole = np.floor(scale * matrix)
    if len(whole) and np.abs(whole).max() >= limit:
        raise ValueError(f"a component is {limit / scale:g} or more in size")
    return whole.astype(np.int64)


def joined(batches: Iterator[pa.RecordBatch], rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least so many, but for the last one."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(one.num_rows for one in waiting) >= rows:
            yield pa.concat_batches(waiting)
            waiting = []
    if waiting:
        yield pa.concat_batches(waiting)
