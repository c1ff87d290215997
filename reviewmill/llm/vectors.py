"""Vectors in tasks: validity, packing into blocks of one row, least labels of linked rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: str | Column) -> Column:
    """True for an array without null, NaN or infinite component; false for a null array."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad, F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray, width: int, kind: type = np.float64) -> np.ndarray:
    """Rows of a list column as a matrix; a shorter row is filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    out = np.zeros((len(column), max(width, 1)), kind)
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = flat
    return out


def packed(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def least_connected(linked: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """The least label of the connected component of every row of a symmetric link matrix."""
    largest = np.iinfo(labels.dtype).max
    while True:
        least = np.minimum(labels, np.where(linked, labels[None, :], largest).min(axis=1, initial=largest))
        if np.array_equal(least, labels):
            return labels
        labels = least


def least_connected_sides(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for links between the rows of two blocks."""
    largest = np.iinfo(left.dtype).max
    while True:
        near = np.minimum(left, np.where(linked, right[None, :], largest).min(axis=1, initial=largest))
        far = np.minimum(right, np.where(linked, near[:, None], largest).min(axis=0, initial=largest))
        if np.array_equal(near, left) and np.array_equal(far, right):
            return left, right
        left, right = near, far
