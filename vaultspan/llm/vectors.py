"""Reading vector columns: rows of finite numbers that are not all zero, by dimension."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def number_type(rows: DataFrame, column: str) -> str:
    """The narrowest NumPy type that holds the column's numbers exactly."""
    element = rows.schema[column].dataType.elementType
    return "<f4" if isinstance(element, T.FloatType) else "<f8"


def usable(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix in double precision) for every dimension in the column.

    Null vectors, empty ones, zero ones and those with null or non-finite components are left out.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lists = column.cast(pa.list_(pa.float64()))
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    lengths[~lists.is_valid().to_numpy(zero_copy_only=False)] = 0
    for size in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == size)
        matrix = values[offsets[rows][:, None] + np.arange(size)]
        good = np.isfinite(matrix).all(axis=1) & (matrix != 0).any(axis=1)
        yield rows[good], matrix[good]


def as_unit(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow."""
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def sampled(rows: DataFrame, column: str, kind: str, most: int) -> dict[int, np.ndarray]:
    """A bounded sample for fitting, by dimension: the ``most`` vectors with the smallest hashes."""
    picked = rows.select(column).orderBy(F.xxhash64(column)).limit(most).collect()
    by_size: dict[int, list[np.ndarray]] = {}
    for row in picked:
        vector = np.frombuffer(row[0], dtype=kind).astype(float)
        by_size.setdefault(len(vector), []).append(vector)
    return {size: np.stack(group) for size, group in by_size.items()}
