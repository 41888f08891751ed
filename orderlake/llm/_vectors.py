"""Vectors out of Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, not empty, all components finite, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as rows of doubles."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that squares neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def exact_cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of ``x`` with ``y`` (one row, or as many); equal rows give equal values whatever stands beside them."""
    return (x * y).sum(axis=-1) / (np.sqrt((x * x).sum(axis=-1)) * np.sqrt((y * y).sum(axis=-1)))
