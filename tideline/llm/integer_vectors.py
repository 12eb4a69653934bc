"""Vectors with integer components, shared by the operators that compare vectors exactly."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sums of squares and products of this size, a little above it and five times it fit a long.
ROOM = 1 << 59


def scaled(embedding: str, scale: float) -> Column:
    """``floor(scale * x)`` of each component x, as double."""
    return F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))


def usable(embedding: str, scale: float) -> Column:
    """Whether a vector is there, holds finite components only and is small enough for exact sums in a long."""
    as_double = lambda x: F.lit(float(scale)) * x.cast("double")
    limit = F.sqrt(F.lit(float(ROOM)) / F.greatest(F.size(embedding), F.lit(1)))
    # A comparison with a component that is no number is true in Spark (NaN counts as the greatest).
    small = F.forall(embedding, lambda x: x.isNotNull() & (F.abs(as_double(x)) < limit - 1))
    return F.coalesce(small, F.lit(False))


def matrix(column: pa.Array, rows: np.ndarray, length: int) -> np.ndarray:
    """The vectors at ``rows``, which all have ``length`` components."""
    starts = np.asarray(column.offsets)[rows].astype(np.int64)
    return np.asarray(column.values)[starts[:, None] + np.arange(length)].astype(np.int64)
