"""Shared by the operators on vectors: which take part, and packed blocks of them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_finite(vector: Column) -> Column:
    """Not NULL, not empty, and every component a finite number."""
    return F.coalesce(
        (F.size(vector) > 0)
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
        F.lit(False),
    )


def packed(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def stacked(vectors, dim: int) -> np.ndarray:
    return np.concatenate([np.asarray(v, np.float64) for v in vectors]).reshape(-1, dim)
