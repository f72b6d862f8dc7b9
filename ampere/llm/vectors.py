"""Helpers of the operators on embeddings: which vectors take part, and vectors as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds no null, NaN or infinite component (never null)."""
    inf = F.lit(float("inf"))
    good = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < inf), F.lit(False)))
    return vector.isNotNull() & F.coalesce(good, F.lit(False))


def dimension(df: DataFrame, key: str, vector: str, multiple: int = 1) -> int:
    """Length of the vector of the smallest key (null keys last) whose length is a positive
    multiple of ``multiple``; 0 if there is none."""
    n = F.size(vector)
    fits = df.where((n > 0) & (n % multiple == 0))
    return fits.agg(F.min_by(n, F.struct(F.col(key).isNull(), F.col(key), n))).first()[0] or 0


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    """An Arrow list column of vectors without nulls, all ``width`` long, as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)
