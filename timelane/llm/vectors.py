"""Vectors as NumPy matrices: which rows are usable, and their matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def usable(column: str) -> Column:
    """Neither null nor empty nor zero, and every component finite."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(F.col(column).isNotNull() & finite & F.exists(column, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of one length as a double matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def by_length(docs: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, v, dim): usable vectors.  Only vectors of equal length are ever compared."""
    rows = docs.where(F.col(key).isNotNull() & usable(vector))
    return rows.select(F.col(key).cast("bigint").alias(key), F.col(vector).cast("array<double>").alias("v"), F.size(vector).alias("dim"))
