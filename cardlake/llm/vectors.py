"""What the operators on vectors share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Integer components lie within this, so that sums of products stay exact in 64 bits.
LARGEST = 1 << 24


def is_whole(vector: str) -> Column:
    """Whether a vector is there, has components, and each of them is a finite number."""
    finite = F.forall(F.col(vector), lambda x: F.coalesce(
        ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def whole_vectors(vectors: DataFrame, vec_id: str, vector: str, *others: Column) -> DataFrame:
    """(vec_id long, vector array<double>, *others) of the rows with a whole vector of the
    table's length, which is that of its least vector by id (nulls last)."""
    kept = vectors.filter(is_whole(vector)).select(
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"), *others)
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select(
        F.size("vector").alias("n")).first()
    return kept.filter(F.size("vector") == (first["n"] if first else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as a matrix of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), within ``LARGEST``."""
    return np.clip(np.floor(scale * x), -LARGEST, LARGEST).astype(np.int64)
