"""Vectors as exact integers, in Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 1024


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, limit: float, dims: int | None = None, shift: int = 0) -> DataFrame:
    """``__id`` and ``__x``, the vector's components c as integers floor(1024 c) + ``shift``.

    Rows are left out whose vector is null or empty, holds a null, NaN or infinite
    component or one beyond ``limit`` in absolute value (whose integers and squares
    would not be exact), or has not ``dims`` components (if given)."""
    c = F.col(vector_col).cast("array<double>")
    # NaN and infinity are greater than any limit
    sound = F.forall(c, lambda x: x.isNotNull() & (F.abs(x) <= F.lit(float(limit))))
    size = F.size(c) == dims if dims is not None else F.size(c) > 0
    return df.where(F.coalesce(size & sound, F.lit(False))).select(
        F.col(id_col).alias("__id"), F.transform(c, lambda x: F.floor(x * SCALE) + F.lit(shift).cast("bigint")).alias("__x"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of an array column, all of ``dims`` elements and none null, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def arrays(values: np.ndarray) -> pa.Array:
    """A matrix as an array column."""
    n, dims = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * dims, dims, dtype=np.int32)), pa.array(np.ascontiguousarray(values).ravel()))


def hex_sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)
