"""Batches of vectors for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_and_vector(rows: DataFrame) -> DataFrame:
    """Only what an operator reads, so that other columns, whatever their names, never meet its own."""
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"))


def finite(vector: Column) -> Column:
    """Whether no component is null, infinite or not a number; null for a null vector."""
    infinity = F.lit(float("inf"))
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x < infinity) & (x > -infinity))


def matrix(column: pa.Array) -> np.ndarray:
    """A column of vectors of one length, without nulls, as rows of doubles."""
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
