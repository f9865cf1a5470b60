"""Vectors as classes of exact copies, shared by the two embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors that are not null or empty, hold no null or non-finite component, and are not zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0), F.lit(False))


def plain(vector: Column) -> Column:
    """The vector in double precision, with -0.0 as 0.0 (copies then have equal bytes)."""
    return F.transform(vector, lambda x: x.cast("double") + F.lit(0.0))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column of equal lengths as a matrix."""
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def classes(rows: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(id, vec, n): one row for each distinct usable vector, its least id and its number of rows."""
    good = rows.where(usable(F.col(vector)) & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), plain(F.col(vector)).alias("vec"))
    return good.groupBy("vec").agg(F.min("id").alias("id"), F.count("*").alias("n")).select("id", "vec", "n")
