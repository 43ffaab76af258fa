"""Integer vectors and their exact inner products."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
MOST = float(1 << 62)
EXTREME = (1 << 63) - 1


def integer_vectors(table: DataFrame, id_col: str, vec_col: str, *more: str, scale: int = SCALE) -> DataFrame:
    """``row, id, v`` (+ ``more``) for each row with an id and a usable vector: ``v`` holds floor(scale * x) of
    each component as a long, ``row`` is unique to the row (write the table before it is used twice). Vectors
    that are null or hold null or non-finite components are left out. A component over 62 bits is an error."""
    x = F.col(vec_col)
    good = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))

    def whole(c):
        scaled = F.lit(float(scale)) * c.cast("double")
        return F.when(F.abs(scaled) < MOST, F.floor(scaled)).otherwise(
            F.raise_error(F.lit("vector component over 62 bits")).cast("long"))

    return (table.where(good & F.col(id_col).isNotNull())
            .select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                    F.transform(x, whole).alias("v"), *more))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The rows of an array column, all of length ``dim``."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(len(column), dim)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices: as float64 or int64 where no sum can leave
    their whole numbers, else with Python integers. A score over 64 bits comes out as the extreme (see ``checked``)."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 2.0 ** 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if most < 2.0 ** 63:
        return a @ b.T
    wide = a.astype(object) @ b.T.astype(object)
    return np.clip(wide, -EXTREME, EXTREME).astype(np.int64)


def checked(score: Column) -> Column:
    """``score``, or an error if it is over 64 bits."""
    return F.when(F.abs(score) < EXTREME, score).otherwise(F.raise_error(F.lit("inner product over 64 bits")).cast("long"))
