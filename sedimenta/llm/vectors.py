"""What the two vector searches share: valid vectors, blocks, and pairs of blocks."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Neither NULL nor holding NULL or non-finite components."""
    return F.col(vector).isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )


def blocked(vectors: DataFrame, name: str, rows: int, count: int) -> tuple[DataFrame, int]:
    """Deal rows to ``ceil(count / rows)`` blocks by a hash of their id and vector ``v``."""
    n = max(1, math.ceil(count / rows))
    return vectors.withColumn(name, F.pmod(F.xxhash64("vec_id", "v"), F.lit(n)).cast("int")), n


def matrix(table: pa.Table, name: str) -> np.ndarray:
    """A list column of equal lengths as a two-dimensional array."""
    column = table.column(name).combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) and len(values) else values.reshape(len(column), 0)


def spread(blocks: DataFrame, other: str, n: int) -> DataFrame:
    """Each row once for each block of the other side: the two sides then meet in
    one task per pair of blocks, with a bounded number of rows from either."""
    return blocks.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
