"""Valid vectors of an embedding table, as Spark rows and as numpy blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(c: Column) -> Column:
    """True for a vector that is not null, not zero and has no null or non-finite component."""
    inf = float("inf")
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == inf))
    return c.isNotNull() & ~bad & F.exists(c, lambda x: x != 0)


def common_length(df: DataFrame, vec: str) -> int:
    """The length most valid vectors have (ties: the larger); 0 if there is none."""
    row = (df.where(finite(df[vec])).groupBy(F.size(vec).alias("n")).count()
           .orderBy(F.desc("count"), F.desc("n")).limit(1).collect())
    return row[0]["n"] if row else 0


def block(column: pa.Array, length: int) -> np.ndarray:
    """A column of equally long lists as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; dividing by the largest component first avoids overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
