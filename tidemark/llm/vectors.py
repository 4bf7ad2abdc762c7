"""Helpers for operators on embedding tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored


def usable(vector: str) -> Column:
    """A vector that is not null and has finite components only, at least one."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & ok, F.lit(False))


def numbered(df: DataFrame, name: str, number: str) -> DataFrame:
    """The frame stored with a number per row that stays what it is once written."""
    return stored(df.withColumn(number, F.monotonically_increasing_id()), name)


def blocked(df: DataFrame, number: str, block: Column | int, per_block: int) -> DataFrame:
    """A ``block`` column that deals rows out evenly, about ``per_block`` to a block.

    ``block`` is how many rows there are to deal out (of the row's own group, if a column).
    """
    n = F.greatest(F.lit(1), F.ceil((block if isinstance(block, Column) else F.lit(block)) / per_block)).cast("int")
    return df.withColumn("n_blocks", n).withColumn("block", F.pmod(F.xxhash64(number), F.col("n_blocks")).cast("int"))


def matrix(column: pa.ChunkedArray | pa.Array, width: int, kind: str) -> np.ndarray:
    """A list column as a matrix; shorter rows end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), width), kind)
    if len(values):
        row = np.repeat(np.arange(len(lengths)), lengths)
        out[row, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of n nodes over the links (x, y)."""
    root = np.arange(n)
    while True:
        was = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        np.minimum.at(root, was[x], low)
        np.minimum.at(root, was[y], low)
        root = root[root]
        if (root == was).all():
            return root
