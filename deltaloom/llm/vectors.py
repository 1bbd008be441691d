"""Vectors of a table: rows that can take part, and NumPy matrices of Arrow lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are numbers, neither null, NaN nor infinite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(vector.isNotNull() & sound, F.lit(False))


def one_row_per_id(rows: DataFrame, partitions: int) -> DataFrame:
    """The smallest row, by its other columns, of every id. Minima are taken before the shuffle, so a repeated row is no hot key.

    The number of partitions stays as asked: what follows is work per row, far more than the bytes that Spark sizes partitions by.
    """
    rest = [c for c in rows.columns if c != "id"]
    least = rows.repartition(partitions, "id").groupBy("id").agg(F.min(F.struct(*rest)).alias("r"))
    return least.select("id", "r.*")


def partitions_of(df: DataFrame) -> int:
    """Partitions for work that does not follow from bytes: the session's shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def matrix(lists: pa.Array, dims: int, dtype) -> np.ndarray:
    """Rows of an Arrow list column; vectors shorter than ``dims`` end in zeros."""
    out = np.zeros((len(lists), dims), dtype)
    lengths = np.asarray(lists.value_lengths())
    values = np.asarray(lists.flatten())
    if len(values) == out.size:
        return values.reshape(out.shape).astype(dtype)
    at = np.repeat(np.arange(len(lists)) * dims - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(len(values))
    out.reshape(-1)[at] = values
    return out
