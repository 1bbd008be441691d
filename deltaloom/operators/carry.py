"""Last known value carried along an ordered log, without one task per log.

A plain ``last(..., ignorenulls)`` window puts a whole group into one task. Here
the log is cut into bounded chunks by sequence number: a window fills each
chunk, one row per chunk is carried across chunk borders, and the carried value
is joined back. A group that holds a third of all rows is spread over its
chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deltaloom.functions.columns import join_same
from deltaloom.model import order_of

CHUNK_ROWS = 100_000


def carry_forward(
    log: DataFrame,
    group: list[str],
    value: Column,
    name: str,
    inclusive: bool,
    chunk_rows: int = CHUNK_ROWS,
    transactions: bool = False,
) -> DataFrame:
    """Add ``name``: last non-null ``value`` at or before (or strictly before) each row.

    Chunks are blocks of ``_seq``. Set ``transactions`` for logs whose published
    transactions were expanded: there one ``_seq`` holds a whole transaction, so
    every ``_seq`` is cut into blocks of ``_txn_seq``.
    """
    chunk = ["_segment", "_chunk", "_block"]
    group = [c for c in group if c != "_segment"]
    end = Window.currentRow if inclusive else -1

    def block(column: str) -> Column:
        return F.floor(F.col(column) / F.lit(chunk_rows)).cast("bigint")

    prepared = log.withColumns(
        {
            "_value": value,
            "_chunk": F.col("_seq") if transactions else block("_seq"),
            "_block": block("_txn_seq") if transactions else F.lit(0).cast("bigint"),
        }
    )
    inside = Window.partitionBy(*group, *chunk).orderBy("_seq", "_txn_seq")
    filled = prepared.withColumn(
        "_near", F.last("_value", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, end))
    )
    ends = prepared.groupBy(*group, *chunk).agg(
        F.max_by("_value", F.when(F.col("_value").isNotNull(), order_of())).alias("_end")
    )
    across = Window.partitionBy(*group).orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*group, *chunk, F.last("_end", ignorenulls=True).over(across).alias("_far"))
    return (
        join_same(filled, carried, [*group, *chunk])
        .withColumn(name, F.coalesce("_near", "_far"))
        .drop("_value", "_near", "_far", "_chunk", "_block")
    )


def sum_forward(log: DataFrame, group: list[str], value: Column, name: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the group up to each row, in the order of ``_seq``, in two levels like above."""
    prepared = log.withColumns({"_value": value, "_chunk": F.floor(F.col("_seq") / F.lit(chunk_rows)).cast("bigint")})
    inside = Window.partitionBy(*group, "_chunk").orderBy("_seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = prepared.groupBy(*group, "_chunk").agg(F.sum("_value").alias("_end"))
    carried = sums.select(*group, "_chunk", F.coalesce(F.sum("_end").over(across), F.lit(0)).alias("_far"))
    filled = prepared.withColumn("_near", F.sum("_value").over(inside))
    return join_same(filled, carried, [*group, "_chunk"]).withColumn(name, F.col("_near") + F.col("_far")).drop("_value", "_near", "_far", "_chunk")


def fill_statements(log: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A batched row without text repeats the statement before it in its segment.

    The segment stays part of the group, so a statement never leaks into the
    next segment.
    """
    chunked = log.withColumn("_file", F.col("_segment"))
    group = ["_device_id", "_device_name", "_file"]
    text = F.when(F.length("sql") > 0, F.col("sql"))
    filled = carry_forward(chunked, group, text, "_statement", inclusive=True, chunk_rows=chunk_rows)
    return filled.withColumn("sql", F.col("_statement")).select(*log.columns)
