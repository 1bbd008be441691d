"""Row numbers inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deltaloom.functions.columns import join_same
from deltaloom.storage import cut_lineage


def number_rows(df: DataFrame, group: list[str], order: list[Column | str], name: str) -> DataFrame:
    """Add ``name`` = 1, 2, ... within ``group`` in ``order`` (which must be unique per group).

    A ``row_number`` window would sort a whole group in one task. Rows are range
    partitioned by (group, order) instead, numbered per partition, and shifted
    by the number of rows the group has in earlier partitions. Partition numbers
    are written out first, so a lost executor cannot change them.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = cut_lineage(
        df.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id())
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        placed.groupBy(*group, "_part")
        .agg(F.count("*").alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*group, "_part").orderBy(*order)
    return (
        join_same(placed.withColumn("_nr", F.row_number().over(inside)), shift, [*group, "_part"])
        .withColumn(name, F.col("_nr").cast("bigint") + F.col("_shift"))
        .drop("_nr", "_shift", "_part")
    )
