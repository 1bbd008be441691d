"""Relational sources and sinks over JDBC."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    """A table behind a JDBC url. Partitioned reads need a numeric or time column."""

    url: str
    table: str
    options: dict[str, str] = field(default_factory=dict)

    def bounds_query(self, column: str) -> str:
        return f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {self.table}) bounds"

    def rows_query(self, watermark: str | None, last: Any) -> str:
        if watermark is None or last is None:
            return self.table
        literal = str(last) if isinstance(last, (int, float)) else "'" + str(last).replace("'", "''") + "'"
        return f"(SELECT * FROM {self.table} WHERE {watermark} > {literal}) changed"


def read_table(
    spark: SparkSession,
    source: JdbcTable,
    partition_column: str | None = None,
    partitions: int = 8,
    watermark: str | None = None,
    last: Any = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Full or incremental load, split into parallel range reads.

    The bounds come from the database; without a partition column the table is
    read by one task, which only suits small tables.
    """
    reader = spark.read.format("jdbc").option("url", source.url).option("fetchsize", str(fetch_size))
    for name, value in source.options.items():
        reader = reader.option(name, value)
    if partition_column is None:
        return reader.option("dbtable", source.rows_query(watermark, last)).load()
    low, high = reader.option("dbtable", source.bounds_query(partition_column)).load().first()
    rows = reader.option("dbtable", source.rows_query(watermark, last))
    if low is None:
        return rows.load()
    return (
        rows.option("partitionColumn", partition_column)
        .option("lowerBound", str(low))
        .option("upperBound", str(high))
        .option("numPartitions", str(partitions))
        .load()
    )


def write_table(df: DataFrame, target: JdbcTable, mode: str = "append", batch_size: int = 10_000, connections: int = 32) -> None:
    """Append, or overwrite by truncating so that grants and indexes stay.

    At most ``connections`` tasks write at once, to bound the load on the database.
    """
    writer = (
        df.coalesce(connections)
        .write.format("jdbc")
        .option("url", target.url)
        .option("dbtable", target.table)
        .option("batchsize", str(batch_size))
        .option("truncate", "true")
    )
    for name, value in target.options.items():
        writer = writer.option(name, value)
    writer.mode(mode).save()
