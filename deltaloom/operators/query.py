"""Query shapes over tables: parameters, pages, result formats, catalog (Q01-Q12)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def run_sql(spark: SparkSession, text: str, args: list | dict | None = None, **tables: DataFrame) -> DataFrame:
    """Q01: SELECT with ``?`` or named parameters over the given frames."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args)


def top_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """Q04: first n rows in an order (planned as TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def count_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q05: row count per table, each counted by its own scan."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n_rows")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def union_devices(tables: Mapping[str, DataFrame], column: str = "device") -> DataFrame:
    """Q08: per-device tables of the replication layout as one relation."""
    tagged = [df.withColumn(column, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def catalog_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q09: table, column, type and position of the given tables."""
    rows = [
        (name, field.name, field.dataType.simpleString(), position)
        for name, df in tables.items()
        for position, field in enumerate(df.schema.fields, 1)
    ]
    return spark.createDataFrame(
        rows, "table_name string, column_name string, data_type string, ordinal_position int"
    )


def saved_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Q09 for tables saved in the catalog."""
    return spark.sql(f"SHOW TABLES{' IN ' + database if database else ''}")


def rows_as_json(df: DataFrame, *keep: str) -> DataFrame:
    """Q10, Q12: one JSON object per row."""
    return df.select(*keep, F.to_json(F.struct("*")).alias("row_json"))


def rows_as_arrays(df: DataFrame, *keep: str) -> DataFrame:
    """Q12: value arrays, for callers that hold the column list already."""
    return df.select(*keep, F.array(*[F.col(c).cast("string") for c in df.columns]).alias("row_values"))


def column_metadata(df: DataFrame) -> list[dict[str, str]]:
    """Q12: label and type per result column."""
    return [{"label": f.name, "type": f.dataType.simpleString().upper()} for f in df.schema.fields]


def page(df: DataFrame, key: str, size: int, after: Any = None) -> DataFrame:
    """Q11: next page by key. The key predicate reaches the scan, so late pages
    cost no more than early ones. ``has_more`` tells whether a page follows.
    The windows see at most ``size + 1`` rows."""
    rest = df if after is None else df.where(F.col(key) > F.lit(after))
    ahead = rest.orderBy(key).limit(size + 1)
    return (
        ahead.withColumn("_nr", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(key)))
        .withColumn("has_more", F.max("_nr").over(Window.partitionBy(F.lit(0))) > size)
        .where(F.col("_nr") <= size)
        .drop("_nr")
    )


def page_by_offset(df: DataFrame, order: Iterable[str], size: int, number: int) -> DataFrame:
    """Q11, simple form: page ``number`` from 0."""
    return df.orderBy(*order).offset(size * number).limit(size)


def totals_by_device(table: DataFrame, value: str) -> DataFrame:
    """Q07: per-device and overall totals of a consolidated table."""
    return table.rollup("sys_device_name").agg(F.count("*").alias("n_rows"), F.sum(value).alias("total"))
