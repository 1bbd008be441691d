"""Queries of this subpackage and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
sql: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(query):
        queries[name] = query
        if oracle is not None:
            sql[name] = oracle
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
