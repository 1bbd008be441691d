"""Registered queries and the SQL each is checked against, by topic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries of one topic. The SQL states the expected end state directly."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def register(function: Query) -> Query:
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return register
