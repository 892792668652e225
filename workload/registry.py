"""Names, Spark queries and SQL twins, entered by decorator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Enter a query; without SQL only its rows are checked."""

    def enter(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are called {name}")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return enter
