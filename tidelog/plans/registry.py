"""Named queries with the SQL that another engine checks them by."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name; ``sql`` gives the same rows on the same tables."""

    def add(function: Query) -> Query:
        assert name not in QUERIES, name
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = sql
        return function

    return add
