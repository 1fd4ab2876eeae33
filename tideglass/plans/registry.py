"""Registers queries and their SQL by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> tuple[dict[str, Query], dict[str, str], Callable[[str | None], Callable[[Query], Query]]]:
    """queries, SQL, and a decorator that puts a function into both under its name."""
    queries: dict[str, Query] = {}
    oracle: dict[str, str] = {}

    def query(sql: str | None = None) -> Callable[[Query], Query]:
        def put(f: Query) -> Query:
            queries[f.__name__] = f
            if sql:
                oracle[f.__name__] = sql
            return f

        return put

    return queries, oracle, query
