"""Collecting an area's queries and their SQL checks."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def collector() -> tuple[Callable, dict[str, Query], dict[str, str]]:
    """A decorator ``query(name, sql)`` and the two dictionaries it fills."""
    queries: dict[str, Query] = {}
    oracles: dict[str, str] = {}

    def query(name: str, sql: str | None = None):
        def register(function: Query) -> Query:
            queries[name] = function
            if sql is not None:
                oracles[name] = sql
            return function

        return register

    return query, queries, oracles
