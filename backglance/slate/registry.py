"""Names, functions and reference SQL of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register the function under its own name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register
