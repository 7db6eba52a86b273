"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str):
    """Register a function ``(spark, folder) -> DataFrame`` with its DuckDB SQL."""

    def register(function):
        QUERIES[name] = function
        ORACLES[name] = sql
        return function

    return register
