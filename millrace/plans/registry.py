"""Queries by name, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..runtime import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its oracle SQL if there is any."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(tune(spark), sf_dir)
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add
