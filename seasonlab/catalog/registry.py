"""Names of queries, their functions and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from seasonlab.catalog.views import with_views

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *views: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name (or ``name``); ``views`` are put before the SQL."""

    def register(fn: Query) -> Query:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_views(sql, *views)
        return fn

    return register
