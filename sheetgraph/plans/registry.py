"""The register of named queries and of the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheetgraph.sources.derived import cte

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: bool = True) -> Callable[[Query], Query]:
    """Register a query; sql is DuckDB's, over the driver's tables and (with views) the derived sheets."""

    def put(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = cte(sql) if views else sql
        return f

    return put
