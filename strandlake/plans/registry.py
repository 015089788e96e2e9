"""Registered queries: a name, a function of (spark, sf_dir), and SQL for DuckDB where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under ``name`` with the SQL that gives the same rows."""
    def keep(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return keep
