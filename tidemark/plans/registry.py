"""Every registered query, and the DuckDB SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL for its rows where there is one."""

    def register(f: Query) -> Query:
        own = name or f.__name__
        _QUERIES[own] = f
        if sql is not None:
            _SQL[own] = sql
        return f

    return register


def _load() -> None:
    from tidemark.plans import aggregate_queries, session_queries, star_queries, timeseries_queries  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
