"""All queries of the engine's own operators, by name, with DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    """Register a query function, with the SQL that gives the same rows."""

    def keep(f):
        _QUERIES[name] = (f, sql)
        return f

    return keep


def _load() -> None:
    from quern.plans import dataset, evaluation, pictures, storage  # noqa: F401  they register themselves


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {name: f for name, (f, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
