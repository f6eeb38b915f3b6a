"""Queries of this subpackage: name -> builder, and the SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def wrap(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE_SQL[key] = sql.strip()
        return fn
    return wrap


def load_all() -> None:
    """Import the modules that register queries."""
    from kestrel.llm import queries, queries_runs, queries_vectors, queries_lexical  # noqa: F401
