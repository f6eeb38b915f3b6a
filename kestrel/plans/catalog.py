"""Registry of named queries: a Spark builder and, where SQL can express it, the
equivalent SQL over the same tables for an independent check.

Every query reads the full driver tables (no row caps, id subsets or prefixes); a
limit appears only where the operator itself is a top-k or a sample.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE_SQL[key] = sql.strip()
        return fn
    return wrap


def load_all() -> None:
    """Import the modules that register queries."""
    from kestrel.plans import (  # noqa: F401
        q_relational, q_sources, q_text, q_sampling, q_evaluation, q_models, jobs)
