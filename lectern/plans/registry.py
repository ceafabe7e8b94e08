"""Query registry: key -> Spark callable, key -> DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Register a query; ``sql`` is the DuckDB oracle (None = rows-only check)."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every query module so their registrations run."""
    from lectern.plans import (  # noqa: F401
        q_ingest, q_clean, q_splits, q_profile, q_eval, q_errors, q_encode, q_model,
        q_history, q_io,
    )
