"""Registry of named queries and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Decorator: add ``fn(spark, sf_dir)`` under ``key`` with optional oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise KeyError(f"duplicate query id {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every plan module so that their ``register`` calls run."""
    import importlib
    for m in PLAN_MODULES:
        importlib.import_module(f"kestrel.plans.{m}")


PLAN_MODULES = ["q_ticks", "q_profile", "q_relational", "q_panel", "q_macro", "q_txn", "q_metrics", "q_text", "q_models", "q_io", "q_streaming"]
