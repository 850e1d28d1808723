"""Query registry: name -> (Spark builder, DuckDB oracle SQL or None).

Modules register their queries with ``@query(name, sql)``; the driver
contract in ``__spark_entry__.py`` reads the two dicts built here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from posetide.plans import (  # noqa: F401
        q_boxes, q_flags, q_heatmap, q_jobs, q_metrics, q_samples, q_suppress, q_track)
