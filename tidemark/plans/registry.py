"""Registry of named queries: each has a Spark builder ``(spark, sf_dir) -> DataFrame``
and, when the result is expressible in SQL, a DuckDB oracle over the fixture views."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .oracle_views import with_views


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn`` under ``key``; ``sql`` is the oracle (fixture views are added)."""
    def deco(fn):
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Query(key, fn, with_views(sql) if sql else None)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    from . import queries_claims, queries_kpi, queries_lineage  # noqa: F401  (registration side effects)
    return REGISTRY
