"""Registry of named queries: a Spark builder plus (optionally) its DuckDB oracle.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the driver tables. The oracle
text is ANSI-ish SQL for DuckDB; ``None`` means "rows-only check" (K-means,
streaming, file-based operators are checked by unit tests instead).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from encore.plans.oracle_views import with_views
from encore.session import ensure_session


@dataclass
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    doc: str = ""


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    """Register ``fn`` under ``name``; ``sql`` is wrapped with the fixture views it uses."""
    def deco(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_session(spark)
            return fn(spark, sf_dir)
        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, build, with_views(sql, ctes) if sql else None, (fn.__doc__ or "").strip())
        return fn
    return deco


def load_all() -> dict[str, Query]:
    """Import every module that registers queries."""
    from encore.plans import (queries_catalog, queries_clean, queries_daily, queries_dashboard,  # noqa: F401
                              queries_ingest, queries_insights, queries_profiles, queries_sql)
    return REGISTRY
