"""Query registry: one entry per SURVEY §2 id.

``@query(name, sql=...)`` registers a builder ``fn(spark, sf_dir) -> DataFrame``
and, when given, its DuckDB oracle SQL (g_* views are prepended as CTEs).
Builders only declare plans; nothing here collects to the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skirmish.sources.fixture_sql import with_views
from skirmish.sources.fixtures import Domain

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, ctes: str = ""):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query id {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql, ctes)
        return fn
    return deco


def dom(spark: SparkSession, sf_dir: str) -> Domain:
    return Domain(spark, sf_dir)
