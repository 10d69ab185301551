"""Aggregations that are not part of one feature job.

All are single ``groupBy`` passes with partial (map-side) aggregation; none
collects a group whose size is not bounded by the game (players per team,
maps per match).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedupe_first(df: DataFrame, keys: list[str], order_col: str) -> DataFrame:
    """First row per ``keys`` with a deterministic tie-break: the row with the
    smallest ``order_col`` (ledger Q6). One aggregate, no sort."""
    others = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(F.col(order_col), *[F.col(c) for c in others if c != order_col])).alias("_b")
    g = df.groupBy(*keys).agg(best)
    return g.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in others])


def is_empty(df: DataFrame, name: str) -> DataFrame:
    """One row: (table, n_rows, is_empty)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", (F.col("n_rows") == 0).cast("int").alias("is_empty"))


def max_date(df: DataFrame, col: str = "date") -> Column:
    return F.max(F.col(col))


def cardinality_violations(df: DataFrame, keys: list[str], expected: int) -> DataFrame:
    """Groups whose row count differs from ``expected``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") != expected)


def error_summary(violations: DataFrame, key: str = "rule", seq: str = "seq",
                  message: str = "detail") -> DataFrame:
    """Failure count and the last error (highest ``seq``) per rule."""
    return violations.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_failures"),
        F.max_by(F.col(message), F.col(seq)).alias("last_error"))


def sorted_list_text(col: str) -> Column:
    """sort_array(collect_list(col)) rendered as ','-joined text."""
    return F.array_join(F.sort_array(F.collect_list(F.col(col).cast("string"))), ",")
