"""Joins.

Physical choices made here, so they hold at cluster scale:

* Broadcast only behind a checked size: ``bounded_broadcast`` reads the
  optimizer's size estimate of the candidate, which for a scan comes from the
  files' bytes (no job runs), and only then adds the hint; above the bound,
  or where nothing is known, the join stays a shuffle join that adaptive
  execution converts or splits by measured bytes.
* Range joins on a date (history, map form) are never equi-joins on a few hot
  keys alone: both sides get a date bucket (width = window length) so the
  join key is (key, bucket) with the exact range kept as a residual filter.
  AQE's skew-join split handles any bucket that is still hot.
* "Exists" checks are left joins to a distinct key set or semi/anti joins,
  never per-row lookups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


BROADCAST_BYTES = 16 << 20


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` only if the optimizer puts it at ``max_bytes`` or less.
    Not for frames that multiply rows (``explode``), which the estimate misses."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= max_bytes else df


def match_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join two tables of matches on their match keys: both sides share the
    match partitioning, so no exchange is needed; the strategy is Spark's own,
    and a side that does not fit in memory spills."""
    return left.join(right, on, how)


def exists_flag(left: DataFrame, keys: DataFrame, on: list[str], name: str) -> DataFrame:
    """Left join to a *distinct* key set; ``name`` = 1 when a match exists."""
    k = keys.select(*on).distinct().withColumn(name, F.lit(1))
    return left.join(k, on, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)))


def semi(df: DataFrame, other: DataFrame, on, anti: bool = False) -> DataFrame:
    return df.join(other, on, "left_anti" if anti else "left_semi")


# ------------------------------------------------------------ range joins
def date_bucket(date_col: Column, width_days: int) -> Column:
    return F.floor(F.unix_date(date_col) / F.lit(width_days)).cast("bigint")
