"""Stored tables: month partitions for appends, match buckets for joins.

``append_months`` writes one folder per month and checks a batch's keys only
against the months that the batch touches (a list that the calendar bounds), so
an append costs what its months hold and not the whole table.

``save_buckets`` writes a table in buckets of a key. Tables with the same
buckets are joined, grouped and windowed on that key without an exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skirmish.sources.io import table_exists

MONTH = "month"


def with_month(df: DataFrame, date: str) -> DataFrame:
    """``df`` with the first day of the month of ``date`` (null date: null)."""
    return df.withColumn(MONTH, F.trunc(F.col(date), "month"))


def unseen(batch: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``batch`` (with its month) whose key no stored row of the same
    month has. A key belongs to one month: dates of a key do not change."""
    months = [r[0] for r in batch.select(MONTH).distinct().collect()]
    same = F.col(MONTH).isin([m for m in months if m is not None])
    if None in months:
        same = same | F.col(MONTH).isNull()
    return batch.join(stored.where(same).select(*key), key, "left_anti")


def append_months(df: DataFrame, path: str, key: list[str], date: str) -> None:
    """Idempotent append of one row per ``key``, partitioned by the month of ``date``."""
    spark = df.sparkSession
    new = with_month(df, date).dropDuplicates(key)
    if table_exists(spark, path):
        new = unseen(new, read_months(spark, path), key)
    new.repartition(MONTH, *key).write.mode("append").partitionBy(MONTH).parquet(path)


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """The stored table with its month column."""
    return spark.read.parquet(path)


def save_buckets(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store ``df`` as the table ``name`` at ``path`` in sorted ``buckets`` of
    ``key`` (one file each) and give it back as read from there."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    (df.repartition(buckets, key).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return spark.table(name)
