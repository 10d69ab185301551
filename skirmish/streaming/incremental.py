"""Incremental loading, set-based.

The reference crawls, queues and loads one match at a time. Here each step is
a join over whole tables:

* high mark   coalesce(max(queue.date), max(loaded.date), configured)
* frontier    listing rows on/after the mark, minus queued/loaded urls,
              unioned with the queue, one row per url (ledger Q19)
* skip loaded queue ⋉̸ loaded matches (anti join on id)
* new dims    referenced ids ⋉̸ dimension (anti join)
* TTL state   latest write per key (max_by with a total order), live when not
              a tombstone and not expired at ``now`` (ledger Q18)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.functions import rules as R


def high_mark(queue: DataFrame, loaded: DataFrame, configured: str) -> DataFrame:
    """One row: the load limit date (one aggregate over both inputs)."""
    nd = F.lit(None).cast("date")
    both = queue.select(F.col("date").alias("q"), nd.alias("m")).unionByName(
        loaded.select(nd.alias("q"), F.col("date").alias("m")))
    return both.agg(F.coalesce(F.max("q"), F.max("m"), F.lit(configured).cast("date")).alias("limit_date"))


def _where(df: DataFrame, value: Column | DataFrame, condition, name: str) -> DataFrame:
    """Rows of ``df`` that meet ``condition`` of a value, or of the column
    ``name`` of a frame of one row, which is joined."""
    if isinstance(value, DataFrame):
        return df.join(F.broadcast(value), condition(F.col(name)))
    return df.where(condition(value))


def frontier(listing: DataFrame, queue: DataFrame, loaded: DataFrame, limit: Column | DataFrame) -> DataFrame:
    """Listing rows dated on/after ``limit`` (a value, or a frame of one row
    with limit_date) that are neither queued nor loaded, plus the queue; one row
    per url (earliest date wins)."""
    fresh = _where(listing, limit, lambda x: F.col("date") >= x, "limit_date") \
        .join(queue.select("url"), "url", "left_anti") \
        .join(loaded.select("url"), "url", "left_anti")
    merged = queue.select("url", "date").unionByName(fresh.select("url", "date"))
    return merged.groupBy("url").agg(F.min("date").alias("date"))


def skip_loaded(queue: DataFrame, loaded_ids: DataFrame) -> DataFrame:
    q = queue.withColumn("id", R.url_id(F.col("url")))
    return q.join(loaded_ids.select("id"), "id", "left_anti")


def new_dims(refs: DataFrame, dim_ids: DataFrame, kind: str) -> DataFrame:
    return (refs.select(F.col("ref_id").alias("id")).filter(F.col("id").isNotNull()).distinct()
            .join(dim_ids.select("id"), "id", "left_anti").select(F.lit(kind).alias("kind"), "id"))


def ttl_latest(writes: DataFrame, now: Column | DataFrame) -> DataFrame:
    """Live values at ``now`` (a value, or a frame of one row with now). ``writes``: (key, value, written_at, expires_at (null = never), seq,
    is_delete). Latest write per key wins on value and expiry; a delete is
    a tombstone. Partial aggregation (max_by) keeps hot keys map-side."""
    order = F.struct(F.col("written_at"), F.col("seq"))
    last = writes.groupBy("key").agg(
        F.max_by(F.struct("value", "expires_at", "is_delete", "written_at"), order).alias("w"))
    return _where(last, now, lambda x: (~F.col("w.is_delete")) & (
        F.col("w.expires_at").isNull() | (F.col("w.expires_at") > x)), "now").select("key", F.col("w.value").alias("value"),
                                    F.col("w.written_at").alias("written_at"),
                                    F.col("w.expires_at").alias("expires_at"))


# TTL per event type for the events-as-cache-writes view (hours; None = never expires);
# 'error' events are deletes (tombstones).
EVENT_TTL_HOURS = {"view": 24, "click": 48, "signup": 168, "purchase": None}


def event_writes(events: DataFrame) -> DataFrame:
    et = F.col("event_type")
    exp = F.lit(None).cast("timestamp")
    for t, h in EVENT_TTL_HOURS.items():
        if h is not None:
            exp = F.when(et == t, F.col("ts") + F.make_dt_interval(hours=F.lit(h))).otherwise(exp)
    return events.select(
        F.concat(F.lit("user:"), F.col("user_id").cast("string")).alias("key"),
        F.col("props").alias("value"), F.col("ts").alias("written_at"), exp.alias("expires_at"),
        F.col("event_id").alias("seq"), (et == "error").alias("is_delete"))
