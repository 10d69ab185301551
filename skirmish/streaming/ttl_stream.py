"""The key/value view as a stream: Spark's state store per key, with timers.

Writes arrive as events. A key's state is its latest write, by (written_at,
seq), so older and repeated writes change nothing; a delete leaves a tombstone,
which an older write cannot revive. Event time moves with the watermark: when
it passes a write's expiry, the key's timer drops its value. Every change comes
out as a row, and the table of latest changes is the view.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTPUT = "key string, value string, written_us long, expires_us long, seq long, live boolean, by string"
_STATE = "value string, written_us long, expires_us long, seq long, live boolean"
_NEVER = -1  # expires_us of a write without expiry


def _row(key: str, held: tuple, by: str) -> pd.DataFrame:
    value, written, expires, seq, live = held
    return pd.DataFrame([(key, value, written, None if expires == _NEVER else expires, seq, live, by)],
                        columns=[c.split()[0] for c in OUTPUT.split(", ")])


def _update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    held = tuple(state.get) if state.exists else None
    if state.hasTimedOut:
        value, written, expires, seq, live = held
        held = (None, written, expires, seq, False)
        state.update(held)
        yield _row(key[0], held, "expiry")
        return
    before = held
    for batch in batches:
        last = batch.sort_values(["written_us", "seq"]).iloc[-1]
        if held is None or (int(last.written_us), int(last.seq)) > (held[1], held[3]):
            delete = bool(last.is_delete)
            held = (None if delete or pd.isna(last.value) else str(last.value), int(last.written_us), int(last.expires_us), int(last.seq), not delete)
    if held == before:
        return
    # A write that had expired when it came in is known, but not live.
    passed = state.getCurrentWatermarkMs() * 1000
    if held[4] and held[2] != _NEVER and held[2] <= passed:
        held = (None, *held[1:4], False)
    state.update(held)
    if held[4] and held[2] != _NEVER:
        # A timer fires when the watermark is past it: the first millisecond at or after the expiry.
        state.setTimeoutTimestamp(max(-(-held[2] // 1000), state.getCurrentWatermarkMs() + 1))
    yield _row(key[0], held, "write")


def ttl_changes(writes: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """Changes of a stream of writes (key, value, written_at, expires_at, seq,
    is_delete): one row whenever a key gets a newer write, is deleted or
    expires. ``delay``: how late a write may come in event time; Spark drops
    those that are older than the watermark."""
    micros = writes.withWatermark("written_at", delay).select(
        "key", "value", "written_at", F.unix_micros("written_at").alias("written_us"),
        F.coalesce(F.unix_micros("expires_at"), F.lit(_NEVER)).alias("expires_us"), "seq", "is_delete")
    return micros.groupBy("key").applyInPandasWithState(_update, OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout)


def run_ttl_stream(spark: SparkSession, landing: str, schema, out: str, checkpoint: str, files_per_trigger: int | None = None) -> None:
    """Take in all writes that have landed, append their changes to ``out`` and stop."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    (ttl_changes(reader.parquet(landing)).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def latest_view(changes: DataFrame, now_us: int | None = None) -> DataFrame:
    """The live values after all changes: the latest write per key, an expiry
    after it; with ``now_us`` also without what has expired by then."""
    order = F.struct("written_us", "seq", (F.col("by") == "expiry").cast("int"))
    last = changes.groupBy("key").agg(F.max_by(F.struct("value", "written_us", "expires_us", "live"), order).alias("w")).select("key", "w.*")
    live = last.where("live").drop("live")
    return live if now_us is None else live.where(F.col("expires_us").isNull() | (F.col("expires_us") > now_us))
