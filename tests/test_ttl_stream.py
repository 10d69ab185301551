"""The key/value stream against the batch view at three points in time."""

from pyspark.sql import functions as F

from conftest import SF0001
from skirmish.session import scratch_dir
from skirmish.sources.fixtures import Domain
from skirmish.streaming import incremental as INC
from skirmish.streaming.ttl_stream import latest_view, run_ttl_stream


def test_stream_equals_batch_at_three_points(spark):
    events = Domain(spark, SF0001).t.events
    writes = INC.event_writes(events).withColumn("key", F.concat("key", F.lit(":"), F.col("seq") % 20))  # keys that are written seldom
    writes = writes.withColumn("written_at", F.col("written_at").cast("timestamp")) \
        .withColumn("expires_at", F.col("expires_at").cast("timestamp"))
    lo, hi = writes.agg(F.min("written_at"), F.max("written_at")).first()
    cuts = [lo + (hi - lo) * k / 3 for k in (1, 2, 3)]
    landing, out, ckpt = (scratch_dir(spark, n) for n in ("ttl-landing", "ttl-out", "ttl-ckpt"))
    expired = 0
    for i, cut in enumerate(cuts):
        part = writes.where(F.col("written_at") <= F.lit(cut))
        if i:
            part = part.where(F.col("written_at") > F.lit(cuts[i - 1])).unionByName(writes.where(F.col("written_at") <= F.lit(cuts[0])).limit(20))
        part.coalesce(1).write.mode("append").parquet(landing)  # some older writes come again
        run_ttl_stream(spark, landing, writes.schema, out, ckpt)
        seen = writes.where(F.col("written_at") <= F.lit(cut))
        now = seen.agg(F.max("written_at").alias("now"))
        want = INC.ttl_latest(columns_of(seen), now).select("key", "value", F.unix_micros("written_at").alias("written_us"),
                                                            F.unix_micros("expires_at").alias("expires_us"))
        now_us = now.select(F.unix_micros("now")).first()[0]
        changes = spark.read.parquet(out)
        got = latest_view(changes, now_us).select(want.columns)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and want.count() > 0
        expired = changes.where("by = 'expiry'").count()
    assert expired > 0  # timers have fired


def columns_of(df):
    return df.select("key", "value", "written_at", "expires_at", "seq", "is_delete")
