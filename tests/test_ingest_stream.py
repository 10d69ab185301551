"""The streaming ingest against one batch, through a crash and replays; the violations store."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from skirmish.plans.batch import ingest_batch
from skirmish.session import scratch_dir
from skirmish.sources.fixtures import Domain
from skirmish.streaming.ingest_stream import committed, domain_of, run_ingest_stream
from skirmish.streaming.land import land_files


def bag(df):
    cols = sorted(df.columns)
    return sorted(map(repr, df.select(*cols).collect()))


def test_crash_between_two_tables_and_replay(spark):
    d = Domain(spark, SF0001)
    orders = d.t.orders
    landing, out, ckpt = (scratch_dir(spark, n) for n in ("landing", "out", "ckpt"))
    first = F.col("o_orderkey") % 3 == 0
    land_files(orders.where(first), landing, 1)
    run = dict(schema=orders.schema, out=out, checkpoint=ckpt, domain=domain_of(spark, SF0001), key="o_orderkey", files_per_trigger=1)
    run_ingest_stream(spark, landing, **run)
    before = committed(spark, out, "matches").count()
    assert before == orders.where(first).count()
    land_files(orders.where(~first), landing, 1)
    land_files(orders.where(first), landing, 1)  # delivered again
    crashed = []

    def fail(table):
        if table == "round_stats" and not crashed:
            crashed.append(table)
            raise RuntimeError("killed between two tables")

    with pytest.raises(Exception, match="killed between two tables"):
        run_ingest_stream(spark, landing, **run, after_table=fail)
    # Two tables of the epoch are written, none of it is visible.
    assert committed(spark, out, "matches").count() == before
    assert spark.read.parquet(f"{out}/matches").count() > before
    run_ingest_stream(spark, landing, **run)
    run_ingest_stream(spark, landing, **run)  # nothing new
    paths = ingest_batch(Domain(spark, SF0001), scratch_dir(spark, "batch"))
    for table, path in paths.items():
        want = spark.read.parquet(path)
        assert bag(committed(spark, out, table)) == bag(want), table
    assert committed(spark, out, "duels_rejected").count() > 0


def test_clean_and_rejected_rows_are_the_input(spark):
    from skirmish.plans import ingest as I
    from skirmish.sources import raw_views as RV
    d = Domain(spark, SF0001)
    n = {r["job"]: r["n"] for r in I.rejects(d).groupBy("job").agg(F.count("*").alias("n")).collect()}
    assert set(n) == {"rounds", "player_stats", "duels", "highlights"}
    assert I.job_rounds(d)[0].count() + n["rounds"] == d.raw_rounds.count()
    assert I.job_player_stats(d)[0].count() // 2 + n["player_stats"] == d.raw_player_stats.count()
    assert I.job_duels(d).count() + n["duels"] == I.join_duel_grid(d).count()
    kept = I.job_highlights(d).select("match_id", "map_id").distinct()
    cells = RV.raw_highlight_cells(d)
    assert cells.join(kept, ["match_id", "map_id"], "left_semi").count() + n["highlights"] == cells.count()
    # What fails is named, with its text.
    bank = I.rejects(d).where("job = 'rounds' and failed <> ''").first()
    assert bank["failed"] == "team_1_bank" and "n/a" in bank["raw"]
