"""Month partitions and match buckets: what is read, what is shuffled."""

from pyspark.sql import functions as F

from conftest import SF0001
from skirmish.plans import features as FT
from skirmish.session import scratch_dir
from skirmish.sources import storage as S
from skirmish.sources.fixtures import Domain


def test_appends_read_only_the_months_they_touch(spark):
    m = Domain(spark, SF0001).matches.select("id", "url", "date")
    path = scratch_dir(spark, "months")
    odd = spark.createDataFrame([(-1, "a", None), (-1, "a", None), (-2, "b", None)], "id long, url string, date date")
    for _ in range(2):  # the second time nothing is new
        S.append_months(m.unionByName(odd), path, ["id"], "date")
    stored = S.read_months(spark, path)
    assert stored.count() == m.count() + 2
    batch = S.with_month(m.where("date between '1995-03-10' and '1995-04-02'"), "date")
    assert batch.count() > 0 and S.unseen(batch, stored, ["id"]).count() == 0
    plan = S.unseen(batch, stored, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [month" in plan
    read = stored.where(F.col("month").isin([r[0] for r in batch.select("month").distinct().collect()]))
    assert len(read.inputFiles()) and read.select(F.input_file_name()).distinct().count() <= 2 * 16
    assert {r[0] for r in read.select(F.date_format("month", "yyyy-MM")).distinct().collect()} == {"1995-03", "1995-04"}


def test_bucketed_tables_join_without_an_exchange(spark):
    from skirmish.plans.q_sources import stored_buckets
    d = Domain(spark, SF0001, 4)
    tables = stored_buckets(d)
    got = FT.rounds_of_stored_matches(*tables)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Bucketed: true") == 3
    assert got.count() == d.round_stats.select("match_id").distinct().count()
