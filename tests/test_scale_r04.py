"""Steps that grow with what equal ranges share and not with the rows of the windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from skirmish.sources.fixtures import Domain


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    orders = [(k, k % 4, dt.datetime(2020, 1, 1) + dt.timedelta(days=10 * (k % 9)), "2-HIGH") for k in range(1, 73)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string") \
        .write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(n, f"n{n}", n % 3) for n in range(25)], "n_nationkey long, n_name string, n_regionkey long") \
        .write.parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(k, f"c{k}", "a", k % 25, "p", 100.0 * k, "BUILDING", "x") for k in range(4)],
                          "c_custkey long, c_name string, c_address string, c_nationkey long, c_phone string, "
                          "c_acctbal double, c_mktsegment string, c_comment string").write.parquet(f"{path}/customer.parquet")
    return str(path)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_bundles_open_to_their_rows(spark):
    from skirmish.operators.ranges import BUNDLE, bundled, expanded, opened
    rows = [("k", 0, 3, "a", i % 600) for i in range(2 * BUNDLE + 100)] + [("k", 1, 2, None, None)] * 2 + [("k", 5, 5, "b", 1)]
    ranged = spark.createDataFrame(rows, "k string, lo long, hi long, name string, n long")
    events = spark.createDataFrame([("k", s, s * 10) for s in (1, 2, 2, 3, 4)], "k string, seq long, x long")
    bundles = bundled(ranged, ["k", "lo", "hi"])
    assert sorted(len(r["_rows"]) for r in bundles.collect()) == [1, 2, 100, BUNDLE, BUNDLE]
    names = ["k", "name", "n", "seq", "x"]
    got = opened(expanded(bundles, events, ["k"])).select(*names).collect()
    want = expanded(ranged, events, ["k"]).select(*names).collect()
    assert len(want) == 4 * (2 * BUNDLE + 100) + 2 * 2 and sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("name", ["join_history", "join_history_rows", "feat_append_maps", "feat_append_maps_long",
                                  "feat_dataset", "feat_dataset_long", "snk_json"])
def test_targets_of_a_team_and_day_share_their_history(spark, tables, name):
    """The lists of targets are opened last: texts and forms are made below that, once per team, day and match."""
    plan = optimized(E.queries()[name](spark, tables))
    above, below = plan.split("Generate inline(_rows", 1)
    assert "Join" not in above and "array_join" not in above and "form_date#" in below or name.startswith("join_history")
    assert "as string" not in above.split("Union")[-1] and "Join Inner" in below


@pytest.mark.parametrize("name", ["feat_map_form", "join_map_form"])
def test_a_form_date_becomes_text_once_per_range(spark, tables, name):
    above, below = optimized(E.queries()[name](spark, tables)).split("Join Inner", 1)
    assert "as string" not in above and "as string" in below


def test_histories_of_named_targets_leave_the_maps_where_they_are(spark, tables):
    from skirmish.plans import features as FT
    d = Domain(spark, tables)
    plan = optimized(FT.training_histories(d, FT.latest_targets(d)))
    # The joins with the maps and the forms lie above the one in blocks, so the maps are not shuffled for it.
    assert plan.split("RepartitionByExpression", 1)[0].count("Join LeftOuter") == 2
    played = FT.training_histories(d, FT.latest_targets(d)).select("team_id", "history_id", F.size("maps").alias("n")).collect()
    maps = {}
    for r in d.match_maps.collect():
        maps[r["match_id"]] = maps.get(r["match_id"], 0) + 1
    assert played and all(r["n"] == maps[r["history_id"]] for r in played)


def test_rounds_of_an_ingest_run_are_not_saved_and_shuffled(spark, tables):
    from skirmish.plans.batch import JOBS
    d = Domain(spark, tables)
    out = JOBS["round_stats"](d)
    for df in out.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "hashpartitioning(o_orderkey" in plan and "ExistingRDD" not in plan
    clean, bad = out["round_stats"], out["round_quarantine"]
    rejected = {(r["match_id"], r["map_id"]) for r in bad.collect()}
    assert rejected and not rejected & {(r["match_id"], r["map_id"]) for r in clean.collect()}
    assert clean.count() + bad.count() == d.raw_rounds.count() and clean.columns == bad.columns
