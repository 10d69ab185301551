"""The windows of all targets, joined in blocks, against plain Python on small own tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from skirmish.sources.fixtures import Domain


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    orders = [(k, k % 5, dt.datetime(2020, 1, 1) + dt.timedelta(days=(k * 37) % 400), "2-HIGH") for k in range(1, 61)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string") \
        .write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(n, f"n{n}", n % 3) for n in range(25)], "n_nationkey long, n_name string, n_regionkey long") \
        .write.parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(k, f"c{k}", "a", k % 25, "p", 100.0 * k, "BUILDING", "x") for k in range(5)],
                          "c_custkey long, c_name string, c_address string, c_nationkey long, c_phone string, "
                          "c_acctbal double, c_mktsegment string, c_comment string").write.parquet(f"{path}/customer.parquet")
    return str(path)


def windows(matches):
    """(target, side, history match) of all targets."""
    out = []
    for t in matches:
        for side in (1, 2):
            team = t[f"team_{side}_id"]
            for h in matches:
                if team in (h["team_1_id"], h["team_2_id"]) and t["date"] - dt.timedelta(days=180) <= h["date"] < t["date"]:
                    out.append((t["id"], side, h["id"], team))
    return out


def test_every_target_is_joined_to_its_window(spark, tables):
    d = Domain(spark, tables)
    matches, maps = d.matches.collect(), d.match_maps.collect()
    want = windows(matches)
    got = [(r["target_id"], r["side"], r["history_id"]) for r in E.queries()["join_history"](spark, tables).collect()]
    assert len(want) > 100 and sorted(got) == sorted(w[:3] for w in want)
    date_of = {m["id"]: m["date"] for m in matches}
    keys = {(date_of[m["match_id"]], m["map_id"]) for m in maps}
    league = sorted((str(at), k, m["match_id"]) for at, k in keys for m in maps
                    if m["map_id"] == k and at - dt.timedelta(days=180) <= date_of[m["match_id"]] < at)
    form = E.queries()["join_map_form"](spark, tables).collect()
    assert sorted((r["form_date"], r["map_id"], r["form_match_id"]) for r in form) == league


def test_maps_of_every_target_with_features_and_forms(spark, tables):
    d = Domain(spark, tables)
    matches, maps = d.matches.collect(), d.match_maps.collect()
    date_of = {m["id"]: m["date"] for m in matches}
    want = sorted((t, s, h, m["map_id"], m["duration"],
                   sum(x["map_id"] == m["map_id"] and date_of[x["match_id"]] < date_of[t] - dt.timedelta(days=180) for x in maps),
                   sum(x["map_id"] == m["map_id"] and date_of[x["match_id"]] < date_of[t] for x in maps))
                  for t, s, h, _ in windows(matches) for m in maps if m["match_id"] == h)
    want = [tuple(-1 if x is None else x for x in w) for w in want] if any(None in w for w in want) else want
    rows = E.queries()["feat_append_maps"](spark, tables).fillna(-1, subset=["duration"]).collect()
    got = [(r["target_id"], r["side"], r["history_id"], r["map_id"], r["duration"], r["form_lo"], r["form_hi"]) for r in rows]
    assert sorted(got) == sorted(want)
    doc = E.queries()["feat_dataset"](spark, tables).collect()
    assert len(doc) == len(windows(matches))
    assert sorted((r["target_id"], r["side"], r["history_id"], int(m.split("|")[0]), int(m.split("|")[7] or -1),
                   *map(int, m.split("|")[-2:])) for r in doc for m in r["maps"].split(";")) == sorted(want)


def test_a_range_spans_blocks_and_a_number_may_have_rows(spark):
    from skirmish.operators.ranges import expanded
    events = spark.range(1, 41).select(F.lit("k").alias("k"), F.col("id").alias("seq"), F.explode(F.sequence(F.lit(0), F.col("id") % 3)).alias("x"))
    ranged = spark.createDataFrame([("k", 0, 40, "a"), ("k", 6, 7, "b"), ("k", 7, 14, "c"), ("k", 9, 9, "d"), (None, 0, 3, "e")],
                                   "k string, lo long, hi long, name string")
    got = sorted((r["name"], r["seq"], r["x"]) for r in expanded(ranged, events, ["k"], block=7).collect())
    spans = {"a": (0, 40), "b": (6, 7), "c": (7, 14)}
    assert got == sorted((n, s, x) for n, (lo, hi) in spans.items() for s in range(lo + 1, hi + 1) for x in range(s % 3 + 1))
    # The rows of the windows leave the join; none is shuffled after it.
    plan = expanded(ranged, events, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("Exchange")


def test_duel_grid_names_both_players(spark, tables):
    df = E.queries()["join_duel_grid"](spark, tables)
    assert {"row_name", "col_name"} <= set(df.columns) and df.where("row_name IS NULL OR col_name IS NULL").isEmpty()


def test_document_of_the_last_day_from_what_its_targets_share(spark, tables):
    from skirmish.operators.ranges import expanded
    from skirmish.plans import features as FT
    d = Domain(spark, tables)
    named = FT.latest_targets(d)
    doc = FT.training_document(d, named)
    joined = expanded(FT.training_sides(d, named), FT.training_histories(d, named), ["team_id", "form_date"]).select(*FT.DOCUMENT)
    assert sorted(map(str, joined.collect())) == sorted(map(str, doc.collect())) != []
    keys = doc.select("form_date", F.explode("maps.map_id").alias("map_id")).distinct()
    assert sorted(map(str, FT.reached_forms(d, named).collect())) == sorted(map(str, keys.collect()))
