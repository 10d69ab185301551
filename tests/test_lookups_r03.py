"""Names, clutches and rules are looked up where the rows lie: the same rows, fewer joins and sorts."""

from pyspark.sql import functions as F

from conftest import SF0001
from skirmish.operators import quality as Q
from skirmish.plans import features as FT
from skirmish.plans import ingest as I
from skirmish.sources.fixtures import Domain


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _domain(spark, copies):
    """A few matches, each ``copies`` times, and one without a team."""
    d = Domain(spark, SF0001)
    few = d.t.orders.orderBy("o_orderkey").limit(30)
    orders = few.withColumn("_n", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_n")
    d.t.put("orders", orders.unionByName(few.limit(1).withColumns(
        {"o_orderkey": F.lit(1_000_001).cast("bigint"), "o_custkey": F.lit(None).cast("bigint")})).localCheckpoint())
    return d


def test_highlights_make_the_roster_once(spark):
    assert _plan(I.job_highlights(_domain(spark, 1))).count("max_by(") == 1


def test_highlights_give_back_the_stored_rows_of_sound_maps(spark):
    d = _domain(spark, 1)
    lost = d.player_highlights.where("match_id % 89 = 0 AND round_no = 3").select("match_id", "map_id").distinct()
    stored = d.player_highlights.where("player_id IS NOT NULL").join(lost, ["match_id", "map_id"], "left_anti")
    got = I.job_highlights(d)
    assert got.count() > 0
    assert got.exceptAll(stored.select(*got.columns)).isEmpty() and stored.select(*got.columns).exceptAll(got).isEmpty()


def test_duel_grid_makes_the_roster_once(spark):
    assert _plan(I.join_duel_grid(_domain(spark, 1))).count("max_by(") == 1


def test_duel_grid_keeps_every_meeting_of_repeated_headers(spark):
    """A match that is there twice has its cells twice and each header four times."""
    once, twice = (I.join_duel_grid(_domain(spark, n)).where("match_id <> 1000001") for n in (1, 2))
    assert once.count() > 0 and twice.count() == 32 * once.count()
    assert twice.distinct().exceptAll(once).isEmpty() and once.where("team_1_player_id IS NULL AND row_name <> 'sub'").isEmpty()


def test_odd_duel_cells_are_read_by_the_rule(spark, monkeypatch):
    cells = {0: "3 4", 1: " 3  4 ", 2: "", 3: "-2 k7", 4: "007 5%"}
    grid = spark.createDataFrame([(1, 1, i, 0, c, c, c, 10 + i, 20) for i, c in cells.items()],
                                 "match_id long, map_id long, i long, j long, kills_txt string, first_kills_txt string, "
                                 "op_kills_txt string, team_1_player_id long, team_2_player_id long")
    grid = grid.withColumns({"row_name": F.lit("a"), "col_name": F.lit("b")})
    monkeypatch.setattr(I, "join_duel_grid", lambda d: grid)
    got = {r.team_1_player_id - 10: (r[4], r[5]) for r in I.split_duels(None)[0].collect()}
    assert got == {0: (3, 4), 1: (3, 4), 2: (0, 0), 3: (-2, 7), 4: (7, 5)}


def test_rules_drop_sound_rows_before_names_are_made(spark):
    rows = [(1, 7, 2, "full_buy"), (2, 7, 0, "full_buy"), (3, None, 1, "other"), (4, 7, 1, None)]
    df = spark.createDataFrame(rows, "match_id long, map_id long, round_no int, team_1_buy_type string")
    found = Q.declared_violations(df, "round_stats", ["match_id"])
    rules = {(name, r[0]) for name, c, _, _ in Q.rules_of("round_stats", df.columns)
             for r in rows if (name.endswith("not null") and r[df.columns.index(c)] is None)
             or (name == "team_1_buy_type enum" and r[0] == 3) or (name.startswith("round_no >=") and r[0] == 2)}
    assert {(r.rule, r.match_id) for r in found.collect()} == rules and len(rules) >= 3
    generate, scan = _plan(found).split("Generate", 1)[1], "LogicalRDD"
    assert generate.index("Filter") < generate.index(scan)


def test_clutches_are_made_distinct_before_they_are_listed(spark):
    plan = _plan(FT.feat_rounds(_domain(spark, 1)))
    assert "collect_set" not in plan and plan.count("Aggregate") == 2


def test_clutch_flags_of_repeated_matches_and_null_teams(spark):
    d = _domain(spark, 2)
    pairs = {tuple(r) for r in d.player_highlights.where(F.col("highlight_type").isin(FT.CLUTCH_TYPES))
             .select("match_id", "map_id", "round_no", "team_id").collect() if r.team_id is not None}
    teams = {(r.match_id, r.map_id, r.team_1_id): r.team_2_id for r in d.match_maps.collect()}
    teams |= {(m, p, b): a for (m, p, a), b in teams.items()}
    rows = FT.feat_rounds(d).collect()
    assert len(rows) == 2 * d.round_stats.count() and any(r.won_buy_clutch for r in rows)
    for r in rows:
        own, other = ((r.match_id, r.map_id, r.round_no, t) in pairs for t in (r.team_id, teams.get((r.match_id, r.map_id, r.team_id))))
        assert (r.won_buy_clutch, r.loss_buy_clutch) == (int(bool(r.won and own)), int(bool(r.won == 0 and other)))
