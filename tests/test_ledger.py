"""Pinned behaviours of the semantics ledger on hand-made rows."""

import datetime as dt
from types import SimpleNamespace

from pyspark.sql import functions as F

from skirmish.operators import aggregates as AG
from skirmish.operators import loaders as L
from skirmish.operators import windows as W
from skirmish.plans import features as FT
from skirmish.plans import ingest as I
from skirmish.sources import seeds as SD
from skirmish.streaming import incremental as INC

from conftest import SF0001


def test_q1_window_edges(spark):
    d = dt.date(2025, 9, 7)
    days = [181, 180, 1, 0]
    rows = [(i, d - dt.timedelta(days=k), 7, 8, 2, 1) for i, k in enumerate(days)]
    tm = spark.createDataFrame(rows, "id long, date date, team_id long, team_against_id long, team_score long, "
                                     "team_against_score long")
    out = {r.match_id: r.n_matches for r in W.win_history(tm).collect()}
    assert out[3] == 2          # D-180 and D-1 count; D-181 and D itself do not
    assert out[0] == 0


def test_q4_players_without_two_sides_are_violations(spark):
    base = dict(agent_id=1, rating=1.0, acs=200.0, kills=10, deaths=5, assists=3, kast=70.0, adr=130.0, hs=20.0,
                first_kills=1, first_deaths=1)
    cols = "match_id long, map_id long, team_id long, player_id long, side string, " + ", ".join(
        f"{k} {'int' if isinstance(v, int) else 'double'}" for k, v in base.items())
    rows = [(1, 1, 7, 70, s, *base.values()) for s in ("def", "atk")] + \
           [(1, 1, 7, 71, s, *base.values()) for s in ("def", "atk", "atk")]
    stub = SimpleNamespace(player_overview_stats=spark.createDataFrame(rows, cols),
                           agents=spark.createDataFrame([(1, "a", "duelist")], "id int, name string, agent_type string"))
    clean, bad = FT.player_inputs(stub)
    assert [r.player_id for r in clean.collect()] == [70]
    assert [(r.player_id, r.n_rows) for r in bad.collect()] == [(71, 3)]


def test_q24_unknown_agent_role_is_null(spark):
    stub = SimpleNamespace(agents=spark.createDataFrame([(1, "a", "duelist")], "id int, name string, agent_type string"))
    p = spark.createDataFrame([(1,), (99,)], "agent_id int")
    got = {r.agent_id: r.role for r in L.join_role(p, stub).collect()}
    assert got == {1: "duelist", 99: None}


def test_q6_dedupe_first_is_deterministic(spark):
    df = spark.createDataFrame([(1, "2k", 30), (1, "2k", 10), (1, "2k", 20)], "k long, t string, against long")
    assert [tuple(r) for r in AG.dedupe_first(df, ["k", "t"], "against").collect()] == [(1, "2k", 10)]


def test_q22_all_or_nothing(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 1, None), (1, 2, 5), (1, 2, 6)], "m long, p long, v int")
    clean, bad = W.all_or_nothing(df, ["m", "p"], F.col("v").isNotNull())
    assert sorted((r.m, r.p) for r in clean.collect()) == [(1, 2), (1, 2)]
    assert sorted((r.m, r.p) for r in bad.collect()) == [(1, 1), (1, 1)]


def test_q18_ttl_latest(spark):
    t = dt.datetime(2024, 1, 10)
    rows = [("a", "v1", t, None, 1, False), ("a", "v2", t + dt.timedelta(hours=1), None, 2, False),
            ("b", "x", t, t + dt.timedelta(hours=1), 3, False),                 # expired at now
            ("c", "y", t, None, 4, False), ("c", None, t + dt.timedelta(hours=2), None, 5, True),  # deleted
            ("d", "z", t, t + dt.timedelta(days=5), 6, False)]
    w = spark.createDataFrame(rows, "key string, value string, written_at timestamp, expires_at timestamp, "
                                    "seq long, is_delete boolean")
    live = {r.key: r.value for r in INC.ttl_latest(w, F.lit(t + dt.timedelta(hours=3))).collect()}
    assert live == {"a": "v2", "d": "z"}


def test_veto_note_golden(spark):
    note = ("PRX ban Haven; PRX ban Ascent; PRX pick Sunset; FNC pick Icebox; PRX pick Pearl; "
            "FNC pick Lotus; Split remains")
    stub = SimpleNamespace(
        veto_notes=spark.createDataFrame([(1, 624, 2593, "PRX", "FNC", note)],
                                         "match_id long, team_1_id long, team_2_id long, t1_short string, "
                                         "t2_short string, note string"),
        maps=SD.seed_maps(spark))
    turns = sorted(I.job_vetoes(stub).collect(), key=lambda r: r.veto_order)
    assert [r.veto_order for r in turns] == list(range(1, 8))
    assert [r.team_id for r in turns] == [624, 624, 624, 2593, 624, 2593, None]
    assert [r.veto_action for r in turns] == ["ban", "ban", "pick", "pick", "pick", "pick", "remain"]
    assert [r.map_id for r in turns] == [5, 1, 10, 6, 8, 7, 9]
    assert [r.ban_pick_order for r in turns] == [1, 2, 1, 2, 3, 4, 1]


def test_q16_geography_lookup(spark):
    """The reference's golden names resolve by snake-case containment, first row in file order."""
    nation = spark.createDataFrame(
        [(0, "Singapore", 0), (1, "Russia", 1), (2, "Canada", 2), (3, "United States", 2), (4, "Vietnam", 0),
         (5, "United States Minor Outlying Islands", 2)],
        "n_nationkey int, n_name string, n_regionkey int")
    region = spark.createDataFrame([(0, "Asia"), (1, "Europe"), (2, "North America")], "r_regionkey int, r_name string")
    stub = SimpleNamespace(t=SimpleNamespace(nation=nation, region=region))
    names = spark.createDataFrame([("Singapore",), ("RUSSIA",), ("canada",), ("United States",), ("Vietnam",), ("",),
                                   ("Atlantis",)], "place string")
    got = {r.place: r.country_country for r in I.geo_lookup(names, stub, "place", "country").collect()}
    assert got == {"Singapore": "Singapore", "RUSSIA": "Russia", "canada": "Canada",
                   "United States": "United States", "Vietnam": "Vietnam"}
    regions = spark.createDataFrame([("Asia",), ("North AMERICA",), ("europe",)], "place string")
    got = {r.place: r.continent_continent for r in I.geo_lookup(regions, stub, "place", "continent").collect()}
    assert got == {"Asia": "Asia", "North AMERICA": "North America", "europe": "Europe"}


def test_dense_ids_are_stable(spark):
    df = spark.createDataFrame([(n,) for n in ["d", "b", "a", "c"]], "name string")
    got = {r.name: r.id for r in I.dense_ids(df, "name", 10).collect()}
    assert got == {"a": 11, "b": 12, "c": 13, "d": 14}


def test_ingest_batch_is_idempotent(spark, tmp_path):
    from skirmish.plans.batch import ingest_batch
    from skirmish.sources.fixtures import Domain
    d = Domain(spark, SF0001)
    out = str(tmp_path / "store")
    p1 = ingest_batch(d, out)
    n1 = {k: spark.read.parquet(v).count() for k, v in p1.items()}
    ingest_batch(Domain(spark, SF0001), out)          # a re-run adds nothing
    n2 = {k: spark.read.parquet(v).count() for k, v in p1.items()}
    assert n1 == n2
    assert n1["round_stats"] + n1["round_quarantine"] == d.round_stats.count()
    rejected = d.player_highlights.filter("match_id % 89 = 0 and round_no = 3").select("match_id", "map_id").distinct()
    assert n1["player_highlights"] == d.player_highlights.join(rejected, ["match_id", "map_id"], "left_anti").count()
    assert n1["players_duel_stats"] == d.players_duel_stats.filter("match_id % 79 <> 0 and match_id % 83 <> 0").count()
    assert n1["player_overview_stats"] / 2 + n1["player_stats_rejected"] == d.raw_player_stats.count()
    assert n1["player_stats_rejected"] > 0


def test_one_bad_player_rejects_the_match(spark):
    from skirmish.plans import ingest as I
    from skirmish.sources.fixtures import COUNT_STATS, WEIGHTED_STATS

    def player(match, pid, agent="agent_1", **gaps):
        cells = {f"{side}_{s}": 2.0 if s in WEIGHTED_STATS else 2 for s in COUNT_STATS + WEIGHTED_STATS
                 for side in ("def", "atk", "both")}
        return dict(match_id=match, map_id=1, team_id=5, player_id=pid, agent_name=agent, **{**cells, **gaps})

    names = ", ".join(f"{side}_{s} {'double' if s in WEIGHTED_STATS else 'long'}" for s in COUNT_STATS + WEIGHTED_STATS
                      for side in ("def", "atk", "both"))

    class Stub:
        raw_player_stats = spark.createDataFrame(
            [player(1, 50, def_kills=None, both_kills=9, def_acs=None, both_acs=3.0), player(2, 50), player(2, 51, agent="new"),
             player(3, 50, def_deaths=None, both_deaths=None)],
            "match_id long, map_id long, team_id long, player_id long, agent_name string, " + names)
        agents = spark.createDataFrame([(7, "agent_1")], "id int, name string")
        match_maps = spark.createDataFrame(
            [(m, 1, 5, 6, 6, 6, 0, 6, 6, 0) for m in (1, 2, 3)],
            "match_id long, map_id long, team_1_id long, team_2_id long, " + ", ".join(
                f"team_{t}_{s}_score long" for t in (1, 2) for s in ("def", "atk", "ot")))

    rows, rejected = I.job_player_stats(Stub())
    got = {r.side: r for r in rows.collect()}
    assert {r.match_id for r in got.values()} == {1} and got["def"].agent_id == 7
    assert got["def"].kills == 7 and got["atk"].kills == 2 and got["def"].acs == 4.0
    assert {(r.match_id, r.player_id): r.failed for r in rejected.collect()} == {
        (2, 50): "", (2, 51): "agent", (3, 50): "deaths"}


def test_q23_duplicate_display_name_last_position_wins(spark):
    from skirmish.sources.raw_views import dedupe_names
    named = spark.createDataFrame([(1, 1, 7, "ace", 70, 0), (1, 1, 7, "ace", 73, 3), (1, 1, 7, "bob", 71, 1)],
                                  "match_id long, map_id long, team_id long, name string, player_id long, pos long")
    got = {r.name: r.player_id for r in dedupe_names(named).collect()}
    assert got == {"ace": 73, "bob": 71}


def test_q17_unknown_opponent_name_maps_to_zero(spark):
    """A highlight naming an opponent who is not on the other team's roster
    keeps its row with player_against_id 0; known names resolve to ids."""
    mm = spark.createDataFrame([(1, 3, 7, 8)], "match_id long, map_id long, team_1_id long, team_2_id long")
    stats = spark.createDataFrame([(1, 3, 7, 70 + i, "def") for i in range(5)] +
                                  [(1, 3, 8, 80 + i, "def") for i in range(5)],
                                  "match_id long, map_id long, team_id long, player_id long, side string")
    hl = spark.createDataFrame([(1, 3, 4, 7, 70, "2k", 80), (1, 3, 4, 7, 70, "2k", 999)],
                               "match_id long, map_id long, round_no int, team_id long, player_id long, "
                               "highlight_type string, player_against_id long")
    stub = SimpleNamespace(match_maps=mm, player_overview_stats=stats, player_highlights=hl)
    got = sorted((r.player_id, r.player_against_id) for r in I.job_highlights(stub).collect())
    assert got == [(70, 0), (70, 80)]


def test_q19_frontier_keeps_boundary_day_and_drops_known_urls(spark):
    d = dt.date(1998, 1, 10)
    listing = spark.createDataFrame([("/1/a", d - dt.timedelta(days=1)), ("/2/b", d), ("/3/c", d + dt.timedelta(days=1)),
                                     ("/4/d", d), ("/5/e", d + dt.timedelta(days=2))], "url string, date date")
    queue = spark.createDataFrame([("/4/d", d), ("/6/f", d + dt.timedelta(days=3))], "url string, date date")
    loaded = spark.createDataFrame([("/5/e",)], "url string")
    out = {r.url: r.date for r in INC.frontier(listing, queue, loaded, F.lit(d)).collect()}
    # /1/a is before the limit; /2/b is on the boundary day (kept); /4/d is queued already (once);
    # /5/e is loaded; /6/f stays from the queue
    assert out == {"/2/b": d, "/3/c": d + dt.timedelta(days=1), "/4/d": d, "/6/f": d + dt.timedelta(days=3)}
    limit = INC.high_mark(queue, loaded.withColumn("date", F.lit(d)), "2000-01-01").first()["limit_date"]
    assert limit == d + dt.timedelta(days=3)


def test_q12_remain_and_remains_are_accepted(spark):
    stub = SimpleNamespace(
        veto_notes=spark.createDataFrame([(1, 5, 6, "AA", "BB", "AA ban Ascent; XX pick Bind; Lotus remain"),
                                          (2, 5, 6, "AA", "BB", "BB pick Nowhere; Split remains")],
                                         "match_id long, team_1_id long, team_2_id long, t1_short string, "
                                         "t2_short string, note string"),
        maps=SD.seed_maps(spark))
    rows = sorted((r.match_id, r.veto_order, r.team_id, r.veto_action, r.map_id) for r in I.job_vetoes(stub).collect())
    assert rows == [(1, 1, 5, "ban", 1), (1, 2, None, "pick", 2), (1, 3, None, "remain", 7),
                    (2, 1, 6, "pick", None), (2, 2, None, "remain", 9)]


def test_veto_violations_are_reported(spark):
    from skirmish.operators import quality as Q
    vetoes = spark.createDataFrame([(1, 5, 1, 1, "ban"), (1, None, 2, 2, "pick"), (1, None, 3, None, "remain"),
                                    (1, None, 4, 3, None)],
                                   "match_id long, team_id long, veto_order int, map_id long, veto_action string")
    empty_r = spark.createDataFrame([], "match_id long, map_id long, round_no int, team_1_id long, team_2_id long, "
                                        "team_def long, team_1_buy_type string, team_1_bank int, team_2_bank int, "
                                        "won_method string")
    empty_p = spark.createDataFrame([], "match_id long, map_id long, player_id long, side string, rating double, "
                                        "kast double, hs double")
    got = sorted((r.row_key, r.rule) for r in Q.dq_checks(empty_r, empty_p, vetoes).collect())
    assert got == [("1:2", "team_id for ban/pick"), ("1:3", "map_id not null"), ("1:4", "veto_action enum")]


def test_unknown_owner_rejects_the_maps_highlights(spark, monkeypatch):
    """An owner who is not on the roster rejects all highlights of that map
    (Q17); other maps stay."""
    from types import SimpleNamespace
    from skirmish.plans import ingest as I
    cells = spark.createDataFrame([(1, 1, 1, "2k", 0, "ann", "cy"), (1, 1, 2, "2k", 1, "nobody", "cy"), (1, 2, 1, "2k", 0, "ann", "cy, zed")],
                                  "match_id long, map_id long, round_no int, highlight_type string, pos int, owner_txt string, opponents_txt string")
    roster = spark.createDataFrame([(1, m, t, n, p) for m in (1, 2) for t, n, p in ((10, "ann", 100), (20, "cy", 200))],
                                   "match_id long, map_id long, team_id long, name string, player_id long")
    maps = spark.createDataFrame([(1, 1, 10, 20), (1, 2, 10, 20)], "match_id long, map_id long, team_1_id long, team_2_id long")
    monkeypatch.setattr(I.RV, "raw_highlight_cells", lambda d: cells)
    monkeypatch.setattr(I.RV, "roster", lambda d: roster)
    got = sorted((r.map_id, r.player_id, r.player_against_id) for r in I.job_highlights(SimpleNamespace(match_maps=maps)).collect())
    assert got == [(2, 100, 0), (2, 100, 200)]


def test_append_writes_a_repeated_key_once(spark, tmp_path):
    from skirmish.sources.io import append_new
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id long, x string")
    append_new(rows, f"{tmp_path}/t", ["id"])
    append_new(spark.createDataFrame([(2, "b"), (3, "c"), (3, "c")], rows.schema), f"{tmp_path}/t", ["id"])
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [1, 2, 3]
