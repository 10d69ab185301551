"""Queries for loaders, joins, aggregations, sorts and set operations
(SURVEY §2.2 - §2.7). Every query runs over the whole domain tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skirmish.operators import aggregates as AG
from skirmish.operators import loaders as L
from skirmish.operators import sets as S
from skirmish.operators.joins import exists_flag
from skirmish.operators.windows import first_row
from skirmish.plans import features as FT
from skirmish.plans.registry import dom, query
from skirmish.sources.schemas import SCHEMAS
from skirmish.plans.sqlparts import (FLIP_ROUNDS, PLAYERS_ROLE, TEAM_ROWS, composition_sql,
                                     player_features_sql, text_arrays)

# Reference-style "as of" date for the window filters (the loaders' `date` argument).
AS_OF = "1998-01-01"
WINDOW_SQL = f"date >= DATE '{AS_OF}' - INTERVAL 180 DAY AND date < DATE '{AS_OF}'"


def _date_str(df, col="date"):
    return df.withColumn(col, F.col(col).cast("string"))


# ------------------------------------------------------------------ 2.2 loaders
LOAD_MATCHES_COLS = ("match_id AS id, url, CAST(date AS VARCHAR) AS date, tournament_id, stage, team_id, "
                     "team_against_id, team_score, team_against_score, team_rating, team_against_rating")


@query("load_matches", sql=f"SELECT {LOAD_MATCHES_COLS} FROM team_rows", ctes=TEAM_ROWS)
def load_matches(spark, sf_dir):
    return _date_str(L.load_matches(dom(spark, sf_dir)))


@query("filter_window", sql=f"SELECT {LOAD_MATCHES_COLS} FROM team_rows WHERE {WINDOW_SQL}", ctes=TEAM_ROWS)
def filter_window(spark, sf_dir):
    return _date_str(L.load_matches(dom(spark, sf_dir), as_of=AS_OF))


@query("flip_perspective", sql="""
SELECT id AS match_id, team_1_id AS team_id, team_2_id AS team_against_id, team_1_score AS team_score,
  team_2_score AS team_against_score FROM g_matches
UNION ALL SELECT id, team_2_id, team_1_id, team_2_score, team_1_score FROM g_matches""")
def flip_perspective(spark, sf_dir):
    d = dom(spark, sf_dir)
    return L.flip(d.matches, [F.col("id").alias("match_id")], {
        "team_id": ("team_1_id", "team_2_id"), "team_against_id": ("team_2_id", "team_1_id"),
        "team_score": ("team_1_score", "team_2_score"), "team_against_score": ("team_2_score", "team_1_score")})


def _load_maps_sql(excluded: int) -> str:
    """The declared columns of a map, those that name a team as its place, and the date."""
    def place(c: str, other: int | None) -> str:
        second = "ELSE 2" if other is None else f"WHEN team_2_id THEN 2 ELSE {other}"
        return f"CASE {c} WHEN team_1_id THEN 1 {second} END AS {c}"

    cols = [place(c, L.TEAM_CODES[c]) if c in L.TEAM_CODES else c for c in SCHEMAS["match_maps"].fieldNames()]
    return (f"WITH dated AS (SELECT id AS match_id, CAST(date AS VARCHAR) AS date FROM g_matches WHERE id <> {excluded}) "
            f"SELECT {', '.join(cols)}, date FROM dated JOIN g_match_maps USING (match_id)")


@query("load_maps", sql=_load_maps_sql(-1))
def load_maps(spark, sf_dir):
    return _date_str(L.load_maps(dom(spark, sf_dir)))


@query("filter_exclude", sql=_load_maps_sql(1))
def filter_exclude(spark, sf_dir):
    """All maps but those of match 1."""
    return _date_str(L.load_maps(dom(spark, sf_dir), match_id=1))


@query("recode_ordinal", sql="""
SELECT match_id, map_id, CASE WHEN team_def_first = team_1_id THEN 1 ELSE 2 END AS team_def_first,
  CASE WHEN team_pick = team_1_id THEN 1 WHEN team_pick = team_2_id THEN 2 ELSE 3 END AS team_pick
FROM g_match_maps""")
def recode_ordinal(spark, sf_dir):
    mm = dom(spark, sf_dir).match_maps
    t1, t2 = F.col("team_1_id"), F.col("team_2_id")
    return mm.select("match_id", "map_id", L.recode_ordinal(F.col("team_def_first"), t1, t2).alias("team_def_first"),
                     L.recode_ordinal(F.col("team_pick"), t1, t2, other=3).alias("team_pick"))


ROUNDS_COLS = ("fr.match_id, fr.map_id, fr.round_no, fr.team_id, fr.team_against_id, fr.team_buy_type, "
               "fr.team_against_buy_type, fr.team_bank, fr.team_against_bank, fr.def, fr.won, fr.won_method, "
               "CAST(m.date AS VARCHAR) AS date")


@query("load_rounds", sql=f"SELECT {ROUNDS_COLS} FROM fr JOIN g_matches m ON m.id = fr.match_id", ctes=FLIP_ROUNDS)
def load_rounds(spark, sf_dir):
    return _date_str(L.load_rounds(dom(spark, sf_dir), sort=True))


@query("sort_rounds", sql=f"SELECT {ROUNDS_COLS} FROM fr JOIN g_matches m ON m.id = fr.match_id "
                          "ORDER BY m.date DESC, fr.match_id, fr.map_id, fr.round_no",
       ctes=FLIP_ROUNDS)
def sort_rounds(spark, sf_dir):
    return _date_str(L.load_rounds(dom(spark, sf_dir), sort=True))


@query("bool_to_int", sql="SELECT match_id, map_id, round_no, team_id, def, won FROM fr", ctes=FLIP_ROUNDS)
def bool_to_int(spark, sf_dir):
    return L.flip_rounds(dom(spark, sf_dir).round_stats).select(
        "match_id", "map_id", "round_no", "team_id", "def", "won")


PLAYERS_SQL = """
SELECT p.match_id, p.map_id, p.team_id, p.player_id, p.side, p.agent_id, p.rating, p.acs, p.kills, p.deaths,
  p.assists, p.kast, p.adr, p.hs, p.first_kills, p.first_deaths, p.role, CAST(m.date AS VARCHAR) AS date
FROM pr p JOIN g_matches m ON m.id = p.match_id"""
PLAYER_COLS = ["match_id", "map_id", "team_id", "player_id", "side", "agent_id", "rating", "acs", "kills",
               "deaths", "assists", "kast", "adr", "hs", "first_kills", "first_deaths", "role", "date"]


@query("load_players", sql=PLAYERS_SQL, ctes=PLAYERS_ROLE)
def load_players(spark, sf_dir):
    return _date_str(L.load_players(dom(spark, sf_dir))).select(*PLAYER_COLS)


@query("filter_optional", sql=PLAYERS_SQL + f" WHERE m.{WINDOW_SQL}", ctes=PLAYERS_ROLE)
def filter_optional(spark, sf_dir):
    # date given, match_id / map_id not given: only the window predicate is added
    return _date_str(L.load_players(dom(spark, sf_dir), as_of=AS_OF, match_id=None, map_id=None)).select(*PLAYER_COLS)


@query("filter_optional_map", sql=PLAYERS_SQL + " WHERE p.map_id = 5", ctes=PLAYERS_ROLE)
def filter_optional_map(spark, sf_dir):
    """Only the map given: players of all its games."""
    return _date_str(L.load_players(dom(spark, sf_dir), map_id=5)).select(*PLAYER_COLS)


@query("filter_optional_match", sql=PLAYERS_SQL + f" WHERE m.{WINDOW_SQL} AND p.match_id = 280 AND p.map_id = 5", ctes=PLAYERS_ROLE)
def filter_optional_match(spark, sf_dir):
    """Date, match and map given: all three predicates are added."""
    return _date_str(L.load_players(dom(spark, sf_dir), as_of=AS_OF, match_id=280, map_id=5)).select(*PLAYER_COLS)


@query("load_highlights", sql="""
SELECT h.*, CAST(m.date AS VARCHAR) AS date FROM g_player_highlights h JOIN g_matches m ON m.id = h.match_id""")
def load_highlights(spark, sf_dir):
    return _date_str(L.load_highlights(dom(spark, sf_dir)))


@query("filter_side", sql="SELECT match_id, map_id, team_id, player_id, agent_id, role FROM pr WHERE side = 'def'",
       ctes=PLAYERS_ROLE)
def filter_side(spark, sf_dir):
    d = dom(spark, sf_dir)
    p = L.join_role(d.player_overview_stats, d)
    return p.filter(F.col("side") == "def").select("match_id", "map_id", "team_id", "player_id", "agent_id", "role")


@query("filter_in", sql="""
SELECT * FROM g_player_highlights WHERE highlight_type IN ('1v1', '1v2', '1v3', '1v4', '1v5')""")
def filter_in(spark, sf_dir):
    return dom(spark, sf_dir).player_highlights.filter(F.col("highlight_type").isin(FT.CLUTCH_TYPES))


@query("filter_either_side", sql="""
SELECT id, CAST(date AS VARCHAR) AS date, team_1_id, team_2_id FROM g_matches
WHERE team_1_id IN (SELECT team_id FROM fin) OR team_2_id IN (SELECT team_id FROM fin)""",
       ctes=TEAM_ROWS + """,
gf AS (SELECT team_id, date FROM team_rows WHERE stage = 'grand_final' AND team_score > team_against_score),
fin AS (SELECT DISTINCT team_id FROM gf WHERE date = (SELECT max(date) FROM gf))""")
def filter_either_side(spark, sf_dir):
    """Matches where a winner of the last grand-final day is on either side: flip + equality semi-join instead of an OR of two columns."""
    d = dom(spark, sf_dir)
    tm = L.load_matches(d)
    won = tm.filter((F.col("stage") == "grand_final") & (F.col("team_score") > F.col("team_against_score")))
    last = won.agg(F.max("date").alias("date"))  # one row
    finalists = won.join(F.broadcast(last), "date").select("team_id").distinct()
    hit = tm.join(finalists, "team_id", "left_semi").select("id").distinct()
    return _date_str(d.matches.join(hit, "id", "left_semi").select("id", "date", "team_1_id", "team_2_id"))


@query("load_duels", sql="SELECT * FROM duels", ctes="duels AS (" + __import__(
    "skirmish.plans.q_features", fromlist=["DUELS_SQL"]).DUELS_SQL + ")")
def load_duels(spark, sf_dir):
    return L.load_duels(dom(spark, sf_dir))


@query("duel_features", sql="""SELECT player_kills_vs_opp, opp_kills_vs_players, player_first_kills_vs_opp,
  opp_first_kills_vs_players, player_op_kills_vs_opp, opp_op_kills_vs_players FROM duels""",
       ctes="duels AS (" + __import__("skirmish.plans.q_features", fromlist=["DUELS_SQL"]).DUELS_SQL + ")")
def duel_features(spark, sf_dir):
    return L.duel_features(dom(spark, sf_dir))


@query("project_drop", sql="""
SELECT stage, team_score, team_against_score, team_rating, team_against_rating FROM team_rows""", ctes=TEAM_ROWS)
def project_drop(spark, sf_dir):
    return L.load_matches(dom(spark, sf_dir)).drop("id", "url", "date", "tournament_id", "team_id", "team_against_id")


_BUY_SHORT_SQL = ("CASE {c} WHEN 'pistol' THEN 'P' WHEN 'eco' THEN 'E' WHEN 'semi_eco' THEN 'SE' "
                  "WHEN 'semi_buy' THEN 'SB' WHEN 'full_buy' THEN 'FB' ELSE '' END")


@query("recode_short", sql=f"""
SELECT match_id, map_id, round_no, {_BUY_SHORT_SQL.format(c='team_1_buy_type')} AS team_1_buy,
  {_BUY_SHORT_SQL.format(c='team_2_buy_type')} AS team_2_buy,
  CASE won_method WHEN 'defuse' THEN 'DEF' WHEN 'eliminate' THEN 'ELIM' WHEN 'out_of_time' THEN 'OOT'
    WHEN 'spike_explode' THEN 'SPIKE' ELSE '' END AS won_method
FROM g_round_stats""")
def recode_short(spark, sf_dir):
    from skirmish.functions import rules as R
    r = dom(spark, sf_dir).round_stats
    return r.select("match_id", "map_id", "round_no", R.short_buy_type(F.col("team_1_buy_type")).alias("team_1_buy"),
                    R.short_buy_type(F.col("team_2_buy_type")).alias("team_2_buy"),
                    R.short_won_method(F.col("won_method")).alias("won_method"))


# ------------------------------------------------------------------ 2.3 joins
@query("join_date", sql="""
SELECT r.match_id, r.map_id, r.round_no, CAST(m.date AS VARCHAR) AS date
FROM g_round_stats r JOIN g_matches m ON m.id = r.match_id""")
def join_date(spark, sf_dir):
    d = dom(spark, sf_dir)
    return _date_str(L.join_date(d.round_stats.select("match_id", "map_id", "round_no"), d))


@query("join_role", sql="SELECT match_id, map_id, team_id, player_id, side, agent_id, role FROM pr",
       ctes=PLAYERS_ROLE)
def join_role(spark, sf_dir):
    d = dom(spark, sf_dir)
    return L.join_role(d.player_overview_stats, d).select(
        "match_id", "map_id", "team_id", "player_id", "side", "agent_id", "role")


@query("join_highlight_round", sql="""
SELECT h.match_id, h.map_id, h.team_id, h.player_id, h.round_no, h.highlight_type, r.def, r.won
FROM (SELECT DISTINCT match_id, map_id, team_id, player_id, round_no, highlight_type FROM g_player_highlights) h
JOIN fr r ON r.match_id = h.match_id AND r.map_id = h.map_id AND r.team_id = h.team_id AND r.round_no = h.round_no""",
       ctes=FLIP_ROUNDS)
def join_highlight_round(spark, sf_dir):
    return FT.enriched_highlights(dom(spark, sf_dir))


@query("join_self_opp", sql="""
WITH k AS (SELECT match_id, map_id, team_id, sum(kills) AS kills FROM g_player_overview_stats
           GROUP BY match_id, map_id, team_id)
SELECT s.match_id, s.map_id, s.team_id, o.kills AS team_kills, a.kills AS team_against_kills
FROM g_sides s JOIN k o ON o.match_id = s.match_id AND o.map_id = s.map_id AND o.team_id = s.team_id
JOIN k a ON a.match_id = s.match_id AND a.map_id = s.map_id AND a.team_id = s.opp_id""")
def join_self_opp(spark, sf_dir):
    """Own vs opponent rows of the same map: an equi self-join on (match, map)
    with the team swapped (co-partitioned on match_id, no exchange)."""
    d = dom(spark, sf_dir)
    k = d.player_overview_stats.groupBy("match_id", "map_id", "team_id").agg(F.sum("kills").alias("kills"))
    own = k.withColumnRenamed("kills", "team_kills")
    opp = k.select("match_id", "map_id", F.col("team_id").alias("opp_id"), F.col("kills").alias("team_against_kills"))
    return d.sides.join(own, ["match_id", "map_id", "team_id"]).join(opp, ["match_id", "map_id", "opp_id"]) \
        .select("match_id", "map_id", "team_id", "team_kills", "team_against_kills")


@query("join_exists_flag", sql="""
SELECT fr.match_id, fr.map_id, fr.round_no, fr.team_id, CAST(c.team_id IS NOT NULL AS INT) AS has_clutch
FROM fr LEFT JOIN (SELECT DISTINCT match_id, map_id, round_no, team_id FROM g_player_highlights
                   WHERE highlight_type IN ('1v1', '1v2', '1v3', '1v4', '1v5')) c
  ON c.match_id = fr.match_id AND c.map_id = fr.map_id AND c.round_no = fr.round_no AND c.team_id = fr.team_id""",
       ctes=FLIP_ROUNDS)
def join_exists_flag(spark, sf_dir):
    d = dom(spark, sf_dir)
    r = L.flip_rounds(d.round_stats).select("match_id", "map_id", "round_no", "team_id")
    c = d.player_highlights.filter(F.col("highlight_type").isin(FT.CLUTCH_TYPES))
    return exists_flag(r, c, ["match_id", "map_id", "round_no", "team_id"], "has_clutch")


@query("join_semi_exists", sql=f"""
SELECT id, url FROM g_raw_matches q WHERE EXISTS (SELECT 1 FROM g_matches m WHERE m.id = q.id AND m.date < DATE '{AS_OF}')""")
def join_semi_exists(spark, sf_dir):
    """Which queued match pages are loaded already (loaded = all matches before the cut)."""
    d = dom(spark, sf_dir)
    loaded = d.matches.filter(F.col("date") < F.lit(AS_OF).cast("date")).select("id")
    return d.raw_matches.select("id", "url").join(loaded, "id", "left_semi")


# ------------------------------------------------------------------ 2.4 aggregations
@query("agg_dedupe_first", sql="""
SELECT match_id, map_id, team_id, player_id, round_no, highlight_type, min(player_against_id) AS player_against_id
FROM g_player_highlights GROUP BY match_id, map_id, team_id, player_id, round_no, highlight_type""")
def agg_dedupe_first(spark, sf_dir):
    h = dom(spark, sf_dir).player_highlights
    return AG.dedupe_first(h, ["match_id", "map_id", "team_id", "player_id", "round_no", "highlight_type"],
                           "player_against_id")


@query("win_first_row", sql="""
SELECT match_id, map_id, round_no, team_id, player_id, highlight_type, player_against_id FROM (
  SELECT *, row_number() OVER (PARTITION BY match_id, map_id, team_id, player_id, round_no, highlight_type
                               ORDER BY player_against_id) AS rn FROM g_player_highlights) WHERE rn = 1""")
def win_first_row(spark, sf_dir):
    h = dom(spark, sf_dir).player_highlights
    return first_row(h, ["match_id", "map_id", "team_id", "player_id", "round_no", "highlight_type"],
                     ["player_against_id"])


@query("agg_side_pivot", sql="""
SELECT match_id, map_id, team_id, player_id,
  max(CASE WHEN side = 'def' THEN kills END) AS def_kills, max(CASE WHEN side = 'atk' THEN kills END) AS atk_kills,
  max(CASE WHEN side = 'def' THEN rating END) AS def_rating, max(CASE WHEN side = 'atk' THEN rating END) AS atk_rating
FROM g_player_overview_stats GROUP BY match_id, map_id, team_id, player_id""")
def agg_side_pivot(spark, sf_dir):
    return FT.side_pivot(dom(spark, sf_dir).player_overview_stats).select(
        *FT.PLAYER_KEYS, "def_kills", "atk_kills", "def_rating", "atk_rating")


@query("agg_round_counts", sql="""
SELECT match_id, map_id, team_id, count(*) AS rounds, sum(def) AS def_rounds, count(*) - sum(def) AS atk_rounds
FROM fr GROUP BY match_id, map_id, team_id""", ctes=FLIP_ROUNDS)
def agg_round_counts(spark, sf_dir):
    return FT.round_counts(dom(spark, sf_dir))


@query("agg_cardinality_check", sql="""
SELECT match_id, map_id, team_id, player_id, count(*) AS n_rows FROM g_raw_side_rows
GROUP BY match_id, map_id, team_id, player_id HAVING count(*) != 2""")
def agg_cardinality_check(spark, sf_dir):
    """Players of a map without exactly one row per side, among side rows as
    they arrive: some are lost, some come twice."""
    return AG.cardinality_violations(dom(spark, sf_dir).raw_side_rows, FT.PLAYER_KEYS, 2)


def _pf(cols: list[str]):
    quoted = ", ".join(f'"{c}"' for c in cols)
    sql = f"SELECT match_id, map_id, team_id, player_id, {quoted} FROM pf"

    def build(spark, sf_dir):
        return FT.feat_players(dom(spark, sf_dir)).select(*FT.PLAYER_KEYS, *cols)
    return sql, build


_PF = player_features_sql()
_GROUPS = {
    "agg_weighted_rounds": [f"{p}{m}" for m in ("rating", "acs", "kast", "adr") for p in ("def_", "atk_", "")],
    "agg_weighted_kills": ["def_hs", "atk_hs", "hs"],
    "agg_per_round": [f"{p}{m}_per_round" for m in ("kills", "deaths", "assists", "fk", "fd")
                      for p in ("def_", "atk_", "")],
    "agg_clutch_rates": [f"{p}{k}_per_round" for k in FT.CLUTCH_TYPES for p in ("def_", "atk_", "")],
    "agg_multikill_rates": [f"{p}{k[0]}ks_per_round" for k in FT.MULTIKILL_TYPES for p in ("def_", "atk_", "")],
    "agg_convert_rates": [f"{p}{k[0]}ks_convert_rate" for k in FT.MULTIKILL_TYPES for p in ("def_", "atk_", "")],
}
for _name, _cols in _GROUPS.items():
    _sql, _fn = _pf(_cols)
    _fn.__name__ = _name
    query(_name, sql=_sql, ctes=_PF)(_fn)


_ROLE_NAMES = [n for n, _ in FT.ROLE_COUNTS]


@query("agg_role_counts", sql=f"SELECT match_id, map_id, team_id, {', '.join(_ROLE_NAMES)} FROM comp",
       ctes=f"{PLAYERS_ROLE},\n{composition_sql('comp', 'match_id, map_id, team_id')}")
def agg_role_counts(spark, sf_dir):
    d = dom(spark, sf_dir)
    return FT.composition(L.join_role(d.player_overview_stats, d), ["match_id", "map_id", "team_id"]).drop("agents")


@query("agg_agent_set", sql="SELECT match_id, map_id, team_id, agents FROM comp",
       ctes=f"{PLAYERS_ROLE},\n{composition_sql('comp', 'match_id, map_id, team_id')}")
def agg_agent_set(spark, sf_dir):
    d = dom(spark, sf_dir)
    c = FT.composition(L.join_role(d.player_overview_stats, d), ["match_id", "map_id", "team_id"])
    return text_arrays(c.select("match_id", "map_id", "team_id", "agents"))


@query("sort_values", sql="""
SELECT match_id, map_id, team_id, array_to_string(list_sort(list(role)), ',') AS roles
FROM pr WHERE side = 'def' GROUP BY match_id, map_id, team_id""", ctes=PLAYERS_ROLE)
def sort_values(spark, sf_dir):
    d = dom(spark, sf_dir)
    p = L.join_role(d.player_overview_stats, d).filter(F.col("side") == "def")
    return p.groupBy("match_id", "map_id", "team_id").agg(AG.sorted_list_text("role").alias("roles"))


@query("agg_collect_nested", sql="""
SELECT match_id, string_agg(CAST(map_id AS VARCHAR) || ':' || CAST(team_1_def_score AS VARCHAR), ';' ORDER BY map_id)
  AS maps FROM g_match_maps GROUP BY match_id""")
def agg_collect_nested(spark, sf_dir):
    """Maps collected into their match (≤ 3 per match: a bounded group)."""
    mm = dom(spark, sf_dir).match_maps
    g = mm.groupBy("match_id").agg(F.sort_array(F.collect_list(F.struct("map_id", "team_1_def_score"))).alias("maps"))
    return g.select("match_id", F.array_join(F.transform("maps", lambda m: F.concat_ws(
        ":", m["map_id"].cast("string"), m["team_1_def_score"].cast("string"))), ";").alias("maps"))


_TABLE_VIEWS = ["matches", "match_maps", "round_stats", "player_overview_stats", "player_highlights",
                "players_duel_stats"]


@query("agg_is_empty", sql=" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST(count(*) = 0 AS INT) AS is_empty FROM g_{t}"
    for t in _TABLE_VIEWS))
def agg_is_empty(spark, sf_dir):
    d = dom(spark, sf_dir)
    from functools import reduce
    return reduce(lambda a, b: a.unionByName(b), [AG.is_empty(getattr(d, t), t) for t in _TABLE_VIEWS])


@query("agg_max_date", sql="SELECT CAST(max(date) AS VARCHAR) AS max_date, count(*) AS n_matches FROM g_matches")
def agg_max_date(spark, sf_dir):
    m = dom(spark, sf_dir).matches
    return m.agg(AG.max_date(m).cast("string").alias("max_date"), F.count(F.lit(1)).alias("n_matches"))


# ------------------------------------------------------------------ 2.6 sorts / limits
@query("limit_first", sql="""
SELECT id, CAST(date AS VARCHAR) AS date FROM g_matches ORDER BY date DESC, id LIMIT 1""")
def limit_first(spark, sf_dir):
    """Latest loaded match (ORDER BY date DESC LIMIT 1 is the feature)."""
    m = dom(spark, sf_dir).matches
    return _date_str(m.orderBy(F.desc("date"), "id").limit(1).select("id", "date"))


# ------------------------------------------------------------------ 2.7 sets
@query("set_insert_ignore", sql="""
WITH ex AS (SELECT DISTINCT team_1_id AS team_id FROM g_matches WHERE stage = 'grand_final'),
inc AS (SELECT team_2_id AS team_id, min(id) AS first_match FROM g_matches GROUP BY team_2_id)
SELECT team_id, NULL::BIGINT AS first_match FROM ex
UNION ALL SELECT team_id, first_match FROM inc WHERE team_id NOT IN (SELECT team_id FROM ex)""")
def set_insert_ignore(spark, sf_dir):
    """Insert teams seen as team 2 unless already present (present = teams
    that played a grand final as team 1); the first row per key wins."""
    m = dom(spark, sf_dir).matches
    existing = m.filter(F.col("stage") == "grand_final").select(F.col("team_1_id").alias("team_id")).distinct() \
        .withColumn("first_match", F.lit(None).cast("bigint"))
    incoming = m.select(F.col("team_2_id").alias("team_id"), F.col("id").alias("first_match"))
    return S.insert_ignore(existing, incoming, ["team_id"])
