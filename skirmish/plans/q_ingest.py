"""Queries for ingest jobs, their joins and data-quality rules (SURVEY §2.3,
§2.5, §2.9) over the raw page-fragment views."""

from __future__ import annotations

from pyspark.sql import functions as F

from skirmish.operators import aggregates as AG
from skirmish.operators import quality as Q
from skirmish.operators.windows import slot_team
from skirmish.plans import dimensions as DM
from skirmish.plans import ingest as I
from skirmish.plans import rules_sql as S
from skirmish.plans.registry import dom, query
from skirmish.sources import raw_views as RV
from skirmish.sources.fixtures import COUNT_STATS
from skirmish.sources.schemas import FOREIGN_KEYS, KEYS, SCHEMAS, rules_of


def _big(df, cols):
    return df.select(*[F.col(c).cast("bigint").alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ matches
JOB_MATCHES_SQL = f"""
SELECT {S.url_id('url')} AS id, url, date, {S.url_id('event_href')} AS tournament_id, {S.stage('series_txt')} AS stage,
  {S.url_id('team_1_href')} AS team_1_id, {S.url_id('team_2_href')} AS team_2_id,
  {S.to_int('team_1_score_txt')} AS team_1_score, {S.to_int('team_2_score_txt')} AS team_2_score,
  {S.rating('team_1_rating_txt')} AS team_1_rating, {S.rating('team_2_rating_txt')} AS team_2_rating, {S.duration('duration_txt')} AS duration
FROM g_raw_matches"""


@query("job_matches", sql=f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date) FROM ({JOB_MATCHES_SQL})")
def job_matches(spark, sf_dir):
    return I.job_matches(dom(spark, sf_dir)).withColumn("date", F.col("date").cast("string"))


# ------------------------------------------------------------------ maps
TABS_SQL = """
SELECT o.*, p.n_duel_cells, e.n_rounds FROM g_raw_map_overview o
JOIN g_raw_map_performance p ON p.match_id = o.match_id AND p.game_id = o.game_id
JOIN g_raw_map_economy e ON e.match_id = o.match_id AND e.game_id = o.game_id
WHERE o.game_id != 'all' AND p.game_id != 'all' AND e.game_id != 'all'"""


@query("join_tabs", sql=f"SELECT match_id, game_id, map_name, n_duel_cells, n_rounds FROM ({TABS_SQL})")
def join_tabs(spark, sf_dir):
    return I.join_tabs(dom(spark, sf_dir)).select("match_id", "game_id", "map_name", "n_duel_cells", "n_rounds")


_SCORES_SQL = ", ".join(f"{S.to_int(f't.t{t}_{s}_txt')} AS team_{t}_{s}_score" for t in (1, 2)
                        for s in ("def", "atk", "ot"))
JOB_MAPS_SQL = f"""
SELECT t.match_id, mp.id AS map_id, {S.duration('t.duration_txt')} AS duration, m.team_1_id, m.team_2_id, {_SCORES_SQL},
  {S.def_first('t.def_first_class', 'm.team_1_id', 'm.team_2_id')} AS team_def_first,
  {S.team_pick('t.pick_class', 'm.team_1_id', 'm.team_2_id')} AS team_pick, t.n_rounds, t.n_duel_cells
FROM ({TABS_SQL}) t LEFT JOIN g_maps mp ON mp.name = t.map_name JOIN g_matches m ON m.id = t.match_id"""


@query("job_match_maps", sql=JOB_MAPS_SQL)
def job_match_maps(spark, sf_dir):
    return I.job_match_maps(dom(spark, sf_dir))


@query("join_dim_name", sql="""
SELECT DISTINCT o.map_name, mp.id AS map_id FROM g_raw_map_overview o LEFT JOIN g_maps mp ON mp.name = o.map_name
WHERE o.game_id != 'all'""")
def join_dim_name(spark, sf_dir):
    d = dom(spark, sf_dir)
    ov, _, _ = RV.raw_map_tabs(d)
    names = ov.filter(F.col("game_id") != "all").select("map_name").distinct()
    return names.join(I.maps_by_name(d), "map_name", "left")


# ------------------------------------------------------------------ rounds
PARSE_ROUNDS_SQL = f"""pr0 AS (
  SELECT match_id, map_id, round_no, team_1_id, team_2_id, t1_bank_txt,
    {S.team_won('t1_win_class', 'team_1_id', 'team_2_id')} AS team_won, win_class, win_img, t1_buy_txt, t2_buy_txt,
    t2_bank_txt, concat_ws('|', round_no, t1_bank_txt, t2_bank_txt, win_img) AS raw FROM g_raw_rounds),
prd AS (
  SELECT match_id, map_id, round_no, team_1_id, team_2_id,
    {S.team_def('win_class', 'team_1_id', 'team_2_id', 'team_won')} AS team_def,
    {S.buy_type('t1_buy_txt', 'round_no')} AS team_1_buy_type, {S.buy_type('t2_buy_txt', 'round_no')} AS team_2_buy_type,
    {S.bank('t1_bank_txt')} AS team_1_bank, {S.bank('t2_bank_txt')} AS team_2_bank, team_won,
    {S.won_method('win_img')} AS won_method, t1_bank_txt, raw
  FROM pr0),
prv AS (
  SELECT *, (team_def IS NOT NULL AND team_1_buy_type IS NOT NULL AND team_2_buy_type IS NOT NULL
    AND team_1_bank IS NOT NULL AND team_2_bank IS NOT NULL AND team_won IS NOT NULL AND won_method IS NOT NULL) AS row_ok
  FROM prd),
prg AS (SELECT *, bool_and(row_ok) OVER (PARTITION BY match_id, map_id) AS group_ok FROM prv)"""
ROUND_COLS = ("match_id, map_id, round_no, team_1_id, team_2_id, team_def, team_1_buy_type, team_2_buy_type, "
              "team_1_bank, team_2_bank, team_won, won_method")


@query("job_rounds", sql=f"SELECT {ROUND_COLS} FROM prg WHERE group_ok", ctes=PARSE_ROUNDS_SQL)
def job_rounds(spark, sf_dir):
    clean, _ = I.job_rounds(dom(spark, sf_dir))
    return clean


@query("win_all_or_nothing", sql="""
SELECT match_id, map_id, CAST(count(*) AS BIGINT) AS n_rows, CAST(bool_and(row_ok) AS INTEGER) AS kept
FROM prv GROUP BY match_id, map_id""", ctes=PARSE_ROUNDS_SQL)
def win_all_or_nothing(spark, sf_dir):
    """Per map: rows and whether the map's rounds were kept (one bad round
    rejects the whole map)."""
    clean, bad = I.job_rounds(dom(spark, sf_dir))
    k = clean.select("match_id", "map_id", F.lit(1).alias("kept"))
    b = bad.select("match_id", "map_id", F.lit(0).alias("kept"))
    return k.unionByName(b).groupBy("match_id", "map_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("kept").alias("kept"))


@query("inc_quarantine", sql=f"SELECT {ROUND_COLS}, t1_bank_txt FROM prg WHERE NOT group_ok", ctes=PARSE_ROUNDS_SQL)
def inc_quarantine(spark, sf_dir):
    """Rounds of rejected maps kept apart with their raw text (the rest continue)."""
    bad = I.round_rejects(dom(spark, sf_dir)).withColumnRenamed("raw_t1_bank_txt", "t1_bank_txt")
    return bad.drop("_row_ok", "raw_t2_bank_txt", "raw_win_img")


ERR_SQL = f"""v AS (
  SELECT match_id, map_id, round_no, t1_bank_txt, unnest([
    CASE WHEN team_def IS NULL THEN 'team_def' END, CASE WHEN team_1_buy_type IS NULL THEN 'team_1_buy_type' END,
    CASE WHEN team_2_buy_type IS NULL THEN 'team_2_buy_type' END, CASE WHEN team_1_bank IS NULL THEN 'team_1_bank' END,
    CASE WHEN team_2_bank IS NULL THEN 'team_2_bank' END, CASE WHEN team_won IS NULL THEN 'team_won' END,
    CASE WHEN won_method IS NULL THEN 'won_method' END]) AS rule FROM prd)"""


@query("agg_error_summary", sql="""
SELECT rule, CAST(count(*) AS BIGINT) AS n_failures,
  arg_max(concat(match_id, ':', map_id, ':', round_no, ' ', t1_bank_txt), (match_id * 100 + map_id) * 100 + round_no) AS last_error
FROM v WHERE rule IS NOT NULL GROUP BY rule""", ctes=PARSE_ROUNDS_SQL + ",\n" + ERR_SQL)
def agg_error_summary(spark, sf_dir):
    v = I.round_violations(dom(spark, sf_dir))
    v = v.select("rule", ((F.col("match_id") * 100 + F.col("map_id")) * 100 + F.col("round_no")).alias("seq"),
                 F.concat_ws(" ", F.concat_ws(":", "match_id", "map_id", "round_no"), F.col("t1_bank_txt"))
                 .alias("detail"))
    return AG.error_summary(v)


_PAIRED_SQL = """
SELECT coalesce(o.match_id, e.match_id) AS match_id, coalesce(o.map_id, e.map_id) AS map_id, coalesce(o.pos, e.pos)::INT AS pos,
  o.win_class, e.t1_bank_txt, CASE WHEN o.pos IS NULL THEN 'overview' WHEN e.pos IS NULL THEN 'economy' END AS missing
FROM g_raw_overview_cells o FULL JOIN g_raw_economy_cells e ON e.match_id = o.match_id AND e.map_id = o.map_id AND e.pos = o.pos"""


@query("join_positional", sql=_PAIRED_SQL)
def join_positional(spark, sf_dir):
    """The i-th overview cell with the i-th economy cell of a map, two
    fragments of their own length: a full pairing on (match, map, position), so
    a cell that either fragment lacks is named and not shifted (ledger Q21)."""
    d = dom(spark, sf_dir)
    return I.pair_cells(d.raw_overview_cells, d.raw_economy_cells, ["match_id", "map_id", "pos"], "overview", "economy")


@query("join_positional_violations", sql=f"""
SELECT match_id, map_id, missing, count(*) AS n_cells, min(pos) AS first_pos FROM ({_PAIRED_SQL}) WHERE missing IS NOT NULL
GROUP BY match_id, map_id, missing""")
def join_positional_violations(spark, sf_dir):
    """Per map and fragment: how many cells it lacks, and the first of them."""
    paired = join_positional(spark, sf_dir).where("missing is not null")
    return paired.groupBy("match_id", "map_id", "missing").agg(F.count("*").alias("n_cells"), F.min("pos").alias("first_pos"))


# ------------------------------------------------------------------ player stats
SIDE_ROUNDS_SQL = """sr AS (
  SELECT match_id, map_id, team_1_id AS team_id,
    team_1_def_score + team_2_atk_score + CAST(floor((team_1_ot_score + team_2_ot_score) / 2) AS BIGINT) AS def_rounds,
    team_1_atk_score + team_2_def_score + CAST(floor((team_1_ot_score + team_2_ot_score) / 2) AS BIGINT) AS atk_rounds
  FROM g_match_maps
  UNION ALL
  SELECT match_id, map_id, team_2_id,
    team_2_def_score + team_1_atk_score + CAST(floor((team_1_ot_score + team_2_ot_score) / 2) AS BIGINT),
    team_2_atk_score + team_1_def_score + CAST(floor((team_1_ot_score + team_2_ot_score) / 2) AS BIGINT)
  FROM g_match_maps)"""


@query("f_side_rounds", sql="SELECT * FROM sr", ctes=SIDE_ROUNDS_SQL)
def f_side_rounds(spark, sf_dir):
    return I.side_rounds_of_team(dom(spark, sf_dir))


def _ok(d, a, b):
    return f"(({d} IS NOT NULL AND {a} IS NOT NULL) OR ({b} IS NOT NULL AND ({d} IS NOT NULL OR {a} IS NOT NULL)))"


def _solve(both, other, other_w, own_w, dw, aw):
    return (f"greatest(CASE WHEN {own_w} = 0 THEN 0.0 ELSE (CAST({both} AS DOUBLE) * CAST({dw} + {aw} AS DOUBLE) "
            f"- CAST({other_w} AS DOUBLE) * CAST({other} AS DOUBLE)) / CAST({own_w} AS DOUBLE) END, 0.0)")


def _fill_sql() -> str:
    """fk: filled counts and per-round statistics; fh: headshots by filled
    kills; fp: with the agent; fm: with the verdict on the match."""
    cells, gaps = [], []
    for s in COUNT_STATS + I.ROUND_STATS:
        d, a, b = f"r.def_{s}", f"r.atk_{s}", f"r.both_{s}"
        if s in COUNT_STATS:
            dv, av = f"coalesce({d}, greatest({b} - {a}, 0))", f"coalesce({a}, greatest({b} - {d}, 0))"
        else:
            rounds = "sr.def_rounds", "sr.atk_rounds"
            dv = f"round(coalesce(CAST({d} AS DOUBLE), {_solve(b, a, *rounds[::-1], *rounds)}), 6)"
            av = f"round(coalesce(CAST({a} AS DOUBLE), {_solve(b, d, *rounds, *rounds)}), 6)"
        cells += [f"CASE WHEN {_ok(d, a, b)} THEN {v} END AS {side}_{s}" for side, v in (("def", dv), ("atk", av))]
        gaps.append(f"CASE WHEN NOT {_ok(d, a, b)} THEN '{s}' END")
    names = ", ".join(f"{side}_{s}" for s in COUNT_STATS + I.ROUND_STATS for side in ("def", "atk"))
    hs = _ok("hs_def", "hs_atk", "both_hs")
    solved = {"def": _solve("both_hs", "hs_atk", "atk_kills", "def_kills", "def_kills", "atk_kills"),
              "atk": _solve("both_hs", "hs_def", "def_kills", "atk_kills", "def_kills", "atk_kills")}
    hs_cells = ", ".join(f"round(CASE WHEN {hs} THEN coalesce(CAST(hs_{side} AS DOUBLE), {v}) END, 6) AS {side}_hs"
                         for side, v in solved.items())
    return f"""fk AS (
  SELECT r.match_id, r.map_id, r.team_id, r.player_id, r.agent_name, r.def_hs AS hs_def, r.atk_hs AS hs_atk, r.both_hs,
    {", ".join(cells)}, concat_ws(',', {", ".join(gaps)}) AS gaps
  FROM g_raw_player_stats r LEFT JOIN sr ON sr.match_id = r.match_id AND sr.map_id = r.map_id AND sr.team_id = r.team_id),
fh AS (
  SELECT match_id, map_id, team_id, player_id, agent_name, {names}, {hs_cells},
    concat_ws(',', nullif(gaps, ''), CASE WHEN NOT {hs} THEN 'hs' END) AS failed
  FROM fk),
fp AS (
  SELECT fh.* EXCLUDE (failed), a.id AS agent_id,
    concat_ws(',', nullif(failed, ''), CASE WHEN a.id IS NULL THEN 'agent' END) AS failed
  FROM fh LEFT JOIN g_agents a ON a.name = fh.agent_name),
fm AS (SELECT *, bool_and(failed = '') OVER (PARTITION BY match_id) AS match_ok FROM fp)"""


FILL_SQL = _fill_sql()


def _filled(stats) -> list[str]:
    return [*I.PLAYER_KEYS, *(f"{side}_{s}" for s in stats for side in ("def", "atk"))]


@query("f_fill_kda", sql=f"SELECT {', '.join(_filled(COUNT_STATS))} FROM fh", ctes=SIDE_ROUNDS_SQL + ",\n" + FILL_SQL)
def f_fill_kda(spark, sf_dir):
    return I.fill_player_stats(dom(spark, sf_dir)).select(_filled(COUNT_STATS))


@query("f_fill_per_round", sql=f"SELECT {', '.join(_filled(I.ROUND_STATS))} FROM fh",
       ctes=SIDE_ROUNDS_SQL + ",\n" + FILL_SQL)
def f_fill_per_round(spark, sf_dir):
    return I.fill_player_stats(dom(spark, sf_dir)).select(_filled(I.ROUND_STATS))


@query("f_fill_per_kill", sql="""
SELECT match_id, map_id, team_id, player_id, def_hs, atk_hs, CAST(failed = '' AS INTEGER) AS ok FROM fh""",
       ctes=SIDE_ROUNDS_SQL + ",\n" + FILL_SQL)
def f_fill_per_kill(spark, sf_dir):
    return I.fill_player_stats(dom(spark, sf_dir)).select(
        *_filled(["hs"]), (F.size("failed") == 0).cast("int").alias("ok"))


_SIDES_SQL = "\nUNION ALL\n".join(
    f"SELECT match_id, map_id, team_id, player_id, agent_id, '{side}' AS side, "
    + ", ".join(f"{side}_{s} AS {s}" for s in I.PLAYER_STATS) + " FROM fm WHERE match_ok" for side in ("def", "atk"))


@query("job_player_stats", sql=_SIDES_SQL, ctes=SIDE_ROUNDS_SQL + ",\n" + FILL_SQL)
def job_player_stats(spark, sf_dir):
    rows, _ = I.job_player_stats(dom(spark, sf_dir))
    return rows


@query("job_player_stats_rejected", sql="""
SELECT match_id, map_id, team_id, player_id, failed FROM fm WHERE NOT match_ok""",
       ctes=SIDE_ROUNDS_SQL + ",\n" + FILL_SQL)
def job_player_stats_rejected(spark, sf_dir):
    """Players of rejected matches with what failed (empty for sound ones)."""
    _, rejected = I.job_player_stats(dom(spark, sf_dir))
    return rejected


# ------------------------------------------------------------------ duels
DUEL_GRID_SQL = """dg AS (
  SELECT g.*, h1.row_name, h2.col_name, mm.team_1_id, mm.team_2_id, r1.player_id AS team_1_player_id,
    r2.player_id AS team_2_player_id
  FROM g_raw_duel_grid g
  JOIN g_raw_duel_headers h1 ON h1.match_id = g.match_id AND h1.map_id = g.map_id AND h1.pos = g.i
  JOIN g_raw_duel_headers h2 ON h2.match_id = g.match_id AND h2.map_id = g.map_id AND h2.pos = g.j
  JOIN g_match_maps mm ON mm.match_id = g.match_id AND mm.map_id = g.map_id
  LEFT JOIN g_roster r1 ON r1.match_id = g.match_id AND r1.map_id = g.map_id AND r1.team_id = mm.team_1_id AND r1.name = h1.row_name
  LEFT JOIN g_roster r2 ON r2.match_id = g.match_id AND r2.map_id = g.map_id AND r2.team_id = mm.team_2_id AND r2.name = h2.col_name)"""


@query("join_duel_grid", sql="""
SELECT match_id, map_id, i, j, row_name, col_name, team_1_player_id, team_2_player_id, kills_txt FROM dg""",
       ctes=DUEL_GRID_SQL)
def join_duel_grid(spark, sf_dir):
    return I.join_duel_grid(dom(spark, sf_dir)).select(
        "match_id", "map_id", "i", "j", "row_name", "col_name", "team_1_player_id", "team_2_player_id", "kills_txt")


def _cell_sql(col, idx):
    part = f"string_split_regex({S.strip(col)}, '\\s+')[{idx + 1}]"
    return f"CAST(CASE WHEN {S.strip(col)} = '' THEN 0 ELSE {S.to_int(part)} END AS BIGINT)"


_DUEL_COLS = ", ".join(f"{_cell_sql(f'{c}_txt', 0)} AS team_1_player_{c}_vs_team_2_player, "
                       f"{_cell_sql(f'{c}_txt', 1)} AS team_2_player_{c}_vs_team_1_player"
                       for c in ("kills", "first_kills", "op_kills"))


DUELS_CTES = DUEL_GRID_SQL + f""",
dr AS (SELECT match_id, map_id, team_1_player_id, team_2_player_id, {_DUEL_COLS} FROM dg),
dk AS (SELECT match_id, map_id FROM dr GROUP BY match_id, map_id
       HAVING bool_and(team_1_player_id IS NOT NULL AND team_2_player_id IS NOT NULL
         AND team_1_player_kills_vs_team_2_player IS NOT NULL AND team_2_player_kills_vs_team_1_player IS NOT NULL
         AND team_1_player_first_kills_vs_team_2_player IS NOT NULL AND team_2_player_first_kills_vs_team_1_player IS NOT NULL
         AND team_1_player_op_kills_vs_team_2_player IS NOT NULL AND team_2_player_op_kills_vs_team_1_player IS NOT NULL))"""


@query("job_duels", sql="SELECT dr.* FROM dr JOIN dk USING (match_id, map_id)", ctes=DUELS_CTES)
def job_duels(spark, sf_dir):
    return I.job_duels(dom(spark, sf_dir))


@query("f_default_blank", sql=f"""
SELECT match_id, map_id, i, j, {_cell_sql('op_kills_txt', 0)} AS op_kills_row, {_cell_sql('op_kills_txt', 1)} AS op_kills_col
FROM g_raw_duel_grid""")
def f_default_blank(spark, sf_dir):
    g = RV.raw_duel_grid(dom(spark, sf_dir))
    return g.select("match_id", "map_id", "i", "j", I._cell_part(F.col("op_kills_txt"), 0).alias("op_kills_row"),
                    I._cell_part(F.col("op_kills_txt"), 1).alias("op_kills_col"))


# ------------------------------------------------------------------ highlights
HL_SQL = """hc AS (
  SELECT c.match_id, c.map_id, c.round_no, c.highlight_type, c.owner_txt,
    CASE WHEN c.pos BETWEEN 0 AND 4 THEN mm.team_1_id WHEN c.pos BETWEEN 5 AND 9 THEN mm.team_2_id END AS team_id,
    CASE WHEN c.pos BETWEEN 0 AND 4 THEN mm.team_2_id WHEN c.pos BETWEEN 5 AND 9 THEN mm.team_1_id END AS opp_team_id,
    regexp_replace(unnest(string_split(c.opponents_txt, ',')), '^\\s+|\\s+$', '', 'g') AS opp_txt
  FROM g_raw_highlight_cells c JOIN g_match_maps mm ON mm.match_id = c.match_id AND mm.map_id = c.map_id)"""


HIGHLIGHTS_CTES = HL_SQL + """,
hj AS (SELECT hc.match_id, hc.map_id, hc.round_no, hc.team_id, o.player_id, hc.highlight_type,
    coalesce(a.player_id, 0) AS player_against_id
  FROM hc LEFT JOIN g_roster o ON o.match_id = hc.match_id AND o.map_id = hc.map_id AND o.team_id = hc.team_id AND o.name = hc.owner_txt
  LEFT JOIN g_roster a ON a.match_id = hc.match_id AND a.map_id = hc.map_id AND a.team_id = hc.opp_team_id AND a.name = hc.opp_txt),
hk AS (SELECT match_id, map_id FROM hj GROUP BY match_id, map_id HAVING bool_and(player_id IS NOT NULL)),
jh AS (SELECT hj.* FROM hj JOIN hk USING (match_id, map_id))"""


@query("job_highlights", sql="SELECT * FROM jh", ctes=HIGHLIGHTS_CTES)
def job_highlights(spark, sf_dir):
    return I.job_highlights(dom(spark, sf_dir))


@query("join_name_id", sql="""
SELECT DISTINCT hc.match_id, hc.map_id, hc.team_id, hc.owner_txt, o.player_id
FROM hc LEFT JOIN g_roster o ON o.match_id = hc.match_id AND o.map_id = hc.map_id AND o.team_id = hc.team_id
  AND o.name = hc.owner_txt""", ctes=HL_SQL)
def join_name_id(spark, sf_dir):
    d = dom(spark, sf_dir)
    cells = RV.raw_highlight_cells(d).join(d.match_maps.select("match_id", "map_id", "team_1_id", "team_2_id"),
                                           ["match_id", "map_id"])
    c = cells.select("match_id", "map_id", "owner_txt",
                     slot_team(F.col("pos"), F.col("team_1_id"), F.col("team_2_id")).alias("team_id")).distinct()
    ro = RV.roster(d).withColumnRenamed("name", "owner_txt")
    return c.join(ro, ["match_id", "map_id", "team_id", "owner_txt"], "left") \
            .select("match_id", "map_id", "team_id", "owner_txt", "player_id")


@query("win_slot", sql="""
SELECT DISTINCT c.match_id, c.map_id, c.pos,
  CASE WHEN c.pos BETWEEN 0 AND 4 THEN mm.team_1_id WHEN c.pos BETWEEN 5 AND 9 THEN mm.team_2_id END AS team_id
FROM g_raw_highlight_cells c JOIN g_match_maps mm ON mm.match_id = c.match_id AND mm.map_id = c.map_id""")
def win_slot(spark, sf_dir):
    d = dom(spark, sf_dir)
    c = RV.raw_highlight_cells(d).join(d.match_maps.select("match_id", "map_id", "team_1_id", "team_2_id"),
                                       ["match_id", "map_id"])
    return c.select("match_id", "map_id", "pos",
                    slot_team(F.col("pos"), F.col("team_1_id"), F.col("team_2_id")).alias("team_id")).distinct()


# ------------------------------------------------------------------ vetoes
VETO_SQL = """vt AS (
  SELECT match_id, team_1_id, team_2_id, t1_short, t2_short, unnest(string_split(note, ';')) AS turn,
    generate_subscripts(string_split(note, ';'), 1) AS pos FROM g_veto_notes),
vw AS (SELECT *, string_split_regex(regexp_replace(turn, '^\\s+|\\s+$', '', 'g'), '\\s+') AS w FROM vt),
vp AS (
  SELECT match_id, CAST(pos AS BIGINT) AS veto_order,
    CASE WHEN len(w) = 3 AND w[1] = t1_short THEN team_1_id WHEN len(w) = 3 AND w[1] = t2_short THEN team_2_id END AS team_id,
    CASE WHEN len(w) = 3 AND w[2] IN ('ban', 'pick') THEN w[2] WHEN len(w) = 2 AND w[2] IN ('remains', 'remain') THEN 'remain' END AS veto_action,
    CASE WHEN len(w) = 3 THEN w[3] WHEN len(w) = 2 THEN w[1] END AS map_name
  FROM vw),
vj AS (
  SELECT vp.match_id, vp.team_id, vp.veto_order, mp.id AS map_id, vp.veto_action,
    CAST(row_number() OVER (PARTITION BY vp.match_id, vp.veto_action ORDER BY vp.veto_order) AS BIGINT) AS ban_pick_order
  FROM vp LEFT JOIN g_maps mp ON mp.name = vp.map_name)"""


@query("job_vetoes", sql="SELECT * FROM vj", ctes=VETO_SQL)
def job_vetoes(spark, sf_dir):
    return _big(I.job_vetoes(dom(spark, sf_dir)), {"veto_order", "ban_pick_order"})


@query("win_veto_order", sql="SELECT match_id, veto_order, veto_action, ban_pick_order FROM vj", ctes=VETO_SQL)
def win_veto_order(spark, sf_dir):
    v = I.job_vetoes(dom(spark, sf_dir))
    return _big(v.select("match_id", "veto_order", "veto_action", "ban_pick_order"), {"veto_order", "ban_pick_order"})


# ------------------------------------------------------------------ dimensions
def _geo_sql(name: str, src: str, col: str, by: str) -> str:
    return (f"{name} AS (SELECT p.place, arg_min(g.country, g.row_no) AS country, arg_min(g.continent, g.row_no) AS continent "
            f"FROM (SELECT DISTINCT {col} AS place FROM {src} WHERE {col} IS NOT NULL AND {S.strip(col)} != '') p "
            f"JOIN g_geo g ON contains({S.snake(f'g.{by}')}, {S.snake('p.place')}) GROUP BY p.place)")


TEAMS_SQL = f"""
SELECT t.id, t.name, {S.short_name('t.name', 't.shorthand_txt')} AS shorthand_name, t.url, c.country AS country,
  r.continent AS region
FROM g_raw_teams t LEFT JOIN gc c ON c.place = t.location_txt LEFT JOIN gr r ON r.place = t.location_txt"""
TEAMS_CTES = (_geo_sql("gc", "g_raw_teams", "location_txt", "country") + ",\n"
              + _geo_sql("gr", "g_raw_teams", "location_txt", "continent"))


@query("job_teams", sql=TEAMS_SQL, ctes=TEAMS_CTES)
def job_teams(spark, sf_dir):
    return I.job_teams(dom(spark, sf_dir))


@query("join_geo_contains", sql="SELECT place, country, continent FROM gc", ctes=TEAMS_CTES)
def join_geo_contains(spark, sf_dir):
    d = dom(spark, sf_dir)
    g = I.geo_lookup(RV.raw_teams(d), d, "location_txt", "country")
    return g.select(F.col("location_txt").alias("place"), F.col("country_country").alias("country"),
                    F.col("country_continent").alias("continent"))


@query("job_players", sql="""
SELECT p.id, p.name, p.url, c.country FROM g_raw_players p LEFT JOIN gc c ON c.place = p.country_txt""",
       ctes=_geo_sql("gc", "g_raw_players", "country_txt", "country"))
def job_players(spark, sf_dir):
    return I.job_players(dom(spark, sf_dir))


@query("job_tournaments", sql=f"""
SELECT id, name, url, {S.prize('prize_txt')} AS prize_pool, {S.tier_1('group_href', S.prize('prize_txt'))} AS tier_1
FROM g_raw_tournaments""")
def job_tournaments(spark, sf_dir):
    return I.job_tournaments(dom(spark, sf_dir))


@query("job_dim_upsert", sql=f"""
WITH ex AS (SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, n_name AS name FROM nation
       WHERE n_regionkey < (SELECT max(n_regionkey) FROM nation)),
nw AS (SELECT DISTINCT country AS name FROM ({TEAMS_SQL}) WHERE country IS NOT NULL
       AND country NOT IN (SELECT name FROM ex))
SELECT id, name FROM ex
UNION ALL SELECT CAST((SELECT max(id) FROM ex) + row_number() OVER (ORDER BY name) AS BIGINT), name FROM nw""",
       ctes=TEAMS_CTES)
def job_dim_upsert(spark, sf_dir):
    return I.job_dim_upsert(dom(spark, sf_dir))


_DIM_CTES = TEAMS_CTES + ",\n" + _geo_sql("gp", "g_raw_players", "country_txt", "country") + f""",
tm AS ({TEAMS_SQL}),
pl AS (SELECT p.id, p.name, p.url, c.country FROM g_raw_players p LEFT JOIN gp c ON c.place = p.country_txt),
ex AS (SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, n_name AS name FROM nation
       WHERE n_regionkey < (SELECT max(n_regionkey) FROM nation)),
cn AS (SELECT name FROM ex UNION SELECT country FROM tm WHERE country IS NOT NULL
       UNION SELECT country FROM pl WHERE country IS NOT NULL),
rex AS (SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, r_name AS name FROM region
        WHERE r_regionkey < (SELECT max(r_regionkey) FROM region)),
rn AS (SELECT region AS name FROM tm WHERE region IS NOT NULL
       UNION SELECT g.continent FROM cn JOIN g_geo g ON g.country = cn.name),
rg AS (SELECT id, name FROM rex UNION ALL
       SELECT CAST((SELECT max(id) FROM rex) + row_number() OVER (ORDER BY name) AS BIGINT), name
       FROM rn WHERE name NOT IN (SELECT name FROM rex)),
co AS (SELECT c.id, c.name, rg.id AS region_id FROM (SELECT id, name FROM ex UNION ALL
       SELECT CAST((SELECT max(id) FROM ex) + row_number() OVER (ORDER BY name) AS BIGINT), name
       FROM cn WHERE name NOT IN (SELECT name FROM ex)) c
       LEFT JOIN g_geo g ON g.country = c.name LEFT JOIN rg ON rg.name = g.continent)"""


@query("dim_regions", sql="SELECT id, name FROM rg", ctes=_DIM_CTES)
def dim_regions(spark, sf_dir):
    return DM.regions(dom(spark, sf_dir))


@query("dim_countries", sql="SELECT id, name, region_id FROM co", ctes=_DIM_CTES)
def dim_countries(spark, sf_dir):
    return DM.countries(dom(spark, sf_dir))


@query("job_teams_ids", sql="""
SELECT t.id, t.name, t.shorthand_name, t.url, co.id AS country_id, rg.id AS region_id
FROM tm t LEFT JOIN co ON co.name = t.country LEFT JOIN rg ON rg.name = t.region""", ctes=_DIM_CTES)
def job_teams_ids(spark, sf_dir):
    return DM.teams_with_ids(dom(spark, sf_dir))


@query("job_players_ids", sql="""
SELECT p.id, p.name, p.url, co.id AS country_id FROM pl p LEFT JOIN co ON co.name = p.country""", ctes=_DIM_CTES)
def job_players_ids(spark, sf_dir):
    return DM.players_with_ids(dom(spark, sf_dir))


# ------------------------------------------------------------------ listing
@query("job_listing", sql=f"""
SELECT url, CAST({S.listing_date('header')} AS VARCHAR) AS date FROM (
  SELECT kind, txt AS url, last_value(CASE WHEN kind = 'date' THEN txt END IGNORE NULLS)
    OVER (PARTITION BY page_no ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header
  FROM g_raw_listing) WHERE kind = 'link'""")
def job_listing(spark, sf_dir):
    df = I.job_listing(dom(spark, sf_dir))
    return df.withColumn("date", F.col("date").cast("string"))


# ------------------------------------------------------------------ data quality
@query("dq_checks", sql="""
SELECT 'round_stats' AS table_name, concat(match_id, ':', map_id, ':', round_no) AS row_key, rule FROM (
  SELECT match_id, map_id, round_no, unnest([
    CASE WHEN team_1_bank IS NULL THEN 'team_1_bank not null' END,
    CASE WHEN team_2_bank IS NULL THEN 'team_2_bank not null' END,
    CASE WHEN team_1_bank < 0 THEN 'team_1_bank >= 0' END,
    CASE WHEN round_no <= 0 THEN 'round_no > 0' END,
    CASE WHEN team_1_buy_type NOT IN ('pistol', 'eco', 'semi_eco', 'semi_buy', 'full_buy') THEN 'team_1_buy_type enum' END,
    CASE WHEN won_method NOT IN ('eliminate', 'spike_explode', 'defuse', 'out_of_time') THEN 'won_method enum' END,
    CASE WHEN team_def NOT IN (team_1_id, team_2_id) THEN 'team_def in teams' END]) AS rule FROM prd)
WHERE rule IS NOT NULL
UNION ALL
SELECT 'player_overview_stats', concat(match_id, ':', map_id, ':', player_id, ':', side), rule FROM (
  SELECT match_id, map_id, player_id, side, unnest([
    CASE WHEN side NOT IN ('def', 'atk') THEN 'side enum' END,
    CASE WHEN rating < 0 THEN 'rating >= 0' END,
    CASE WHEN kast < 0 OR kast > 100 THEN 'kast in 0..100' END,
    CASE WHEN hs < 0 OR hs > 100 THEN 'hs in 0..100' END]) AS rule FROM g_player_overview_stats)
WHERE rule IS NOT NULL
UNION ALL
SELECT 'ban_pick_log', concat(match_id, ':', veto_order), rule FROM (
  SELECT match_id, veto_order, unnest([
    CASE WHEN veto_action IS NULL THEN 'veto_action enum' END,
    CASE WHEN map_id IS NULL THEN 'map_id not null' END,
    CASE WHEN veto_action IN ('ban', 'pick') AND team_id IS NULL THEN 'team_id for ban/pick' END]) AS rule FROM vj)
WHERE rule IS NOT NULL""", ctes=PARSE_ROUNDS_SQL + ",\n" + VETO_SQL)
def dq_checks(spark, sf_dir):
    d = dom(spark, sf_dir)
    return Q.dq_checks(I.parse_rounds(d), d.player_overview_stats, I.job_vetoes(d))


_PARENTS = {"tournaments": "g_raw_tournaments", "teams": "g_raw_teams", "players": "g_raw_players", "maps": "g_maps",
            "agents": "g_agents", "matches": "g_matches", "agent names": "g_agents"}


def _keys_sql() -> str:
    parts = [f"SELECT DISTINCT '{t}.{c} -> {p}' AS check_name, CAST({c} AS VARCHAR) AS row_key FROM g_{t} WHERE {c} IS NOT NULL "
             f"AND {c} NOT IN (SELECT {'name' if p == 'agent names' else 'id'} FROM {_PARENTS[p]})"
             for t, cols in FOREIGN_KEYS.items() for c, p in cols.items()]
    unique = [("matches", ["url"])] + [(t, KEYS[t]) for t in FOREIGN_KEYS if t in KEYS]
    parts += [f"SELECT '{t} ({', '.join(k)}) unique', concat_ws(':', {', '.join(k)}) FROM g_{t} GROUP BY {', '.join(k)} "
              "HAVING count(*) > 1" for t, k in unique]
    return "\nUNION ALL\n".join(parts)


@query("dq_keys", sql=_keys_sql())
def dq_keys(spark, sf_dir):
    d = dom(spark, sf_dir)
    return Q.dq_keys(d)


# ------------------------------------------------------------------ one violations store
def _failed_sql(fields) -> str:
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in fields) + ")"


_DUEL_FIELDS = ["team_1_player_id", "team_2_player_id",
                *[f"team_{t}_player_{c}_vs_team_{3 - t}_player" for c in I.DUEL_CELLS for t in (1, 2)]]
REJECTS_CTES = f"""{PARSE_ROUNDS_SQL},
{SIDE_ROUNDS_SQL},
{FILL_SQL},
{DUELS_CTES},
drr AS (SELECT match_id, map_id, team_1_player_id, team_2_player_id, {_DUEL_COLS},
          concat_ws('|', i, j, row_name, col_name, kills_txt, first_kills_txt, op_kills_txt) AS raw FROM dg),
{HIGHLIGHTS_CTES},
hcell AS (SELECT c.match_id, c.map_id, o.player_id,
            concat_ws('|', c.round_no, c.highlight_type, c.pos, c.owner_txt, c.opponents_txt) AS raw
          FROM g_raw_highlight_cells c JOIN g_match_maps mm ON mm.match_id = c.match_id AND mm.map_id = c.map_id
          LEFT JOIN g_roster o ON o.match_id = c.match_id AND o.map_id = c.map_id AND o.name = c.owner_txt
            AND o.team_id = CASE WHEN c.pos BETWEEN 0 AND 4 THEN mm.team_1_id WHEN c.pos BETWEEN 5 AND 9 THEN mm.team_2_id END)"""
REJECTS_SQL = f"""
SELECT 'rounds' AS job, 'map' AS scope, match_id, map_id, {_failed_sql(I.ROUND_FIELDS)} AS failed, raw FROM prg WHERE NOT group_ok
UNION ALL
SELECT 'player_stats', 'match', match_id, map_id, failed, concat_ws('|', team_id, player_id) FROM fm WHERE NOT match_ok
UNION ALL
SELECT 'duels', 'map', match_id, map_id, {_failed_sql(_DUEL_FIELDS)}, raw FROM drr ANTI JOIN dk USING (match_id, map_id)
UNION ALL
SELECT 'highlights', 'map', match_id, map_id, CASE WHEN player_id IS NULL THEN 'player_id' ELSE '' END, raw
FROM hcell ANTI JOIN hk USING (match_id, map_id)"""


@query("inc_violations", sql=REJECTS_SQL, ctes=REJECTS_CTES)
def inc_violations(spark, sf_dir):
    """Every row that any job rejected, with scope, failed fields and raw text."""
    return I.rejects(dom(spark, sf_dir))


@query("inc_violations_summary", sql=f"""
SELECT job, scope, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT match_id * 100 + map_id) AS BIGINT) AS n_maps,
  CAST(count(*) FILTER (WHERE failed <> '') AS BIGINT) AS n_failed FROM ({REJECTS_SQL}) GROUP BY job, scope""", ctes=REJECTS_CTES)
def inc_violations_summary(spark, sf_dir):
    """Per job: rejected rows, their maps, and the rows that themselves failed."""
    return I.rejects(dom(spark, sf_dir)).groupBy("job", "scope").agg(
        F.count("*").alias("n_rows"), F.countDistinct(F.col("match_id") * 100 + F.col("map_id")).alias("n_maps"),
        F.count_if(F.col("failed") != "").alias("n_failed"))


# ------------------------------------------------------------------ rules from the schemas
# Table -> (its rows, columns, seed of the planted violations, one row in so many for each rule).
_CHECKED = {
    "matches": ("g_matches", "id", 997), "match_maps": ("g_match_maps", "match_id * 3 + map_id", 997),
    "round_stats": ("g_round_stats", "match_id * 31 + map_id * 7 + round_no", 997),
    "players_duel_stats": ("g_players_duel_stats", "match_id + map_id + team_1_player_id * 5 + team_2_player_id * 3", 997),
    "player_overview_stats": ("g_player_overview_stats", "match_id + map_id * 3 + player_id * 7", 997),
    "player_highlights": ("g_player_highlights", "match_id * 3 + map_id + round_no * 5 + player_id", 997),
    "ban_pick_log": ("vj", "match_id * 7 + veto_order", 997), "agents": ("g_agents", "id", 5),
}


def _declared_columns(table: str) -> list[str]:
    """The declared columns that the domain's view of the table has."""
    return [f.name for f in SCHEMAS[table].fields if (table, f.name) != ("agents", "release_date")]


def _rules_sql() -> str:
    parts = []
    for table, (view, seed, modulus) in _CHECKED.items():
        rules = rules_of(table, _declared_columns(table))
        soiled: dict[str, str] = {}
        for i, (_, c, _, bad) in enumerate(rules):
            soiled[c] = f"CASE WHEN seed % {modulus} = {i} THEN {bad} ELSE {soiled.get(c, c)} END"
        cols = ", ".join(f"{soiled.get(c, c)} AS {c}" for c in _declared_columns(table))
        found = ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, _, bad, _ in rules)
        parts.append(f"SELECT '{table}' AS table_name, rule, CAST(count(*) AS BIGINT) AS n_rows, CAST(min(seed) AS BIGINT) AS least_seed "
                     f"FROM (SELECT seed, unnest([{found}]) AS rule FROM (SELECT seed, {cols} FROM (SELECT *, {seed} AS seed FROM {view}))) "
                     "WHERE rule IS NOT NULL GROUP BY rule")
    return "\nUNION ALL\n".join(parts)


@query("dq_rules", sql=_rules_sql(), ctes=VETO_SQL)
def dq_rules(spark, sf_dir):
    """Every rule that the schemas declare (not null, ranges, enumerations) on
    eight tables, with a planted violation of each: rows per rule, one pass a table."""
    d = dom(spark, sf_dir)
    out = None
    for table, (_, seed, modulus) in _CHECKED.items():
        df = I.job_vetoes(d) if table == "ban_pick_log" else getattr(d, table)
        found = Q.declared_violations(Q.soiled(df.select(*_declared_columns(table)), table, seed, modulus), table, ["seed"])
        out = found if out is None else out.unionByName(found)
    return out.groupBy("table_name", "rule").agg(F.count("*").alias("n_rows"), F.min("seed").cast("long").alias("least_seed"))
