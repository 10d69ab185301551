"""Queries for the feature jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from skirmish.operators.ranges import opened
from skirmish.plans import features as FT
from skirmish.plans import rules_sql as S
from skirmish.plans.registry import dom, query
from skirmish.plans.sqlparts import (FLIP_ROUNDS, PLAYERS_ROLE, TEAM_ROWS, composition_sql, player_features_sql,
                                     text_arrays)

_CLUTCH_IN = "('1v1', '1v2', '1v3', '1v4', '1v5')"


def _thrifty(a: str, b: str) -> str:
    return f"(({a} = 'eco' AND {b} IN ('semi_buy', 'full_buy')) OR ({a} = 'semi_eco' AND {b} = 'full_buy'))"


_METHOD_FLAGS = ",\n  ".join(
    f"CAST(fr.won = 1 AND fr.won_method = '{m}' AS INT) AS won_buy_{t}, "
    f"CAST(fr.won = 0 AND fr.won_method = '{m}' AS INT) AS loss_buy_{t}"
    for t, m in (("elim", "eliminate"), ("spike_explode", "spike_explode"), ("defuse", "defuse"),
                 ("timeout", "out_of_time")))

FEAT_ROUNDS_SQL = f"""
SELECT fr.match_id, fr.map_id, fr.team_id, fr.round_no, fr.def, fr.team_buy_type, fr.team_against_buy_type,
  fr.team_bank, fr.team_against_bank, fr.won,
  {_METHOD_FLAGS},
  CAST(fr.won = 1 AND {_thrifty('fr.team_buy_type', 'fr.team_against_buy_type')} AS INT) AS won_by_thrifty,
  CAST(fr.won = 0 AND {_thrifty('fr.team_against_buy_type', 'fr.team_buy_type')} AS INT) AS loss_by_thrifty,
  CAST(fr.won = 1 AND o.team_id IS NOT NULL AS INT) AS won_buy_clutch,
  CAST(fr.won = 0 AND a.team_id IS NOT NULL AS INT) AS loss_buy_clutch
FROM fr
LEFT JOIN cl o ON o.match_id = fr.match_id AND o.map_id = fr.map_id AND o.round_no = fr.round_no AND o.team_id = fr.team_id
LEFT JOIN cl a ON a.match_id = fr.match_id AND a.map_id = fr.map_id AND a.round_no = fr.round_no AND a.team_id = fr.team_against_id"""
CLUTCH_CTE = f"""{FLIP_ROUNDS},
cl AS (SELECT DISTINCT match_id, map_id, round_no, team_id FROM g_player_highlights WHERE highlight_type IN {_CLUTCH_IN})"""


@query("feat_rounds", sql=FEAT_ROUNDS_SQL, ctes=CLUTCH_CTE)
def feat_rounds(spark, sf_dir):
    return FT.feat_rounds(dom(spark, sf_dir))


@query("feat_players", sql="SELECT * FROM pf", ctes=player_features_sql())
def feat_players(spark, sf_dir):
    return FT.feat_players(dom(spark, sf_dir))


_ROLE_NAMES = [n for n, _ in FT.ROLE_COUNTS]
MATCH_MAPS_SQL = f"""
SELECT f.match_id, f.team_id, f.team_against_id, f.map_id, f.team_def_score, f.team_atk_score, f.team_ot_score,
  f.team_against_def_score, f.team_against_atk_score, f.team_against_ot_score, f.duration,
  o.agents AS team_agents, a.agents AS team_against_agents,
  {", ".join(f"coalesce(o.{n}, 0) AS team_{n}" for n in _ROLE_NAMES)},
  {", ".join(f"coalesce(a.{n}, 0) AS team_against_{n}" for n in _ROLE_NAMES)}
FROM fmm f
LEFT JOIN comp o ON o.match_id = f.match_id AND o.map_id = f.map_id AND o.team_id = f.team_id
LEFT JOIN comp a ON a.match_id = f.match_id AND a.map_id = f.map_id AND a.team_id = f.team_against_id"""
FMM_CTE = """fmm AS (
  SELECT match_id, map_id, duration, team_1_id AS team_id, team_2_id AS team_against_id,
    team_1_def_score AS team_def_score, team_1_atk_score AS team_atk_score, team_1_ot_score AS team_ot_score,
    team_2_def_score AS team_against_def_score, team_2_atk_score AS team_against_atk_score,
    team_2_ot_score AS team_against_ot_score FROM g_match_maps
  UNION ALL
  SELECT match_id, map_id, duration, team_2_id, team_1_id, team_2_def_score, team_2_atk_score, team_2_ot_score,
    team_1_def_score, team_1_atk_score, team_1_ot_score FROM g_match_maps)"""
MATCH_MAPS_CTES = f"{PLAYERS_ROLE},\n{composition_sql('comp', 'match_id, map_id, team_id')},\n{FMM_CTE}"


@query("feat_match_maps", sql=MATCH_MAPS_SQL, ctes=MATCH_MAPS_CTES)
def feat_match_maps(spark, sf_dir):
    return text_arrays(FT.feat_match_maps(dom(spark, sf_dir)))


def _maps_sql(keys: str, on: str) -> tuple[str, str]:
    sql = f"""
SELECT mm.match_id, mm.map_id, mm.team_1_def_score, mm.team_1_atk_score, mm.team_1_ot_score,
  mm.team_2_def_score, mm.team_2_atk_score, mm.team_2_ot_score, mm.duration,
  c1.agents AS team_1_agents, c2.agents AS team_2_agents,
  {", ".join(f"coalesce(c1.{n}, 0) AS team_1_{n}" for n in _ROLE_NAMES)},
  {", ".join(f"coalesce(c2.{n}, 0) AS team_2_{n}" for n in _ROLE_NAMES)}
FROM g_match_maps mm
LEFT JOIN comp c1 ON {on.format(c='c1')} AND c1.team_id = mm.team_1_id
LEFT JOIN comp c2 ON {on.format(c='c2')} AND c2.team_id = mm.team_2_id"""
    return sql, f"{PLAYERS_ROLE},\n{composition_sql('comp', keys)}"


_MAPS_MATCH = _maps_sql("match_id, team_id", "{c}.match_id = mm.match_id")
_MAPS_MAP = _maps_sql("match_id, map_id, team_id", "{c}.match_id = mm.match_id AND {c}.map_id = mm.map_id")


@query("feat_maps", sql=_MAPS_MATCH[0], ctes=_MAPS_MATCH[1])
def feat_maps(spark, sf_dir):
    return text_arrays(FT.feat_maps(dom(spark, sf_dir), scope="match"))


@query("feat_maps_map_scope", sql=_MAPS_MAP[0], ctes=_MAPS_MAP[1])
def feat_maps_map_scope(spark, sf_dir):
    return text_arrays(FT.feat_maps(dom(spark, sf_dir), scope="map"))


DUELS_SQL = """
SELECT match_id, map_id, team_1_player_id AS player_id, team_2_player_id AS opp_id,
  team_1_player_kills_vs_team_2_player AS player_kills_vs_opp, team_2_player_kills_vs_team_1_player AS opp_kills_vs_players,
  team_1_player_first_kills_vs_team_2_player AS player_first_kills_vs_opp, team_2_player_first_kills_vs_team_1_player AS opp_first_kills_vs_players,
  team_1_player_op_kills_vs_team_2_player AS player_op_kills_vs_opp, team_2_player_op_kills_vs_team_1_player AS opp_op_kills_vs_players
FROM g_players_duel_stats
UNION ALL
SELECT match_id, map_id, team_2_player_id, team_1_player_id,
  team_2_player_kills_vs_team_1_player, team_1_player_kills_vs_team_2_player,
  team_2_player_first_kills_vs_team_1_player, team_1_player_first_kills_vs_team_2_player,
  team_2_player_op_kills_vs_team_1_player, team_1_player_op_kills_vs_team_2_player
FROM g_players_duel_stats"""


@query("feat_duels", sql=DUELS_SQL)
def feat_duels(spark, sf_dir):
    return FT.feat_duels(dom(spark, sf_dir))


HISTORY_CTES = f"""{TEAM_ROWS},
tt AS (SELECT id, CAST({S.tier_1('group_href', S.prize('prize_txt'))} AS INTEGER) AS tier FROM g_raw_tournaments),
tm AS (SELECT m.*, tt.tier FROM g_matches m LEFT JOIN tt ON tt.id = m.tournament_id),
tg AS (SELECT id AS target_id, date AS target_date, stage, tier, team_1_id AS team_id, 1 AS side FROM tm
       UNION ALL SELECT id, date, stage, tier, team_2_id, 2 FROM tm),
th AS (SELECT tg.target_id, tg.side, tg.target_date, tg.stage AS target_stage, tg.tier AS target_tier, h.match_id AS history_id,
         h.date AS history_date, h.team_id, h.team_against_id, h.stage, h.team_score, h.team_against_score,
         h.team_rating, h.team_against_rating
       FROM tg JOIN team_rows h ON h.team_id = tg.team_id
         AND h.date >= tg.target_date - INTERVAL 180 DAY AND h.date < tg.target_date)"""


# Windows as ranges: per team (or map) the number of matches before D - 180
# and before D; the sequence queries give the numbers' matches.
RANGE_CTES = f"""{HISTORY_CTES},
last_day AS (SELECT max(date) AS date FROM g_matches),
tnum AS (SELECT team_id, match_id, date, row_number() OVER (PARTITION BY team_id ORDER BY date, match_id) AS seq FROM team_rows),
tday AS (SELECT DISTINCT team_id, date FROM team_rows),
trange AS (SELECT t.team_id, t.date, count(*) FILTER (WHERE h.date < t.date - INTERVAL 180 DAY) AS lo,
             count(*) FILTER (WHERE h.date < t.date) AS hi
           FROM tday t JOIN team_rows h ON h.team_id = t.team_id GROUP BY t.team_id, t.date),
mgame AS (SELECT mm.match_id, mm.map_id, m.date FROM g_match_maps mm JOIN g_matches m ON m.id = mm.match_id),
mday AS (SELECT map_id, date, count(*) AS n FROM mgame GROUP BY map_id, date),
mnum AS (SELECT map_id, match_id, date, row_number() OVER (PARTITION BY map_id ORDER BY date, match_id) AS seq FROM mgame),
mkey AS (SELECT map_id, date AS form_date FROM mday),
mrange AS (SELECT k.map_id, k.form_date, coalesce(sum(x.n) FILTER (WHERE x.date < k.form_date - INTERVAL 180 DAY), 0)::BIGINT AS lo,
             coalesce(sum(x.n) FILTER (WHERE x.date < k.form_date), 0)::BIGINT AS hi
           FROM mkey k JOIN mday x ON x.map_id = k.map_id GROUP BY k.map_id, k.form_date)"""


_HISTORY_SQL = """
SELECT target_id, side, history_id, CAST(history_date AS VARCHAR) AS history_date FROM th"""


@query("join_history", sql=_HISTORY_SQL, ctes=HISTORY_CTES)
def join_history(spark, sf_dir):
    """Every target side joined to its team's matches in the window."""
    d = dom(spark, sf_dir)
    events = FT.team_sequence(d).select("team_id", "seq", "history_id", F.col("history_date").cast("string").alias("history_date"))
    rows = opened(FT.day_history(d, events=events, of=["target_id", "side"]))
    return rows.select("target_id", "side", "history_id", "history_date")


@query("join_history_rows", sql=_HISTORY_SQL, ctes=HISTORY_CTES)
def join_history_rows(spark, sf_dir):
    """The ranges of all targets expanded to their matches."""
    return join_history(spark, sf_dir)


@query("join_history_ranges", sql="""
SELECT tg.target_id, tg.side, tg.team_id, r.lo, r.hi FROM tg JOIN trange r ON r.team_id = tg.team_id AND r.date = tg.target_date""",
       ctes=RANGE_CTES)
def join_history_ranges(spark, sf_dir):
    """Every target side's window as a range of its team's match numbers."""
    return FT.history_ranges(dom(spark, sf_dir)).select("target_id", "side", "team_id", "lo", "hi")


@query("join_history_sequence", sql="SELECT team_id, seq, match_id AS history_id FROM tnum", ctes=RANGE_CTES)
def join_history_sequence(spark, sf_dir):
    return FT.team_sequence(dom(spark, sf_dir)).select("team_id", "seq", "history_id")


_MAP_FORM_SQL = """
SELECT CAST(k.form_date AS VARCHAR) AS form_date, k.map_id, m.match_id AS form_match_id
FROM (SELECT DISTINCT m.date AS form_date, mm.map_id FROM g_match_maps mm JOIN g_matches m ON m.id = mm.match_id) k
JOIN (SELECT mm.match_id, mm.map_id, m.date FROM g_match_maps mm JOIN g_matches m ON m.id = mm.match_id) m
  ON m.map_id = k.map_id AND m.date >= k.form_date - INTERVAL 180 DAY AND m.date < k.form_date"""


@query("join_map_form", sql=_MAP_FORM_SQL)
def join_map_form(spark, sf_dir):
    """Every (date, map) joined to the league maps of its form window."""
    d = dom(spark, sf_dir)
    return FT.map_form(d, text=True).select("form_date", "map_id", "form_match_id")


@query("join_map_form_rows", sql=_MAP_FORM_SQL)
def join_map_form_rows(spark, sf_dir):
    """The form ranges expanded to their league maps."""
    return join_map_form(spark, sf_dir)


@query("join_map_form_ranges", sql="SELECT CAST(form_date AS VARCHAR) AS form_date, map_id, lo, hi FROM mrange", ctes=RANGE_CTES)
def join_map_form_ranges(spark, sf_dir):
    """The form window of every (date, map) as a range of the map's game numbers."""
    return FT.form_ranges(dom(spark, sf_dir)).select(F.col("form_date").cast("string").alias("form_date"), "map_id", "lo", "hi")


@query("join_map_form_sequence", sql="SELECT map_id, seq, match_id AS form_match_id FROM mnum", ctes=RANGE_CTES)
def join_map_form_sequence(spark, sf_dir):
    return FT.map_sequence(dom(spark, sf_dir)).select("map_id", "seq", "form_match_id")


_FORM_CTES = f"{RANGE_CTES},\n{MATCH_MAPS_CTES},\nfm AS ({MATCH_MAPS_SQL})"

# The form range of every map at every date of a match, played that day or not.
DATE_FORMS_CTE = """drange AS (
  SELECT t.date AS form_date, x.map_id,
    coalesce(sum(x.n) FILTER (WHERE x.date < t.date - INTERVAL 180 DAY), 0)::BIGINT AS form_lo,
    coalesce(sum(x.n) FILTER (WHERE x.date < t.date), 0)::BIGINT AS form_hi
  FROM (SELECT DISTINCT date FROM g_matches) t CROSS JOIN mday x GROUP BY t.date, x.map_id)"""

# All features of the maps that the targets reach, with the form's range.
APPEND_SQL = f"""
SELECT th.target_id, th.side, th.history_id, fm.map_id, CAST(th.target_date AS VARCHAR) AS form_date,
  {", ".join(f"fm.{f}" for f in FT.MAP_FEATURES)}, r.form_lo, r.form_hi
FROM th JOIN fm ON fm.match_id = th.history_id AND fm.team_id = th.team_id
JOIN drange r ON r.map_id = fm.map_id AND r.form_date = th.target_date"""


@query("feat_append_maps", sql=APPEND_SQL, ctes=f"{_FORM_CTES},\n{DATE_FORMS_CTE}")
def feat_append_maps(spark, sf_dir):
    """Map features and form ranges for all targets."""
    d = dom(spark, sf_dir)
    return FT.feat_append_maps(d, maps=text_arrays(FT.feat_match_maps(d)), text=True)


APPEND_LONG_SQL = """
SELECT th.target_id, th.side, th.history_id, mm.map_id, CAST(th.target_date AS VARCHAR) AS form_date,
  mm.team_def_score, mm.team_against_def_score, mm.duration
FROM th JOIN fmm mm ON mm.match_id = th.history_id AND mm.team_id = th.team_id"""
APPEND_LONG_CTES = f"{HISTORY_CTES},\n{FMM_CTE}"


@query("feat_append_maps_long", sql=APPEND_LONG_SQL, ctes=APPEND_LONG_CTES)
def feat_append_maps_long(spark, sf_dir):
    """Headline numbers of the maps that all targets reach."""
    d = dom(spark, sf_dir)
    scores = FT.match_map_sides(d).select(F.col("match_id").alias("history_id"), "team_id", "team_against_id", "map_id",
                                          "team_def_score", "team_against_def_score", "duration")
    events = FT.team_sequence(d).select("history_id", "team_id", "team_against_id", "seq").join(
        scores, ["history_id", "team_id", "team_against_id"])
    rows = FT.day_history(d, events=events, of=["target_id", "side"])
    df = opened(rows.withColumn("form_date", F.col("target_date").cast("string")))
    return df.select("target_id", "side", "history_id", "map_id", "form_date", "team_def_score", "team_against_def_score", "duration")


def _maps_text_spark(col):
    fields = ["map_id", "team_def_score", "team_atk_score", "team_ot_score", "team_against_def_score",
              "team_against_atk_score", "team_against_ot_score", "duration"]

    def one(m):
        parts = [F.coalesce(m[f].cast("string"), F.lit("")) for f in fields]
        parts += [F.array_join(F.transform(m["team_agents"], lambda x: x.cast("string")), ","),
                  F.array_join(F.transform(m["team_against_agents"], lambda x: x.cast("string")), ",")]
        parts += [m[f"team_{n}"].cast("string") for n in _ROLE_NAMES]
        parts += [m[f"team_against_{n}"].cast("string") for n in _ROLE_NAMES]
        return F.concat_ws("|", *parts)

    return F.array_join(F.transform(F.col(col), one), ";")


_MAP_TEXT_SQL = "concat_ws('|', " + ", ".join(
    [f"coalesce(CAST({f} AS VARCHAR), '')" for f in
     ["map_id", "team_def_score", "team_atk_score", "team_ot_score", "team_against_def_score",
      "team_against_atk_score", "team_against_ot_score", "duration"]]
    + ["team_agents", "team_against_agents"]
    + [f"CAST(team_{n} AS VARCHAR)" for n in _ROLE_NAMES]
    + [f"CAST(team_against_{n} AS VARCHAR)" for n in _ROLE_NAMES]) + ")"

DATASET_SQL = f"""
SELECT th.target_id, th.side, th.target_stage, th.target_tier, th.history_id, th.stage, th.team_score, th.team_against_score,
  th.team_rating, th.team_against_rating, CAST(th.target_date AS VARCHAR) AS form_date, pm.maps
FROM th LEFT JOIN pm ON pm.match_id = th.history_id AND pm.team_id = th.team_id"""
DATASET_CTES = (f"{HISTORY_CTES},\n{MATCH_MAPS_CTES},\nfm AS ({MATCH_MAPS_SQL}),\n"
                f"pm AS (SELECT match_id, team_id, string_agg({_MAP_TEXT_SQL}, ';' ORDER BY map_id) AS maps "
                f"FROM fm GROUP BY match_id, team_id)")


@query("feat_dataset_long", sql=DATASET_SQL, ctes=DATASET_CTES)
def feat_dataset_long(spark, sf_dir):
    """History of all targets with their maps nested; forms by key."""
    d = dom(spark, sf_dir)
    rows = FT.shared_dataset(d, maps=FT.match_documents(d).withColumn("maps", _maps_text_spark("maps")))
    return opened(rows.withColumn("form_date", F.col("form_date").cast("string"))).select(*FT.DOCUMENT)


def _record_text(row, first: str, fields: list[str]):
    """A nested record as text: fields by |, agents by comma."""
    parts = [F.coalesce(row[first].cast("string"), F.lit(""))]
    for f in fields:
        parts.append(F.coalesce(F.array_join(F.transform(row[f], lambda x: x.cast("string")), ","), F.lit(""))
                     if f.endswith("agents") else F.coalesce(row[f].cast("string"), F.lit("")))
    return F.concat_ws("|", *parts)


def document_text(doc):
    """``training_document`` with its maps as text, one after another by ;"""
    fields = [*FT.MAP_FEATURES, "form_lo", "form_hi"]
    return doc.select(*[c for c in doc.columns if c not in ("maps", "form_date")],
                      F.col("form_date").cast("string").alias("form_date"),
                      F.array_join(F.transform("maps", lambda m: _record_text(m, "map_id", fields)), ";").alias("maps"))


def forms_text(forms):
    """``training_forms`` with its games as text, one after another by a slash."""
    games = F.transform("map_form", lambda g: _record_text(g, "seq", ["match_id", *FT.FORM_FEATURES]))
    return forms.select(F.col("form_date").cast("string").alias("form_date"), "map_id", "part",
                        F.array_join(games, "/").alias("map_form"))


def _record_sql(alias: str, first: str, fields: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({alias}.{f} AS VARCHAR), '')" for f in [first, *fields]) + ")"


DOCUMENT_CTES = f"""{_FORM_CTES},
lastrange AS (SELECT k.map_id, coalesce(sum(x.n) FILTER (WHERE x.date < l.date - INTERVAL 180 DAY), 0)::BIGINT AS form_lo,
                coalesce(sum(x.n) FILTER (WHERE x.date < l.date), 0)::BIGINT AS form_hi
              FROM (SELECT DISTINCT map_id FROM mday) k JOIN mday x ON x.map_id = k.map_id, last_day l GROUP BY k.map_id),
lasthist AS (SELECT th.* FROM th JOIN last_day l ON th.target_date = l.date),
docrow AS (SELECT fm.*, r.form_lo, r.form_hi FROM fm JOIN lastrange r USING (map_id)),
docmaps AS (SELECT match_id, team_id, string_agg({_record_sql("docrow", "map_id", [*FT.MAP_FEATURES, "form_lo", "form_hi"])},
              ';' ORDER BY map_id) AS maps
            FROM docrow WHERE match_id IN (SELECT history_id FROM lasthist) GROUP BY match_id, team_id),
fcomp AS (SELECT match_id, team_id, array_to_string(list_sort(list(DISTINCT agent_id)), ',') AS agents,
            {", ".join(f"count(*) FILTER (WHERE role = '{r}') AS {n}" for n, r in FT.ROLE_COUNTS)}
          FROM pr WHERE side = 'def' GROUP BY match_id, team_id),
fmaps AS (SELECT mm.match_id, mm.map_id, {", ".join(f"mm.{f}" for f in FT.FORM_FEATURES[:7])},
            c1.agents AS team_1_agents, c2.agents AS team_2_agents,
            {", ".join(f"coalesce(c{i}.{n}, 0) AS team_{i}_{n}" for i in (1, 2) for n in _ROLE_NAMES)}
          FROM g_match_maps mm LEFT JOIN fcomp c1 ON c1.match_id = mm.match_id AND c1.team_id = mm.team_1_id
          LEFT JOIN fcomp c2 ON c2.match_id = mm.match_id AND c2.team_id = mm.team_2_id),
formrow AS (SELECT f.*, n.seq, (n.seq - r.form_lo - 1) // {FT.FORM_PART} AS part FROM lastrange r
            JOIN mnum n ON n.map_id = r.map_id AND n.seq > r.form_lo AND n.seq <= r.form_hi
            JOIN fmaps f ON f.match_id = n.match_id AND f.map_id = n.map_id)"""
DOCUMENT_SQL = """
SELECT th.target_id, th.side, th.target_stage, th.target_tier, th.history_id, th.stage, th.team_score, th.team_against_score,
  th.team_rating, th.team_against_rating, CAST(th.target_date AS VARCHAR) AS form_date, dm.maps
FROM lasthist th LEFT JOIN docmaps dm ON dm.match_id = th.history_id AND dm.team_id = th.team_id"""
FORMS_SQL = f"""
SELECT CAST(l.date AS VARCHAR) AS form_date, map_id, part::INT AS part,
  string_agg({_record_sql("formrow", "seq", ["match_id", *FT.FORM_FEATURES])}, '/' ORDER BY seq) AS map_form
FROM formrow, last_day l WHERE map_id IN (SELECT fm.map_id FROM fm JOIN lasthist th ON th.history_id = fm.match_id AND th.team_id = fm.team_id)
GROUP BY l.date, map_id, part"""


# Each map's text is made once, per match; its form's range at the target's date is set behind it.
ALL_DOCUMENT_CTES = f"""{DOCUMENT_CTES},
{DATE_FORMS_CTE},
maptext AS (SELECT match_id, team_id, map_id, {_record_sql("fm", "map_id", FT.MAP_FEATURES)} AS body FROM fm),
dmaps AS (SELECT x.match_id, x.team_id, r.form_date,
            string_agg(x.body || '|' || r.form_lo || '|' || r.form_hi, ';' ORDER BY x.map_id) AS maps
          FROM (SELECT DISTINCT history_id, team_id, target_date FROM th) t
          JOIN maptext x ON x.match_id = t.history_id AND x.team_id = t.team_id
          JOIN drange r ON r.map_id = x.map_id AND r.form_date = t.target_date
          GROUP BY x.match_id, x.team_id, r.form_date)"""
ALL_DOCUMENT_SQL = """
SELECT th.target_id, th.side, th.target_stage, th.target_tier, th.history_id, th.stage, th.team_score, th.team_against_score,
  th.team_rating, th.team_against_rating, CAST(th.target_date AS VARCHAR) AS form_date, dm.maps
FROM th LEFT JOIN dmaps dm ON dm.match_id = th.history_id AND dm.team_id = th.team_id AND dm.form_date = th.target_date"""


@query("feat_dataset", sql=ALL_DOCUMENT_SQL, ctes=ALL_DOCUMENT_CTES)
def feat_dataset(spark, sf_dir):
    """The training document of all targets: their history with its maps."""
    d = dom(spark, sf_dir)
    fm = FT.feat_match_maps(d)
    body = _record_text({f: F.col(f) for f in fm.columns}, "map_id", FT.MAP_FEATURES).alias("body")
    doc = FT.shared_document(d, maps=fm.select("match_id", "team_id", "map_id", body))
    text = F.transform("maps", lambda m: F.concat_ws("|", m["body"], m["form_lo"].cast("string"), m["form_hi"].cast("string")))
    rows = doc.withColumns({"form_date": F.col("form_date").cast("string"), "maps": F.array_join(text, ";")})
    return opened(rows).select(*FT.DOCUMENT)


@query("feat_dataset_forms", sql=FORMS_SQL, ctes=DOCUMENT_CTES)
def feat_dataset_forms(spark, sf_dir):
    """The map forms of the training document of the targets of the last day."""
    d = dom(spark, sf_dir)
    return forms_text(FT.nested_forms(d, FT.reached_forms(d, FT.latest_targets(d))))


# feat_maps rows that make up each (date, map) form, joined to their features.
@query("feat_map_form", sql=f"""
SELECT CAST(k.form_date AS VARCHAR) AS form_date, k.map_id, f.match_id AS form_match_id,
  f.team_1_def_score, f.team_2_def_score, f.duration
FROM (SELECT DISTINCT m.date AS form_date, mm.map_id FROM g_match_maps mm JOIN g_matches m ON m.id = mm.match_id) k
JOIN (SELECT mm.match_id, mm.map_id, m.date FROM g_match_maps mm JOIN g_matches m ON m.id = mm.match_id) m
  ON m.map_id = k.map_id AND m.date >= k.form_date - INTERVAL 180 DAY AND m.date < k.form_date
JOIN fmaps f ON f.match_id = m.match_id AND f.map_id = m.map_id""",
       ctes=f"{_MAPS_MATCH[1]},\nfmaps AS ({_MAPS_MATCH[0]})")
def feat_map_form(spark, sf_dir):
    d = dom(spark, sf_dir)
    maps = FT.feat_maps(d).select(F.col("match_id").alias("form_match_id"), "map_id", "team_1_def_score", "team_2_def_score", "duration")
    j = FT.map_form(d, events=FT.map_sequence(d).join(maps, ["form_match_id", "map_id"]), text=True)
    return j.select("form_date", "map_id", "form_match_id", "team_1_def_score", "team_2_def_score", "duration")
