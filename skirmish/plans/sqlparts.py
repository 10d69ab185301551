"""Shared oracle SQL fragments (DuckDB dialect) and output helpers.

The oracle side of every query is plain SQL over the g_* views; these CTE
texts are reused by several queries. ``text_arrays`` renders array columns
as delimited text on the Spark side so both engines hash the same values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skirmish.plans.features import CLUTCH_TYPES, MULTIKILL_TYPES, ROLE_COUNTS

FLIP_ROUNDS = """fr AS (
  SELECT match_id, map_id, round_no, team_1_id AS team_id, team_2_id AS team_against_id,
    team_1_buy_type AS team_buy_type, team_2_buy_type AS team_against_buy_type,
    team_1_bank AS team_bank, team_2_bank AS team_against_bank,
    CAST(team_def = team_1_id AS INT) AS def, CAST(team_won = team_1_id AS INT) AS won, won_method
  FROM g_round_stats
  UNION ALL
  SELECT match_id, map_id, round_no, team_2_id, team_1_id, team_2_buy_type, team_1_buy_type,
    team_2_bank, team_1_bank, CAST(team_def = team_2_id AS INT), CAST(team_won = team_2_id AS INT), won_method
  FROM g_round_stats)"""

TEAM_ROWS = """team_rows AS (
  SELECT id AS match_id, url, date, tournament_id, stage, team_1_id AS team_id, team_2_id AS team_against_id,
         team_1_score AS team_score, team_2_score AS team_against_score,
         team_1_rating AS team_rating, team_2_rating AS team_against_rating FROM g_matches
  UNION ALL
  SELECT id, url, date, tournament_id, stage, team_2_id, team_1_id, team_2_score, team_1_score,
         team_2_rating, team_1_rating FROM g_matches)"""

PLAYERS_ROLE = """pr AS (
  SELECT p.*, a.agent_type AS role FROM g_player_overview_stats p LEFT JOIN g_agents a ON a.id = p.agent_id)"""


def rate_sql(num: str, den: str) -> str:
    return f"round(coalesce(CAST({num} AS DOUBLE) / NULLIF({den}, 0), 0), 6)"


def agents_text_sql(col: str = "agent_id") -> str:
    return f"array_to_string(list_sort(list_distinct(list({col}))), ',')"


def composition_sql(name: str, keys: str) -> str:
    roles = ", ".join(f"count(*) FILTER (WHERE role = '{r}') AS {n}" for n, r in ROLE_COUNTS)
    return (f"{name} AS (SELECT {keys}, {agents_text_sql()} AS agents, {roles} "
            f"FROM pr WHERE side = 'def' GROUP BY {keys})")


def text_arrays(df: DataFrame) -> DataFrame:
    """Render top-level arrays of primitives as ','-joined text (oracle hygiene)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType) and not isinstance(f.dataType.elementType, T.StructType):
            cols.append(F.array_join(F.transform(F.col(f.name), lambda x: x.cast("string")), ",").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def player_features_sql() -> str:
    side_stats = ["agent_id", "rating", "acs", "kills", "deaths", "assists", "kast", "adr", "hs",
                  "first_kills", "first_deaths"]
    piv = ", ".join(f"max(CASE WHEN side = 'def' THEN {c} END) AS def_{c}, "
                    f"max(CASE WHEN side = 'atk' THEN {c} END) AS atk_{c}" for c in side_stats)
    hc = []
    for k in CLUTCH_TYPES + MULTIKILL_TYPES:
        hc += [f"count(*) FILTER (WHERE highlight_type = '{k}' AND def = 1) AS \"n_def_{k}\"",
               f"count(*) FILTER (WHERE highlight_type = '{k}' AND def = 0) AS \"n_atk_{k}\"",
               f"count(*) FILTER (WHERE highlight_type = '{k}') AS \"n_{k}\""]
    for k in MULTIKILL_TYPES:
        hc += [f"avg(CASE WHEN highlight_type = '{k}' AND def = 1 THEN won END) AS \"cv_def_{k}\"",
               f"avg(CASE WHEN highlight_type = '{k}' AND def = 0 THEN won END) AS \"cv_atk_{k}\"",
               f"avg(CASE WHEN highlight_type = '{k}' THEN won END) AS \"cv_{k}\""]
    D, A = "coalesce(rc.def_rounds, 0)", "coalesce(rc.atk_rounds, 0)"
    T_ = f"({D} + {A})"
    out = ["p.def_agent_id AS agent_id", "ag.agent_type AS role"]

    def weighted(m):
        return [f"p.def_{m} AS def_{m}", f"p.atk_{m} AS atk_{m}",
                f"{rate_sql(f'p.def_{m} * {D} + p.atk_{m} * {A}', T_)} AS {m}"]

    def per_round(src, o):
        return [f"{rate_sql(f'p.def_{src}', D)} AS def_{o}_per_round",
                f"{rate_sql(f'p.atk_{src}', A)} AS atk_{o}_per_round",
                f"{rate_sql(f'p.def_{src} + p.atk_{src}', T_)} AS {o}_per_round"]

    out += weighted("rating") + weighted("acs")
    out += per_round("kills", "kills") + per_round("deaths", "deaths") + per_round("assists", "assists")
    out += weighted("kast") + weighted("adr")
    out += ["p.def_hs AS def_hs", "p.atk_hs AS atk_hs",
            f"{rate_sql('p.def_hs * p.def_kills + p.atk_hs * p.atk_kills', 'p.def_kills + p.atk_kills')} AS hs"]
    out += per_round("first_kills", "fk") + per_round("first_deaths", "fd")
    for k in CLUTCH_TYPES:
        out += [f"{rate_sql(f'coalesce(hc.\"n_def_{k}\", 0)', D)} AS \"def_{k}_per_round\"",
                f"{rate_sql(f'coalesce(hc.\"n_atk_{k}\", 0)', A)} AS \"atk_{k}_per_round\"",
                f"{rate_sql(f'coalesce(hc.\"n_{k}\", 0)', T_)} AS \"{k}_per_round\""]
    for k in MULTIKILL_TYPES:
        n = k[0]
        for pre, cnt, cv, den in (("def_", f"n_def_{k}", f"cv_def_{k}", D), ("atk_", f"n_atk_{k}", f"cv_atk_{k}", A),
                                  ("", f"n_{k}", f"cv_{k}", T_)):
            out += [f"{rate_sql(f'coalesce(hc.\"{cnt}\", 0)', den)} AS \"{pre}{n}ks_per_round\"",
                    f"round(coalesce(hc.\"{cv}\", 0), 6) AS \"{pre}{n}ks_convert_rate\""]
    ctes = f"""{FLIP_ROUNDS},
piv AS (SELECT match_id, map_id, team_id, player_id, count(*) AS n_rows,
  count(*) FILTER (WHERE side = 'def') AS n_def, count(*) FILTER (WHERE side = 'atk') AS n_atk, {piv}
  FROM g_player_overview_stats GROUP BY match_id, map_id, team_id, player_id),
rc AS (SELECT match_id, map_id, team_id, count(*) AS rounds, sum(def) AS def_rounds,
  count(*) - sum(def) AS atk_rounds FROM fr GROUP BY match_id, map_id, team_id),
eh AS (SELECT h.*, r.def, r.won FROM (SELECT DISTINCT match_id, map_id, team_id, player_id, round_no, highlight_type
  FROM g_player_highlights) h JOIN fr r ON r.match_id = h.match_id AND r.map_id = h.map_id
  AND r.team_id = h.team_id AND r.round_no = h.round_no),
hc AS (SELECT match_id, map_id, team_id, player_id, {", ".join(hc)} FROM eh
  GROUP BY match_id, map_id, team_id, player_id),
pf AS (SELECT p.match_id, p.map_id, p.team_id, p.player_id, {", ".join(out)}
  FROM piv p LEFT JOIN g_agents ag ON ag.id = p.def_agent_id
  LEFT JOIN rc ON rc.match_id = p.match_id AND rc.map_id = p.map_id AND rc.team_id = p.team_id
  LEFT JOIN hc ON hc.match_id = p.match_id AND hc.map_id = p.map_id AND hc.team_id = p.team_id
    AND hc.player_id = p.player_id
  WHERE p.n_def = 1 AND p.n_atk = 1)"""
    return ctes
