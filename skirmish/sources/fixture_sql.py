"""The domain views as SQL text for the DuckDB oracle (same rows as fixtures.py).

``with_views(sql)`` prepends the views a query names (plus what they depend
on) as CTEs, over the driver views ``nation region orders``.
"""

from __future__ import annotations

import re

from skirmish.sources.fixtures import COUNT_STATS, WEIGHTED_STATS



def _raw_stat(c: str) -> str:
    """The def, atk and both cells of one player statistic."""
    both = f"CAST(sum({c}) AS BIGINT)" if c in COUNT_STATS else f"avg({c})"
    if c == "deaths":
        both = f"CASE WHEN match_id % 101 = 0 AND player_id % 10 = 0 THEN NULL ELSE {both} END"
    sides = [f"CASE WHEN player_id % 5 = {off} THEN NULL ELSE max(CASE WHEN side = '{s}' THEN {c} END) END AS {s}_{c}"
             for off, s in enumerate(("def", "atk"))]
    return ", ".join(sides + [f"{both} AS both_{c}"])


_RAW_STATS = ",\n  ".join(_raw_stat(c) for c in COUNT_STATS + WEIGHTED_STATS)

VIEWS: dict[str, str] = {
    "g_agents": """
SELECT CAST(n_nationkey + 1 AS INT) AS id, concat('agent_', n_nationkey) AS name,
  CASE n_nationkey % 4 WHEN 0 THEN 'duelist' WHEN 1 THEN 'controller' WHEN 2 THEN 'sentinel' ELSE 'initiator' END AS agent_type
FROM nation""",
    "g_maps": """
SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, concat('Map', n_nationkey + 1) AS name FROM nation WHERE n_nationkey < 12""",
    "g_matches": """
SELECT o_orderkey AS id, concat('/', o_orderkey, '/m-', o_custkey) AS url, CAST(o_orderdate AS DATE) AS date,
  o_custkey % 7 AS tournament_id,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'grand_final' WHEN '2-HIGH' THEN 'playoff' ELSE 'group_stage' END AS stage,
  o_custkey % 20 + 1 AS team_1_id, (o_custkey + 1 + (o_orderkey * 7) % 19) % 20 + 1 AS team_2_id,
  o_orderkey % 3 AS team_1_score, (o_orderkey + 1) % 3 AS team_2_score,
  CASE WHEN o_custkey % 11 = 0 THEN NULL ELSE 1400 + o_custkey % 700 END AS team_1_rating,
  1400 + (o_orderkey * 3) % 700 AS team_2_rating
FROM orders""",
    "g_match_maps": """
SELECT m.id AS match_id, (m.id + n.n_nationkey * 5) % 12 + 1 AS map_id,
  CASE WHEN m.id % 13 = 0 THEN NULL ELSE 1800 + (m.id * 7) % 1800 END AS duration, m.team_1_id, m.team_2_id,
  (m.id + n.n_nationkey) % 8 AS team_1_def_score, (m.id * 3 + n.n_nationkey) % 7 AS team_1_atk_score, (m.id + n.n_nationkey) % 3 AS team_1_ot_score,
  (m.id * 5 + n.n_nationkey) % 8 AS team_2_def_score, (m.id * 11 + n.n_nationkey) % 7 AS team_2_atk_score, (m.id + n.n_nationkey * 2) % 3 AS team_2_ot_score,
  CASE WHEN (m.id + n.n_nationkey) % 2 = 0 THEN m.team_1_id ELSE m.team_2_id END AS team_def_first,
  CASE (m.id + n.n_nationkey) % 3 WHEN 0 THEN m.team_1_id WHEN 1 THEN m.team_2_id ELSE NULL END AS team_pick
FROM g_matches m JOIN nation n ON n.n_nationkey < 1 + m.id % 3""",
    "g_round_stats": """
SELECT mm.match_id, mm.map_id, n.n_nationkey + 1 AS round_no, mm.team_1_id, mm.team_2_id,
  CASE WHEN n.n_nationkey < 12 THEN mm.team_def_first ELSE mm.team_1_id + mm.team_2_id - mm.team_def_first END AS team_def,
  CASE WHEN n.n_nationkey % 12 = 0 THEN 'pistol' ELSE CASE (mm.match_id + mm.map_id * 3 + n.n_nationkey * 7) % 4 WHEN 0 THEN 'eco' WHEN 1 THEN 'semi_eco' WHEN 2 THEN 'semi_buy' ELSE 'full_buy' END END AS team_1_buy_type,
  CASE WHEN n.n_nationkey % 12 = 0 THEN 'pistol' ELSE CASE (mm.match_id * 3 + mm.map_id + n.n_nationkey * 5) % 4 WHEN 0 THEN 'eco' WHEN 1 THEN 'semi_eco' WHEN 2 THEN 'semi_buy' ELSE 'full_buy' END END AS team_2_buy_type,
  ((mm.match_id * 7 + n.n_nationkey * 311) % 300) * 100 AS team_1_bank, ((mm.match_id * 11 + n.n_nationkey * 173) % 300) * 100 AS team_2_bank,
  CASE WHEN (mm.match_id * 13 + mm.map_id * 7 + n.n_nationkey * 3) % 5 < 3 THEN mm.team_1_id ELSE mm.team_2_id END AS team_won,
  CASE (mm.match_id + mm.map_id + n.n_nationkey) % 4 WHEN 0 THEN 'eliminate' WHEN 1 THEN 'spike_explode' WHEN 2 THEN 'defuse' ELSE 'out_of_time' END AS won_method
FROM g_match_maps mm JOIN nation n ON n.n_nationkey < 16 + (mm.match_id + mm.map_id) % 9""",
    "g_sides": """
SELECT match_id, map_id, team_1_id AS team_id, team_2_id AS opp_id, 1 AS slot FROM g_match_maps
UNION ALL SELECT match_id, map_id, team_2_id, team_1_id, 2 FROM g_match_maps""",
    "g_player_overview_stats": """
SELECT s.match_id, s.map_id, s.team_id, s.team_id * 10 + p.n_nationkey AS player_id,
  CASE d.r_regionkey WHEN 0 THEN 'def' ELSE 'atk' END AS side,
  CAST((s.match_id + s.map_id + s.team_id + p.n_nationkey * 6) % 25 + 1 AS INT) AS agent_id,
  CAST((s.match_id + p.n_nationkey * 31 + d.r_regionkey * 17) % 200 AS DOUBLE) / 100 AS rating,
  CAST((s.match_id * 3 + p.n_nationkey * 41 + d.r_regionkey * 29) % 350 AS DOUBLE) AS acs,
  (s.match_id + s.map_id * 5 + p.n_nationkey * 3 + d.r_regionkey) % 14 AS kills, (s.match_id + s.map_id * 3 + p.n_nationkey * 5 + d.r_regionkey * 7) % 14 AS deaths,
  (s.match_id + p.n_nationkey) % 9 AS assists, CAST((s.match_id * 7 + p.n_nationkey * 13 + d.r_regionkey) % 101 AS DOUBLE) AS kast,
  CAST((s.match_id * 5 + p.n_nationkey * 19 + d.r_regionkey) % 220 AS DOUBLE) AS adr, CAST((s.match_id * 9 + p.n_nationkey * 23 + d.r_regionkey) % 101 AS DOUBLE) AS hs,
  (s.match_id + p.n_nationkey) % 4 AS first_kills, (s.match_id + p.n_nationkey * 2) % 4 AS first_deaths
FROM g_sides s JOIN nation p ON p.n_nationkey < 5 JOIN region d ON d.r_regionkey < 2""",
    "g_player_highlights": """
SELECT h.match_id, h.map_id, h.round_no, h.team_id, h.player_id, h.highlight_type, h.opp_id * 10 + o.n_nationkey AS player_against_id
FROM (SELECT r.match_id, r.map_id, r.round_no, s.team_id, s.opp_id, s.team_id * 10 + (r.round_no + r.match_id) % 5 AS player_id,
        CASE (r.match_id + r.map_id + r.round_no * 5 + s.slot) % 9 WHEN 0 THEN '2k' WHEN 1 THEN '3k' WHEN 2 THEN '4k' WHEN 3 THEN '5k' WHEN 4 THEN '1v1' WHEN 5 THEN '1v2' WHEN 6 THEN '1v3' WHEN 7 THEN '1v4' ELSE '1v5' END AS highlight_type,
        CASE (r.match_id + r.map_id + r.round_no * 5 + s.slot) % 9 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 5 WHEN 4 THEN 1 WHEN 5 THEN 2 WHEN 6 THEN 3 WHEN 7 THEN 4 ELSE 5 END AS n_opp
      FROM g_round_stats r JOIN g_sides s ON s.match_id = r.match_id AND s.map_id = r.map_id
      WHERE (r.match_id + r.round_no * 3 + s.slot) % 4 = 0) h
JOIN nation o ON o.n_nationkey < h.n_opp""",
    "g_players_duel_stats": """
SELECT mm.match_id, mm.map_id, mm.team_1_id * 10 + a.n_nationkey AS team_1_player_id, mm.team_2_id * 10 + b.n_nationkey AS team_2_player_id,
  (mm.match_id + a.n_nationkey * 3 + b.n_nationkey) % 7 AS team_1_player_kills_vs_team_2_player, (mm.match_id + a.n_nationkey + b.n_nationkey * 3) % 7 AS team_2_player_kills_vs_team_1_player,
  (mm.match_id + a.n_nationkey) % 3 AS team_1_player_first_kills_vs_team_2_player, (mm.match_id + b.n_nationkey) % 3 AS team_2_player_first_kills_vs_team_1_player,
  (mm.map_id + a.n_nationkey) % 2 AS team_1_player_op_kills_vs_team_2_player, (mm.map_id + b.n_nationkey) % 2 AS team_2_player_op_kills_vs_team_1_player
FROM g_match_maps mm JOIN nation a ON a.n_nationkey < 5 JOIN nation b ON b.n_nationkey < 5""",
    "g_raw_matches": """
SELECT id, url, date, concat('/event/', tournament_id, '/cup-', tournament_id, '/stage') AS event_href,
  CASE stage WHEN 'grand_final' THEN 'Playoffs: Grand  Final' WHEN 'playoff' THEN ' Playoffs: Upper Round 1' ELSE 'Main Event: Week 2' END AS series_txt,
  concat('/team/', team_1_id, '/t', team_1_id) AS team_1_href, concat('/team/', team_2_id, '/t', team_2_id) AS team_2_href,
  CASE WHEN team_1_rating IS NULL THEN '' ELSE concat(' [', team_1_rating, '] ') END AS team_1_rating_txt,
  CASE WHEN team_2_rating IS NULL THEN '' ELSE concat(' [', team_2_rating, '] ') END AS team_2_rating_txt,
  concat(' ', team_1_score, chr(10)) AS team_1_score_txt, concat(' ', team_2_score, chr(10)) AS team_2_score_txt,
  CASE WHEN id % 17 = 0 THEN '-' WHEN id % 3 = 0 THEN '1:02:05' ELSE concat(20 + id % 39, ':', 10 + id % 49) END AS duration_txt
FROM g_matches""",
    "g_raw_rounds": """
SELECT match_id, map_id, round_no, team_1_id, team_2_id,
  CASE WHEN team_won = team_1_id THEN 'rnd-sq mod-win' ELSE '' END AS t1_win_class,
  concat('rnd-sq mod-win ', CASE WHEN team_won = team_def THEN 'mod-ct' ELSE 'mod-t' END) AS win_class,
  concat('/img/vlr/game/round/', CASE won_method WHEN 'eliminate' THEN 'elim' WHEN 'spike_explode' THEN 'boom' WHEN 'defuse' THEN 'defuse' ELSE 'time' END, '.webp') AS win_img,
  CASE team_1_buy_type WHEN 'semi_eco' THEN '$' WHEN 'semi_buy' THEN '$$' WHEN 'full_buy' THEN '$$$' ELSE '' END AS t1_buy_txt,
  CASE team_2_buy_type WHEN 'semi_eco' THEN '$' WHEN 'semi_buy' THEN '$$' WHEN 'full_buy' THEN '$$$' ELSE '' END AS t2_buy_txt,
  CASE WHEN match_id % 50 = 0 AND round_no = 5 THEN 'n/a' ELSE concat(CAST(floor(team_1_bank / 1000) AS INT), '.', CAST((team_1_bank % 1000) / 100 AS INT), 'k') END AS t1_bank_txt,
  concat(CAST(floor(team_2_bank / 1000) AS INT), '.', CAST((team_2_bank % 1000) / 100 AS INT), 'k') AS t2_bank_txt
FROM g_round_stats""",
    # Two fragments of a map page with the cells each of them lacks.
    "g_raw_overview_cells": """
SELECT match_id, map_id, round_no - 1 AS pos, win_class FROM g_raw_rounds WHERE (match_id + map_id + round_no) % 43 <> 0""",
    "g_raw_economy_cells": """
SELECT match_id, map_id, round_no - 1 AS pos, t1_bank_txt FROM g_raw_rounds WHERE (match_id * 3 + map_id + round_no) % 41 <> 0""",
    # Side rows as they arrive: an atk row in 97 is lost, a def row in 101 comes twice.
    "g_raw_side_rows": """
SELECT match_id, map_id, team_id, player_id, side FROM g_player_overview_stats WHERE NOT (side = 'atk' AND (match_id + player_id) % 97 = 0)
UNION ALL
SELECT match_id, map_id, team_id, player_id, side FROM g_player_overview_stats WHERE side = 'def' AND (match_id + player_id) % 101 = 0""",
    "g_raw_player_stats": f"""
SELECT match_id, map_id, team_id, player_id,
  CASE WHEN match_id % 97 = 0 AND player_id % 10 = 3 THEN 'agent_new' ELSE concat('agent_', max(agent_id) - 1) END AS agent_name,
  {_RAW_STATS}
FROM g_player_overview_stats GROUP BY match_id, map_id, team_id, player_id""",
    "g_veto_notes": """
SELECT id AS match_id, team_1_id, team_2_id, concat('T', team_1_id) AS t1_short, concat('T', team_2_id) AS t2_short,
  concat('T', team_1_id, ' ban Map', id % 12 + 1, '; T', team_2_id, ' ban Map', (id + 5) % 12 + 1, '; T', team_1_id, ' pick Map', (id + 7) % 12 + 1, '; Map', (id + 9) % 12 + 1, ' remains') AS note
FROM g_matches""",
}


# Raw page-fragment views (twins of skirmish.sources.raw_views).
VIEWS.update({
    "g_geo": """
SELECT n_name AS country, r_name AS continent, CAST(n_nationkey AS BIGINT) AS row_no
FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "g_raw_tournaments": """
SELECT c_custkey AS id, c_name AS name, concat('/event/', c_custkey, '/', lower(c_mktsegment)) AS url,
  CASE WHEN c_acctbal < 0 THEN 'TBD' ELSE concat('$', format('{:,}', CAST(floor(c_acctbal * 100) AS BIGINT)), ' USD') END AS prize_txt,
  CASE WHEN c_nationkey % 5 = 0 THEN concat('/event/group/vct-20', 20 + c_nationkey % 6) ELSE '/event/group/open' END AS group_href
FROM customer""",
    "g_raw_teams": """
SELECT c.c_custkey AS id,
  CASE c.c_custkey % 3 WHEN 0 THEN concat('T', c.c_custkey % 1000) WHEN 1 THEN concat('Team ', c.c_custkey) ELSE c.c_name END AS name,
  CASE WHEN c.c_custkey % 2 = 0 THEN '' ELSE concat('C', c.c_custkey % 100) END AS shorthand_txt,
  concat('/team/', c.c_custkey, '/', lower(c.c_mktsegment)) AS url,
  CASE c.c_custkey % 4 WHEN 0 THEN lower(g.country) WHEN 1 THEN g.country WHEN 2 THEN concat('  ', g.continent)
    ELSE concat('Land ', c.c_mktsegment) END AS location_txt
FROM customer c JOIN g_geo g ON g.row_no = c.c_nationkey""",
    "g_raw_players": """
SELECT p.player_id AS id, concat('p', p.player_id) AS name, concat('/player/', p.player_id, '/p', p.player_id) AS url,
  CASE WHEN p.player_id % 7 = 0 THEN '' ELSE n.n_name END AS country_txt
FROM (SELECT DISTINCT player_id FROM g_player_overview_stats) p JOIN nation n ON n.n_nationkey = p.player_id % 25""",
    "g_roster": """
SELECT match_id, map_id, team_id, name, arg_max(player_id, pos) AS player_id FROM (
  SELECT match_id, map_id, team_id, concat('p', player_id) AS name, player_id, player_id % 10 AS pos
  FROM g_player_overview_stats WHERE side = 'def') GROUP BY match_id, map_id, team_id, name""",
    "g_raw_duel_grid": """
SELECT match_id, map_id, team_1_player_id % 10 AS i, team_2_player_id % 10 AS j,
  CASE WHEN match_id % 79 = 0 AND team_1_player_id % 10 = 1 AND team_2_player_id % 10 = 1 THEN 'x'
    WHEN team_1_player_kills_vs_team_2_player = 0 AND team_2_player_kills_vs_team_1_player = 0 THEN ''
    ELSE concat(team_1_player_kills_vs_team_2_player, ' ', team_2_player_kills_vs_team_1_player) END AS kills_txt,
  CASE WHEN team_1_player_first_kills_vs_team_2_player = 0 AND team_2_player_first_kills_vs_team_1_player = 0 THEN ''
    ELSE concat(team_1_player_first_kills_vs_team_2_player, ' ', team_2_player_first_kills_vs_team_1_player) END AS first_kills_txt,
  CASE WHEN team_1_player_op_kills_vs_team_2_player = 0 AND team_2_player_op_kills_vs_team_1_player = 0 THEN ''
    ELSE concat(team_1_player_op_kills_vs_team_2_player, ' ', team_2_player_op_kills_vs_team_1_player) END AS op_kills_txt
FROM g_players_duel_stats""",
    "g_raw_duel_headers": """
SELECT mm.match_id, mm.map_id, n.n_nationkey AS pos,
  CASE WHEN mm.match_id % 83 = 0 AND n.n_nationkey = 2 THEN 'sub' ELSE concat('p', mm.team_1_id * 10 + n.n_nationkey) END AS row_name,
  concat('p', mm.team_2_id * 10 + n.n_nationkey) AS col_name
FROM g_match_maps mm JOIN nation n ON n.n_nationkey < 5""",
    "g_raw_highlight_cells": """
SELECT h.match_id, h.map_id, CASE WHEN h.team_id = mm.team_1_id THEN h.player_id % 10 ELSE h.player_id % 10 + 5 END AS pos,
  CASE WHEN h.match_id % 89 = 0 AND h.round_no = 3 THEN 'sub' ELSE concat('p', h.player_id) END AS owner_txt, h.round_no, h.highlight_type,
  string_agg(concat('p', h.player_against_id), ', ' ORDER BY concat('p', h.player_against_id)) AS opponents_txt
FROM g_player_highlights h JOIN g_match_maps mm ON mm.match_id = h.match_id AND mm.map_id = h.map_id
GROUP BY h.match_id, h.map_id, CASE WHEN h.team_id = mm.team_1_id THEN h.player_id % 10 ELSE h.player_id % 10 + 5 END,
  h.player_id, h.round_no, h.highlight_type""",
    "g_raw_map_overview": """
SELECT match_id, CAST(map_id AS VARCHAR) AS game_id, concat('Map', map_id) AS map_name,
  CASE WHEN duration IS NULL THEN '-' ELSE concat(CAST(floor(duration / 60) AS BIGINT), ':', lpad(CAST(duration % 60 AS VARCHAR), 2, '0')) END AS duration_txt,
  CASE WHEN team_def_first = team_1_id THEN ' mod-ct ' ELSE 'mod-t' END AS def_first_class,
  CASE WHEN team_pick = team_1_id THEN 'picked mod-1' WHEN team_pick = team_2_id THEN 'picked mod-2' ELSE 'picked' END AS pick_class,
  CAST(team_1_def_score AS VARCHAR) AS t1_def_txt, CAST(team_1_atk_score AS VARCHAR) AS t1_atk_txt, CAST(team_1_ot_score AS VARCHAR) AS t1_ot_txt,
  CAST(team_2_def_score AS VARCHAR) AS t2_def_txt, CAST(team_2_atk_score AS VARCHAR) AS t2_atk_txt, CAST(team_2_ot_score AS VARCHAR) AS t2_ot_txt
FROM g_match_maps
UNION ALL SELECT id, 'all', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM g_matches""",
    "g_raw_map_performance": """
SELECT match_id, CAST(map_id AS VARCHAR) AS game_id, count(*) AS n_duel_cells FROM g_players_duel_stats GROUP BY match_id, map_id
UNION ALL SELECT id, 'all', NULL FROM g_matches""",
    "g_raw_map_economy": """
SELECT match_id, CAST(map_id AS VARCHAR) AS game_id, count(*) AS n_rounds FROM g_round_stats GROUP BY match_id, map_id
UNION ALL SELECT id, 'all', NULL FROM g_matches""",
    "g_raw_listing": """
SELECT DISTINCT CAST(floor(ud / 7) AS BIGINT) AS page_no, CAST((6 - (ud - floor(ud / 7) * 7)) * 1000000000 AS BIGINT) AS pos,
  'date' AS kind, strftime(date, '%a, %B %-d, %Y') AS txt
FROM (SELECT date, date_diff('day', DATE '1970-01-01', date) AS ud FROM g_matches)
UNION ALL
SELECT CAST(floor(ud / 7) AS BIGINT), CAST((6 - (ud - floor(ud / 7) * 7)) * 1000000000 + id + 1 AS BIGINT), 'link', url
FROM (SELECT id, url, date, date_diff('day', DATE '1970-01-01', date) AS ud FROM g_matches)""",
})
_ORDER = list(VIEWS)
_NAME = re.compile(r"\bg_[a-z_]+\b")


def _deps(name: str) -> set[str]:
    return {n for n in _NAME.findall(VIEWS[name]) if n in VIEWS and n != name}


def with_views(sql: str, extra: str = "") -> str:
    """Prefix ``sql`` with the g_* views it uses, in dependency order.

    ``extra`` is further CTE text (``name AS (...), ...``) placed after the
    views; it may itself reference g_* views.
    """
    need: set[str] = set()
    todo = [n for n in _NAME.findall(sql + " " + extra) if n in VIEWS]
    while todo:
        n = todo.pop()
        if n not in need:
            need.add(n)
            todo.extend(_deps(n))
    ctes = [f"{n} AS ({VIEWS[n]}\n)" for n in _ORDER if n in need]
    if extra.strip():
        ctes.append(extra.strip())
    body = sql.strip()
    if body[:5].upper() == "WITH " and ctes:
        # the query's own CTE list continues ours
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    if not ctes:
        return sql
    return "WITH " + ",\n".join(ctes) + "\n" + sql
