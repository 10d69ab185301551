"""Queries for windows."""

from __future__ import annotations

from skirmish.operators import loaders as L
from skirmish.operators import windows as W
from skirmish.plans.batch import ingest_batch, stored_domain
from skirmish.plans.registry import dom, query
from skirmish.session import scratch_dir

# Both perspectives of every match with its margin (oracle helper CTE).
SIDES_SQL = """team_rows AS (
  SELECT id AS match_id, date, team_1_id AS team_id, team_2_id AS team_against_id,
         team_1_score AS team_score, team_2_score AS team_against_score FROM g_matches
  UNION ALL
  SELECT id, date, team_2_id, team_1_id, team_2_score, team_1_score FROM g_matches)"""


HISTORY_SQL = """
SELECT t.match_id, t.team_id, CAST(t.date AS VARCHAR) AS date,
  CAST(count(h.match_id) AS BIGINT) AS n_matches,
  CAST(coalesce(sum(CASE WHEN h.team_score > h.team_against_score THEN 1 ELSE 0 END), 0) AS BIGINT) AS n_wins,
  round(CAST(sum(h.team_score - h.team_against_score) AS DOUBLE) / nullif(count(h.match_id), 0), 6) AS avg_margin
FROM team_rows t LEFT JOIN team_rows h
  ON h.team_id = t.team_id AND h.date >= t.date - INTERVAL 180 DAY AND h.date < t.date
GROUP BY t.match_id, t.team_id, t.date"""


@query("win_history", sql=HISTORY_SQL, ctes=SIDES_SQL)
def win_history(spark, sf_dir):
    return W.win_history(L.load_matches(dom(spark, sf_dir)))


@query("win_history_ingested", sql=HISTORY_SQL, ctes=SIDES_SQL)
def win_history_ingested(spark, sf_dir):
    """The same over matches that an ingest run parsed and stored: what the
    jobs write is what the features read."""
    d = dom(spark, sf_dir)
    paths = ingest_batch(d, scratch_dir(spark, "ingested"), ["matches"])
    return W.win_history(L.load_matches(stored_domain(d, paths)))
