"""Queries for sources/sinks, set operations, sorts, incremental loading and
the extension surface (SURVEY §2.1, §2.6, §2.7, §2.10, §2.12)."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skirmish.functions import html_cells
from skirmish.functions import registry as REG
from skirmish.functions import rules as R
from skirmish.operators import sets as SO
from skirmish.operators.ranges import opened
from skirmish.plans import features as FT
from skirmish.plans import ingest as I
from skirmish.plans import q_features as QF
from skirmish.plans import q_ingest as QI
from skirmish.plans import rules_sql as S
from skirmish.plans.registry import ORACLE, QUERIES, dom, query
from skirmish.session import scratch_dir
from skirmish.sources import io as IO
from skirmish.sources import schemas as SC
from skirmish.sources import seeds as SD
from skirmish.sources import storage as STO
from skirmish.streaming import incremental as INC
from skirmish.streaming import ingest_stream as ST
from skirmish.streaming import ttl_stream as TTL
from skirmish.streaming.land import land_files, run_landing_stream

FIRST_RUN = "1992-01-02"    # matches before this date are what a first run has stored
CUT = "1998-01-01"          # matches before this date are "loaded"
LAST_CRAWL = "1998-05-01"   # listing rows from the cut to this date are queued, later ones are new

_MATCH_COLS_SQL = ("id, url, CAST(date AS VARCHAR) AS date, tournament_id, stage, team_1_id, team_2_id, "
                   "team_1_score, team_2_score, team_1_rating, team_2_rating")


def _date_str(df, col="date"):
    return df.withColumn(col, F.col(col).cast("string"))


# ------------------------------------------------------------------ 2.1 sources
@query("src_tables", sql=f"SELECT {_MATCH_COLS_SQL} FROM g_matches")
def src_tables(spark, sf_dir):
    return _date_str(dom(spark, sf_dir).matches)


_CONFORM_SQL = ", ".join(
    f"CAST({f.name} AS {'BIGINT' if isinstance(f.dataType, T.LongType) else 'INTEGER' if isinstance(f.dataType, T.IntegerType) else 'DOUBLE' if isinstance(f.dataType, T.DoubleType) else 'VARCHAR'}) AS {f.name}"
    for f in SC.SCHEMAS["player_overview_stats"].fields)


@query("src_schemas", sql=f"SELECT {_CONFORM_SQL} FROM g_player_overview_stats")
def src_schemas(spark, sf_dir):
    return SC.conform(dom(spark, sf_dir).player_overview_stats, "player_overview_stats")


def _values(rows, cols):
    body = ", ".join("(" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


_SEED_MAPS_SQL = _values([(i + 1, n, d) for i, (n, d) in enumerate(SD.MAPS)], ["id", "name", "release_date"])
_SEED_POOL_SQL = _values([(d, p, n) for d, p, names in SD.MAP_POOL for n in names], ["date", "patch_no", "name"])


@query("src_seed_dims", sql=f"""
SELECT mm.match_id, mm.map_id, sm.name AS map_name FROM g_match_maps mm LEFT JOIN {_SEED_MAPS_SQL.replace(' AS t(', ' AS sm(')}
  ON sm.id = mm.map_id""")
def src_seed_dims(spark, sf_dir):
    """Seeded maps (ids by insert order) joined to every played map."""
    sm = F.broadcast(SD.seed_maps(spark).select(F.col("id").alias("map_id"), F.col("name").alias("map_name")))
    return dom(spark, sf_dir).match_maps.select("match_id", "map_id").join(sm, "map_id", "left")


_POOL_SQL = f"""
SELECT p.date, p.patch_no, m.id AS map_id, coalesce(c.n, 0) AS maps_played
FROM {_SEED_POOL_SQL.replace(' AS t(', ' AS p(')}
LEFT JOIN {_SEED_MAPS_SQL.replace(' AS t(', ' AS m(')} ON m.name = p.name
LEFT JOIN (SELECT map_id, count(*) AS n FROM g_match_maps GROUP BY map_id) c ON c.map_id = m.id"""


def _pool(spark, sf_dir):
    played = dom(spark, sf_dir).match_maps.groupBy("map_id").agg(F.count(F.lit(1)).alias("maps_played"))
    pool = SD.seed_map_pool(spark)
    return pool.join(played, "map_id", "left").select(
        "date", "patch_no", "map_id", F.coalesce(F.col("maps_played"), F.lit(0)).alias("maps_played"))


@query("src_map_pool", sql=_POOL_SQL)
def src_map_pool(spark, sf_dir):
    """Dated pool snapshots, map name resolved to id, with how often each
    pooled map was played in the data (aggregated before the join)."""
    return _pool(spark, sf_dir)


@query("sort_pool", sql=_POOL_SQL + " ORDER BY p.date")
def sort_pool(spark, sf_dir):
    return _pool(spark, sf_dir).orderBy("date", "map_id")


@query("src_pages", sql="SELECT page_id, url, length(html) AS n_chars FROM pages")
def src_pages(spark, sf_dir):
    p = dom(spark, sf_dir).t.pages
    return p.select("page_id", "url", F.length("html").alias("n_chars"))


@query("scan_dims", sql="""
SELECT 'map' AS kind, CAST(id AS BIGINT) AS id, name FROM g_maps
UNION ALL SELECT 'agent', CAST(id AS BIGINT), name FROM g_agents
UNION ALL SELECT 'region', CAST(r_regionkey AS BIGINT), r_name FROM region""")
def scan_dims(spark, sf_dir):
    d = dom(spark, sf_dir)
    return d.maps.select(F.lit("map").alias("kind"), F.col("id").cast("bigint").alias("id"), "name").unionByName(
        d.agents.select(F.lit("agent").alias("kind"), F.col("id").cast("bigint").alias("id"), "name")).unionByName(
        d.t.region.select(F.lit("region").alias("kind"), F.col("r_regionkey").cast("bigint").alias("id"), F.col("r_name").alias("name")))


@query("src_geo_csv", sql="SELECT n_name AS country, r_name AS continent FROM nation JOIN region ON r_regionkey = n_regionkey")
def src_geo_csv(spark, sf_dir):
    """Land the country/continent CSV (header row) and read it back typed."""
    t = dom(spark, sf_dir).t
    path = scratch_dir(spark, "geo-csv")
    IO.write_csv(IO.geo_csv_rows(t.nation, t.region).coalesce(1), path)
    return IO.read_geo_csv(spark, path)


# ------------------------------------------------------------------ sinks
@query("snk_append", sql="SELECT id, url, CAST(date AS VARCHAR) AS date FROM g_matches")
def snk_append(spark, sf_dir):
    """Two overlapping batches appended idempotently by month: the overlap is
    written once, and only its months are read to find it."""
    m = dom(spark, sf_dir).matches.select("id", "url", "date")
    path = scratch_dir(spark, "append")
    STO.append_months(m.filter(F.col("date") < F.lit("1997-01-01").cast("date")), path, ["id"], "date")
    STO.append_months(m.filter(F.col("date") >= F.lit("1996-01-01").cast("date")), path, ["id"], "date")
    return _date_str(STO.read_months(spark, path).select("id", "url", "date"))


@query("snk_buckets", sql="""
SELECT mm.match_id, CAST(count(DISTINCT mm.map_id) AS BIGINT) AS n_maps, CAST(count(*) AS BIGINT) AS n_rounds,
  CAST(count(*) FILTER (WHERE r.team_won = m.team_1_id) AS BIGINT) AS team_1_rounds, m.team_1_score
FROM g_round_stats r JOIN g_match_maps mm ON mm.match_id = r.match_id AND mm.map_id = r.map_id
JOIN g_matches m ON m.id = r.match_id GROUP BY mm.match_id, m.team_1_score""")
def snk_buckets(spark, sf_dir):
    """Matches, maps and rounds stored in buckets of the match; joined and
    grouped from there, without an exchange."""
    return FT.rounds_of_stored_matches(*stored_buckets(dom(spark, sf_dir)))


def stored_buckets(d):
    """(matches, maps, rounds) as bucketed tables below the scratch folder."""
    path = scratch_dir(d.spark, "buckets")
    tables = {"matches": d.matches.withColumnRenamed("id", "match_id"), "match_maps": d.match_maps, "round_stats": d.round_stats}
    name = path.rsplit("-", 1)[1]
    return [STO.save_buckets(df, f"skirmish_{t}_{name}", f"{path}/{t}", "match_id", d.partitions) for t, df in tables.items()]


@query("snk_csv_tournaments", sql=f"""
SELECT id, name, url, {S.prize('prize_txt')} AS prize_pool, {S.tier_1('group_href', S.prize('prize_txt'))} AS tier_1
FROM g_raw_tournaments""")
def snk_csv_tournaments(spark, sf_dir):
    df = I.job_tournaments(dom(spark, sf_dir))
    path = scratch_dir(spark, "csv")
    IO.write_csv(df, path)
    schema = "id bigint, name string, url string, prize_pool bigint, tier_1 int"
    return spark.read.schema(schema).option("header", True).csv(path)


_CSV_TABLES = {"rounds": "feat_rounds", "players": "feat_players", "match_maps": "feat_match_maps", "maps": "feat_maps"}


@query("snk_csv", sql=" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, match_id, map_id, CAST(count(*) AS BIGINT) AS n_rows, {total} AS total FROM ({ORACLE[of]}) GROUP BY match_id, map_id"
    for (name, of), total in zip(_CSV_TABLES.items(), (
        "CAST(sum(team_bank + 100000 * won) AS DOUBLE)", "round(sum(rating + acs), 3)",
        "CAST(sum(team_def_score * 100 + length(team_agents)) AS DOUBLE)", "CAST(sum(coalesce(duration, 0) + length(team_2_agents)) AS DOUBLE)"))))
def snk_csv(spark, sf_dir):
    """The four feature tables written as CSV with a header and read back with
    their schemas; per table and map the rows and a total over their fields."""
    path = scratch_dir(spark, "csv")
    totals = {"rounds": F.sum(F.col("team_bank") + 100000 * F.col("won")), "players": F.round(F.sum(F.col("rating") + F.col("acs")), 3),
              "match_maps": F.sum(F.col("team_def_score") * 100 + F.length("team_agents")),
              "maps": F.sum(F.coalesce("duration", F.lit(0)) + F.length("team_2_agents"))}
    out = []
    for name, of in _CSV_TABLES.items():
        df = QUERIES[of](spark, sf_dir)
        IO.write_csv(df, f"{path}/{name}")
        back = spark.read.schema(df.schema).option("header", True).csv(f"{path}/{name}")
        out.append(back.groupBy("match_id", "map_id").agg(F.count("*").alias("n_rows"), totals[name].cast("double").alias("total"))
                   .select(F.lit(name).alias("table_name"), "match_id", "map_id", "n_rows", "total"))
    return reduce(lambda a, b: a.unionByName(b), out)


@query("snk_json", sql=f"""
WITH doc AS ({QF.DOCUMENT_SQL}), form AS ({QF.FORMS_SQL})
SELECT 'match' AS kind, form_date, target_id, side, history_id, NULL::BIGINT AS map_id, NULL::INT AS part,
  concat_ws('#', target_stage, coalesce(target_tier::VARCHAR, ''), stage, team_score, team_against_score,
    coalesce(team_rating::VARCHAR, ''), coalesce(team_against_rating::VARCHAR, ''), coalesce(maps, '')) AS body FROM doc
UNION ALL
SELECT 'form', form_date, NULL, NULL, NULL, map_id, part, map_form FROM form""", ctes=QF.DOCUMENT_CTES)
def snk_json(spark, sf_dir):
    """The training document of the targets of the last day and the forms it
    refers to, written as JSON lines and read back with their schemas: targets
    (each side with its history as a range), matches with their maps (once per
    team and day), forms with their games."""
    d = dom(spark, sf_dir)
    named = FT.latest_targets(d)
    path = scratch_dir(spark, "json")

    def landed(df, name):
        IO.write_json(df, f"{path}/{name}")
        return spark.read.schema(df.schema).json(f"{path}/{name}")

    sides = landed(FT.training_sides(d, named), "targets")
    matches = landed(FT.training_histories(d, named), "matches")
    forms = landed(FT.training_forms(d, matches), "forms")
    # The text of a match is made once for its team and day; a target's stage and tier go before it.
    def text(*names):
        return F.concat_ws("#", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names])

    of_match = text("stage", "team_score", "team_against_score", "team_rating", "team_against_rating", "maps")
    texts = QF.document_text(matches).select("team_id", "form_date", "seq", "history_id", of_match.alias("of_match"))
    sides = sides.select("team_id", F.col("form_date").cast("string").alias("form_date"), "lo", "hi", "target_id", "side",
                         text("target_stage", "target_tier").alias("of_target"))
    rows = opened(FT.shared_rows(sides, texts, ("team_id", "form_date")))
    rows = rows.select(F.lit("match").alias("kind"), "form_date", "target_id", "side", "history_id", F.lit(None).cast("long").alias("map_id"),
                       F.lit(None).cast("int").alias("part"), F.concat_ws("#", "of_target", "of_match").alias("body"))
    games = QF.forms_text(forms)
    return rows.unionByName(games.select(F.lit("form").alias("kind"), "form_date", "map_id", "part", F.col("map_form").alias("body")),
                            allowMissingColumns=True)


@query("snk_json_maps", sql="""
SELECT match_id, string_agg(CAST(map_id AS VARCHAR) || ':' || CAST(team_1_def_score AS VARCHAR), ';' ORDER BY map_id)
  AS maps FROM g_match_maps GROUP BY match_id""")
def snk_json_maps(spark, sf_dir):
    """Nested per-match documents (maps array) written as JSON lines and read
    back with an explicit schema."""
    mm = dom(spark, sf_dir).match_maps
    doc = mm.groupBy("match_id").agg(F.sort_array(F.collect_list(F.struct("map_id", "team_1_def_score"))).alias("maps"))
    path = scratch_dir(spark, "json")
    IO.write_json(doc, path)
    schema = "match_id bigint, maps array<struct<map_id:bigint, team_1_def_score:bigint>>"
    back = spark.read.schema(schema).json(path)
    return back.select("match_id", F.array_join(F.transform("maps", lambda m: F.concat_ws(
        ":", m["map_id"].cast("string"), m["team_1_def_score"].cast("string"))), ";").alias("maps"))


# ------------------------------------------------------------------ queue / incremental
_LISTING_CTE = """lst AS (
  SELECT url, """ + S.listing_date("header") + """ AS date FROM (
    SELECT kind, txt AS url, last_value(CASE WHEN kind = 'date' THEN txt END IGNORE NULLS)
      OVER (PARTITION BY page_no ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS header
    FROM g_raw_listing) WHERE kind = 'link'),
loaded AS (SELECT id, url, date FROM g_matches WHERE date < DATE '""" + CUT + """'),
queue AS (SELECT url, date FROM lst WHERE date >= DATE '""" + CUT + """' AND date < DATE '""" + LAST_CRAWL + """')"""


def _queue_parts(spark, sf_dir):
    d = dom(spark, sf_dir)
    listing = I.job_listing(d)
    cut = F.lit(CUT).cast("date")
    loaded = d.matches.filter(F.col("date") < cut).select("id", "url", "date")
    queue = listing.filter((F.col("date") >= cut) & (F.col("date") < F.lit(LAST_CRAWL).cast("date")))
    return d, listing, loaded, queue


@query("snk_queue_delete", sql="""
SELECT url, CAST(date AS VARCHAR) AS date FROM lst WHERE url NOT IN (SELECT url FROM loaded)""", ctes=_LISTING_CTE)
def snk_queue_delete(spark, sf_dir):
    """The whole listing as a queue, less what is loaded."""
    _, listing, loaded, _ = _queue_parts(spark, sf_dir)
    return _date_str(IO.queue_delete(listing, loaded, "url"))


@query("sort_queue", sql="SELECT url, CAST(date AS VARCHAR) AS date FROM lst ORDER BY lst.date DESC, url", ctes=_LISTING_CTE)
def sort_queue(spark, sf_dir):
    """The whole listing, newest first."""
    _, listing, _, _ = _queue_parts(spark, sf_dir)
    return _date_str(listing.select("url", "date").orderBy(F.desc("date"), "url"))


@query("inc_high_mark", sql="""
SELECT CAST(coalesce((SELECT max(date) FROM queue), (SELECT max(date) FROM loaded), DATE '2000-01-01') AS VARCHAR)
  AS limit_date""", ctes=_LISTING_CTE)
def inc_high_mark(spark, sf_dir):
    _, _, loaded, queue = _queue_parts(spark, sf_dir)
    return _date_str(INC.high_mark(queue, loaded, "2000-01-01"), "limit_date")


_FRONTIER_SQL = """
SELECT url, CAST(min(date) AS VARCHAR) AS date FROM (
  SELECT url, date FROM queue
  UNION ALL
  SELECT url, date FROM lst WHERE date >= (SELECT coalesce((SELECT max(date) FROM queue), (SELECT max(date) FROM loaded), DATE '2000-01-01'))
    AND url NOT IN (SELECT url FROM queue) AND url NOT IN (SELECT url FROM loaded)) GROUP BY url"""


@query("inc_frontier", sql=_FRONTIER_SQL, ctes=_LISTING_CTE)
def inc_frontier(spark, sf_dir):
    _, listing, loaded, queue = _queue_parts(spark, sf_dir)
    return _date_str(INC.frontier(listing, queue, loaded, INC.high_mark(queue, loaded, "2000-01-01")))


@query("set_append", sql="""
SELECT url, CAST(date AS VARCHAR) AS date FROM queue
UNION ALL SELECT url, CAST(date AS VARCHAR) FROM lst WHERE date >= DATE '""" + LAST_CRAWL + """'""",
       ctes=_LISTING_CTE)
def set_append(spark, sf_dir):
    _, listing, _, queue = _queue_parts(spark, sf_dir)
    new = listing.filter(F.col("date") >= F.lit(LAST_CRAWL).cast("date"))
    return _date_str(SO.set_append(queue, new))


@query("inc_skip_loaded", sql=f"""
SELECT {S.url_id('url')} AS id, url FROM lst WHERE {S.url_id('url')} NOT IN (SELECT id FROM loaded)""", ctes=_LISTING_CTE)
def inc_skip_loaded(spark, sf_dir):
    """All listing rows against all loaded matches."""
    _, listing, loaded, _ = _queue_parts(spark, sf_dir)
    return INC.skip_loaded(listing, loaded.select("id")).select("id", "url")


@query("inc_new_dims", sql=f"""
SELECT 'team' AS kind, t.id FROM (SELECT DISTINCT team_1_id AS id FROM g_matches WHERE date >= DATE '{FIRST_RUN}'
  UNION SELECT DISTINCT team_2_id FROM g_matches WHERE date >= DATE '{FIRST_RUN}') t
  WHERE t.id NOT IN (SELECT team_1_id FROM g_matches WHERE date < DATE '{FIRST_RUN}')
    AND t.id NOT IN (SELECT team_2_id FROM g_matches WHERE date < DATE '{FIRST_RUN}')
UNION ALL
SELECT 'tournament', t.id FROM (SELECT DISTINCT tournament_id AS id FROM g_matches WHERE date >= DATE '{FIRST_RUN}') t
  WHERE t.id NOT IN (SELECT tournament_id FROM g_matches WHERE date < DATE '{FIRST_RUN}')
UNION ALL
SELECT 'player', t.id FROM (SELECT DISTINCT p.player_id AS id FROM g_player_overview_stats p JOIN g_matches m ON m.id = p.match_id
  WHERE m.date >= DATE '{FIRST_RUN}') t
  WHERE t.id NOT IN (SELECT p.player_id FROM g_player_overview_stats p JOIN g_matches m ON m.id = p.match_id
                     WHERE m.date < DATE '{FIRST_RUN}')""")
def inc_new_dims(spark, sf_dir):
    """Teams, tournaments and players first referenced after the first run: the
    ones the next run has to load (anti join against what is stored)."""
    d = dom(spark, sf_dir)
    cut = F.lit(FIRST_RUN).cast("date")
    m = d.matches
    new_m, old_m = m.filter(F.col("date") >= cut), m.filter(F.col("date") < cut)

    def teams(x):
        return x.select(F.col("team_1_id").alias("ref_id")).unionByName(x.select(F.col("team_2_id").alias("ref_id")))

    pl = d.player_overview_stats.select("match_id", F.col("player_id").alias("ref_id")) \
        .join(m.select(F.col("id").alias("match_id"), "date"), "match_id")
    parts = [
        INC.new_dims(teams(new_m), teams(old_m).select(F.col("ref_id").alias("id")), "team"),
        INC.new_dims(new_m.select(F.col("tournament_id").alias("ref_id")),
                     old_m.select(F.col("tournament_id").alias("id")), "tournament"),
        INC.new_dims(pl.filter(F.col("date") >= cut), pl.filter(F.col("date") < cut).select(F.col("ref_id").alias("id")),
                     "player"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


_TTL_SQL = """
WITH w AS (
  SELECT concat('user:', user_id) AS key, props AS value, ts AS written_at,
    CASE event_type WHEN 'view' THEN ts + INTERVAL 24 HOUR WHEN 'click' THEN ts + INTERVAL 48 HOUR
      WHEN 'signup' THEN ts + INTERVAL 168 HOUR ELSE NULL END AS expires_at,
    event_id AS seq, event_type = 'error' AS is_delete FROM events),
l AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY written_at DESC, seq DESC) AS rn FROM w)
SELECT key, value, epoch_us(written_at) AS written_us, epoch_us(expires_at) AS expires_us FROM l
WHERE rn = 1 AND NOT is_delete AND (expires_at IS NULL OR expires_at > (SELECT max(ts) FROM events))"""


@query("inc_ttl_latest", sql=_TTL_SQL)
def inc_ttl_latest(spark, sf_dir):
    """Events as key/value writes with a TTL per type ('error' = delete):
    the live value of every key at the latest event time."""
    ev = dom(spark, sf_dir).t.events
    live = INC.ttl_latest(INC.event_writes(ev), ev.agg(F.max("ts").alias("now")))
    return live.select("key", "value",
                       F.unix_micros(F.col("written_at").cast("timestamp")).alias("written_us"),
                       F.unix_micros(F.col("expires_at").cast("timestamp")).alias("expires_us"))


@query("inc_ttl_stream", sql=_TTL_SQL)
def inc_ttl_stream(spark, sf_dir):
    """The same view kept by a stream: the writes land in two files, state per
    key with expiry timers, and what the changes leave at the latest event time."""
    writes = INC.event_writes(dom(spark, sf_dir).t.events)
    writes = writes.withColumns({c: F.col(c).cast("timestamp") for c in ("written_at", "expires_at")})
    middle = writes.agg(F.timestamp_micros(F.avg(F.unix_micros("written_at")).cast("long")).alias("middle"))
    halves = writes.join(F.broadcast(middle))
    landing, out, ckpt = (scratch_dir(spark, name) for name in ("ttl-landing", "ttl-changes", "ttl-ckpt"))
    land_files(halves.where("written_at <= middle").drop("middle"), landing, 1)
    land_files(halves.where("written_at > middle").drop("middle"), landing, 1)
    TTL.run_ttl_stream(spark, landing, writes.schema, out, ckpt, files_per_trigger=1)
    now = writes.agg(F.unix_micros(F.max("written_at")).alias("now_us"))
    live = TTL.latest_view(spark.read.parquet(out)).join(F.broadcast(now))
    return live.where("expires_us is null or expires_us > now_us").select("key", "value", "written_us", "expires_us")


#: Tables of the streaming ingest and the queries that give the same rows in one batch.
_STREAMED = {"matches": "job_matches", "match_maps": "job_match_maps", "round_stats": "job_rounds",
             "player_overview_stats": "job_player_stats", "players_duel_stats": "job_duels",
             "player_highlights": "job_highlights", "ban_pick_log": "job_vetoes"}


@query("inc_land_stream", sql=" UNION ALL ".join(
    f"SELECT '{table}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum({'id' if table == 'matches' else 'match_id'}) AS BIGINT)"
    f" AS id_sum FROM ({ORACLE[job]})" for table, job in _STREAMED.items()))
def inc_land_stream(spark, sf_dir):
    """Pages land in two files and half of them a second time; a stream runs
    all ingest jobs per micro-batch under the epoch ledger. One row per table of
    what the committed epochs hold: the batch result, once."""
    orders = dom(spark, sf_dir).t.orders
    landing, out, ckpt = (scratch_dir(spark, name) for name in ("landing", "ingested", "stream-ckpt"))
    early = F.year("o_orderdate") < 1995
    land_files(orders.where(early), landing, 1)
    land_files(orders.where(~early), landing, 1)
    land_files(orders.where(early), landing, 1)   # delivered a second time
    ST.run_ingest_stream(spark, landing, orders.schema, out, ckpt, ST.domain_of(spark, sf_dir), "o_orderkey", files_per_trigger=1)
    counts = []
    for table in _STREAMED:
        of = "id" if table == "matches" else "match_id"
        counts.append(ST.committed(spark, out, table).agg(F.count("*").alias("n_rows"), F.sum(of).alias("id_sum"))
                      .select(F.lit(table).alias("table_name"), "n_rows", "id_sum"))
    return reduce(lambda a, b: a.unionByName(b), counts)


@query("inc_land_events", sql="SELECT event_id, user_id, event_type, value FROM events")
def inc_land_events(spark, sf_dir):
    """Events land as files; a streaming run (availableNow) appends each
    micro-batch idempotently on event_id; the stored table equals the source
    once, even though every event is landed twice (a replay)."""
    ev = dom(spark, sf_dir).t.events.select("event_id", "user_id", "event_type", "value")
    landing = scratch_dir(spark, "landing")
    target = scratch_dir(spark, "landed")
    ckpt = scratch_dir(spark, "stream-ckpt")
    land_files(ev, landing, 4)
    land_files(ev, landing, 2)   # the same events delivered a second time (a replay)
    run_landing_stream(spark, landing, ev.schema, target, ckpt, ["event_id"])
    return spark.read.parquet(target)


# ------------------------------------------------------------------ 2.7 compares
@query("set_compare_rows", sql=f"""
SELECT m.id, CASE WHEN m.stage IS DISTINCT FROM j.stage THEN 'stage'
  WHEN m.tournament_id IS DISTINCT FROM j.tournament_id THEN 'tournament_id'
  WHEN m.team_1_id IS DISTINCT FROM j.team_1_id THEN 'team_1_id'
  WHEN m.team_2_id IS DISTINCT FROM j.team_2_id THEN 'team_2_id'
  WHEN m.team_1_rating IS DISTINCT FROM j.team_1_rating THEN 'team_1_rating' END AS first_diff
FROM g_matches m FULL OUTER JOIN ({QI.JOB_MATCHES_SQL}) j ON j.id = m.id
WHERE m.stage IS DISTINCT FROM j.stage OR m.tournament_id IS DISTINCT FROM j.tournament_id
  OR m.team_1_id IS DISTINCT FROM j.team_1_id OR m.team_2_id IS DISTINCT FROM j.team_2_id
  OR m.team_1_rating IS DISTINCT FROM j.team_1_rating""")
def set_compare_rows(spark, sf_dir):
    """Stored matches vs matches re-parsed from their pages, field by field
    (a missing rating parses as 0, so those rows differ on team_1_rating)."""
    d = dom(spark, sf_dir)
    return SO.compare_rows(d.matches, I.job_matches(d), ["id"],
                           ["stage", "tournament_id", "team_1_id", "team_2_id", "team_1_rating"])


@query("set_compare_bags", sql=f"""
WITH a AS (SELECT match_id, map_id, team_id, round_no, highlight_type, player_id, player_against_id, count(*) AS na
           FROM g_player_highlights GROUP BY ALL),
b AS (SELECT match_id, map_id, team_id, round_no, highlight_type, player_id, player_against_id, count(*) AS nb
      FROM jh GROUP BY ALL),
j AS (SELECT coalesce(a.match_id, b.match_id) AS match_id, coalesce(a.map_id, b.map_id) AS map_id,
        coalesce(a.team_id, b.team_id) AS team_id, coalesce(na, 0) AS na, coalesce(nb, 0) AS nb
      FROM a FULL OUTER JOIN b ON a.match_id = b.match_id AND a.map_id = b.map_id AND a.team_id = b.team_id
        AND a.round_no = b.round_no AND a.highlight_type = b.highlight_type AND a.player_id = b.player_id
        AND a.player_against_id = b.player_against_id)
SELECT match_id, map_id, team_id, CAST(sum(na) AS BIGINT) AS n_a, CAST(sum(nb) AS BIGINT) AS n_b,
  CAST(bool_and(na = nb) AS INTEGER) AS equal FROM j GROUP BY match_id, map_id, team_id""",
       ctes=QI.HIGHLIGHTS_CTES)
def set_compare_bags(spark, sf_dir):
    """Per (match, map, team): is the bag of stored highlight rows equal to
    the bag re-parsed from the highlight cells?"""
    d = dom(spark, sf_dir)
    cols = ["match_id", "map_id", "team_id", "round_no", "highlight_type", "player_id", "player_against_id"]
    return SO.compare_bags(d.player_highlights.select(*cols), I.job_highlights(d).select(*cols),
                           ["match_id", "map_id", "team_id"])


# ------------------------------------------------------------------ 2.12 extensions
@REG.page_job("match")
def _match_page(pages):
    return pages.select("url", "kind", R.url_id(F.regexp_replace("url", "^" + R.SITE, "")).alias("ref_id"))


@REG.page_job("team")
def _team_page(pages):
    return pages.select("url", "kind", R.url_id(F.regexp_replace("url", "^" + R.SITE, "")).alias("ref_id"))


@REG.page_job("tournament")
def _event_page(pages):
    return pages.select("url", "kind", R.url_id(F.regexp_replace("url", "^" + R.SITE, "")).alias("ref_id"))


@query("ext_page_jobs", sql="""
SELECT kind, CAST(count(*) AS BIGINT) AS n_pages, CAST(count(DISTINCT ref_id) AS BIGINT) AS n_ids FROM (
  SELECT u AS url, """ + S.page_route("u") + """ AS kind,
    """ + S.url_id(f"regexp_replace(u, '^{R.SITE}', '')") + """ AS ref_id
  FROM (SELECT concat('""" + R.SITE_URL + """', href) AS u FROM (
    SELECT url AS href FROM g_raw_matches UNION ALL SELECT team_1_href FROM g_raw_matches
    UNION ALL SELECT event_href FROM g_raw_matches))) WHERE kind IN ('match', 'team', 'tournament')
GROUP BY kind""")
def ext_page_jobs(spark, sf_dir):
    """Route every page to its kind, then run the job registered for it."""
    r = dom(spark, sf_dir).raw_matches
    pages = r.select(F.concat(F.lit(R.SITE_URL), F.col("url")).alias("url")).unionByName(
        r.select(F.concat(F.lit(R.SITE_URL), F.col("team_1_href")).alias("url"))).unionByName(
        r.select(F.concat(F.lit(R.SITE_URL), F.col("event_href")).alias("url")))
    routed = REG.route_pages(pages)
    outs = [job(routed.filter(F.col("kind") == kind)) for kind, job in REG.PAGE_JOBS.items()]
    allp = reduce(lambda a, b: a.unionByName(b), outs)
    return allp.groupBy("kind").agg(F.count(F.lit(1)).alias("n_pages"), F.countDistinct("ref_id").alias("n_ids"))


def _longest_streak(pdf: pd.DataFrame) -> pd.DataFrame:
    """User row logic (pandas): longest run of consecutive round wins per team on
    each map of the frame. A round without a winner is a run of its own."""
    pdf = pdf.sort_values(["match_id", "map_id", "round_no"])
    same = pdf[["match_id", "map_id", "team_won"]]
    run = (same != same.shift()).any(axis=1).cumsum()
    runs = pdf.groupby(run, sort=False).agg(match_id=("match_id", "first"), map_id=("map_id", "first"),
                                            team_id=("team_won", "first"), longest_streak=("round_no", "size"))
    keys = ["match_id", "map_id", "team_id"]
    won = runs[runs["team_id"].notna()].groupby(keys, as_index=False, sort=False).max()
    return pd.concat([won, runs[runs["team_id"].isna()]]) if runs["team_id"].isna().any() else won


@query("ext_row_apply", sql="""
WITH r AS (SELECT match_id, map_id, round_no, team_won,
  round_no - row_number() OVER (PARTITION BY match_id, map_id, team_won ORDER BY round_no) AS grp FROM g_round_stats)
SELECT match_id, map_id, team_won AS team_id, CAST(max(n) AS BIGINT) AS longest_streak FROM (
  SELECT match_id, map_id, team_won, grp, count(*) AS n FROM r GROUP BY match_id, map_id, team_won, grp)
GROUP BY match_id, map_id, team_won""")
def ext_row_apply(spark, sf_dir):
    """A user-supplied pandas function run on whole maps (groups of ≤ 24 rounds,
    bounded by the game), many in one Arrow batch."""
    r = dom(spark, sf_dir).round_stats.select("match_id", "map_id", "round_no", "team_won")
    return REG.apply_user_rows(r, ["match_id", "map_id"], _longest_streak,
                               "match_id long, map_id long, team_id long, longest_streak long")


# ------------------------------------------------------------------ job_extract
PAGE_SPECS = [
    ("title", "title", "text"),
    ("h1", "h1", "text"),
    ("link", "a[href]", "attr:href"),
    ("meta_description", "meta[name=description]", "attr:content"),
]


def _extract_batches(it):
    for pdf in it:
        out = []
        for pid, html in zip(pdf["page_id"].tolist(), pdf["html"].tolist()):
            for name, pos, raw in html_cells.extract(html, PAGE_SPECS):
                out.append((pid, name, pos, raw))
        yield pd.DataFrame(out, columns=["page_id", "field", "pos", "raw"]) if out else \
            pd.DataFrame({"page_id": pd.Series([], dtype="int64"), "field": pd.Series([], dtype="object"),
                          "pos": pd.Series([], dtype="int64"), "raw": pd.Series([], dtype="object")})


@query("job_extract")
def job_extract(spark, sf_dir):
    """Field specs over every page: long (page_id, field, pos, raw) cells.
    The HTML parsing is the one Python stage (mapInPandas, Arrow batches);
    no oracle: SQL cannot parse HTML (tested against hand-made pages)."""
    pages = dom(spark, sf_dir).t.pages.select("page_id", "html")
    return pages.mapInPandas(_extract_batches, "page_id long, field string, pos long, raw string")
