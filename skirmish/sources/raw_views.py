"""Raw page-fragment views for the ingest jobs, derived from
the driver tables and the domain facts, so that each parse job can be
checked against the clean table it rebuilds.

SQL twins live in ``fixture_sql.RAW_VIEWS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.operators.joins import bounded_broadcast


def _s(c: Column) -> Column:
    return c.cast("string")


def raw_tournaments(d) -> DataFrame:
    """One tournament page per customer: name, url, prize text, group link."""
    c = d.t.customer
    k, bal, nk = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_nationkey")
    prize = F.concat(F.lit("$"), F.format_number(F.floor(bal * 100).cast("bigint"), 0), F.lit(" USD"))
    return c.select(
        k.alias("id"), F.col("c_name").alias("name"),
        F.concat(F.lit("/event/"), _s(k), F.lit("/"), F.lower("c_mktsegment")).alias("url"),
        F.when(bal < 0, F.lit("TBD")).otherwise(prize).alias("prize_txt"),
        F.when(nk % 5 == 0, F.concat(F.lit("/event/group/vct-20"), _s(20 + nk % 6)))
         .otherwise(F.lit("/event/group/open")).alias("group_href"),
    )


def geography(d) -> DataFrame:
    """Country -> continent rows in file order (nation x region)."""
    n = d.t.nation.select("n_nationkey", "n_name", "n_regionkey")
    r = bounded_broadcast(d.t.region.select("r_regionkey", "r_name"))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_name").alias("country"), F.col("r_name").alias("continent"),
        F.col("n_nationkey").cast("bigint").alias("row_no"))


def raw_teams(d) -> DataFrame:
    """One team page per customer: name, shorthand, url, free-text location."""
    c = d.t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    geo = bounded_broadcast(geography(d).select(F.col("row_no").cast("int").alias("c_nationkey"),
                                                "country", "continent"))
    j = c.join(geo, "c_nationkey")
    k = F.col("c_custkey")
    return j.select(
        k.alias("id"),
        F.when(k % 3 == 0, F.concat(F.lit("T"), _s(k % 1000)))
         .when(k % 3 == 1, F.concat(F.lit("Team "), _s(k))).otherwise(F.col("c_name")).alias("name"),
        F.when(k % 2 == 0, F.lit("")).otherwise(F.concat(F.lit("C"), _s(k % 100))).alias("shorthand_txt"),
        F.concat(F.lit("/team/"), _s(k), F.lit("/"), F.lower("c_mktsegment")).alias("url"),
        F.when(k % 4 == 0, F.lower("country")).when(k % 4 == 1, F.col("country"))
         .when(k % 4 == 2, F.concat(F.lit("  "), F.col("continent")))
         .otherwise(F.concat(F.lit("Land "), F.col("c_mktsegment"))).alias("location_txt"),
    )


def raw_players(d) -> DataFrame:
    """One player page per player seen in the stats: name, url, country text."""
    p = d.player_overview_stats.select("player_id").distinct()
    n = bounded_broadcast(d.t.nation.select(F.col("n_nationkey").cast("bigint").alias("nk"), "n_name"))
    j = p.join(n, (p.player_id % 25) == n.nk)
    pid = F.col("player_id")
    return j.select(
        pid.alias("id"), F.concat(F.lit("p"), _s(pid)).alias("name"),
        F.concat(F.lit("/player/"), _s(pid), F.lit("/p"), _s(pid)).alias("url"),
        F.when(pid % 7 == 0, F.lit("")).otherwise(F.col("n_name")).alias("country_txt"))


def roster(d) -> DataFrame:
    """(match, map, team, display name, player id) from the stats table.

    A display name that occurs twice in a team keeps the player at the
    highest row position (ledger Q23); the row position of a player in the
    stats table is the last digit of its id. One small aggregate per team
    and map, co-partitioned on match_id.
    """
    p = d.player_overview_stats.filter(F.col("side") == "def")
    named = p.select("match_id", "map_id", "team_id", F.concat(F.lit("p"), _s(F.col("player_id"))).alias("name"),
                     "player_id", (F.col("player_id") % 10).alias("pos"))
    return dedupe_names(named)


def dedupe_names(named: DataFrame) -> DataFrame:
    return named.groupBy("match_id", "map_id", "team_id", "name").agg(
        F.max_by("player_id", "pos").alias("player_id"))


def raw_duel_grid(d) -> DataFrame:
    """Cells of the 5 x 5 duel matrices (kills, first kills, op kills): row i
    is a team-1 player, column j a team-2 player; a cell reads 'a b', blank
    when both are 0. Some matches have a cell that cannot be read."""
    g = d.players_duel_stats

    def cell(c: str) -> Column:
        a = F.col(f"team_1_player_{c}_vs_team_2_player")
        b = F.col(f"team_2_player_{c}_vs_team_1_player")
        return F.when((a == 0) & (b == 0), F.lit("")).otherwise(F.concat(_s(a), F.lit(" "), _s(b)))

    return g.select("match_id", "map_id", (F.col("team_1_player_id") % 10).alias("i"),
                    (F.col("team_2_player_id") % 10).alias("j"),
                    F.when((F.col("match_id") % 79 == 0) & (F.col("team_1_player_id") % 10 == 1)
                           & (F.col("team_2_player_id") % 10 == 1), F.lit("x")).otherwise(cell("kills")).alias("kills_txt"), cell("first_kills").alias("first_kills_txt"),
                    cell("op_kills").alias("op_kills_txt"))


def raw_duel_headers(d) -> DataFrame:
    """Row (team 1) and column (team 2) headers of the duel matrices; some
    matches name a player that the roster lacks."""
    mm = d.match_maps.select("match_id", "map_id", "team_1_id", "team_2_id",
                             F.explode(F.sequence(F.lit(0), F.lit(4))).alias("pos"))
    return mm.select("match_id", "map_id", "pos",
                     F.when((F.col("match_id") % 83 == 0) & (F.col("pos") == 2), F.lit("sub"))
                      .otherwise(F.concat(F.lit("p"), _s(F.col("team_1_id") * 10 + F.col("pos")))).alias("row_name"),
                     F.concat(F.lit("p"), _s(F.col("team_2_id") * 10 + F.col("pos"))).alias("col_name"))


def raw_highlight_cells(d) -> DataFrame:
    """Highlight table cells: row position 0-9 (0-4 team 1, 5-9 team 2), owner
    name (unknown in a round of some matches), round, type and the opponents'
    names (≤ 5 per cell)."""
    h = d.player_highlights
    mm = d.match_maps.select("match_id", "map_id", "team_1_id")
    j = h.join(mm, ["match_id", "map_id"])
    pos = F.when(F.col("team_id") == F.col("team_1_id"), F.col("player_id") % 10) \
        .otherwise(F.col("player_id") % 10 + 5)
    g = j.groupBy("match_id", "map_id", pos.alias("pos"), "player_id", "round_no", "highlight_type").agg(
        F.concat_ws(", ", F.sort_array(F.collect_list(F.concat(F.lit("p"), _s(F.col("player_against_id"))))))
         .alias("opponents_txt"))
    return g.select("match_id", "map_id", "pos",
                    F.when((F.col("match_id") % 89 == 0) & (F.col("round_no") == 3), F.lit("sub"))
                     .otherwise(F.concat(F.lit("p"), _s(F.col("player_id")))).alias("owner_txt"),
                    "round_no", "highlight_type", "opponents_txt")


def _mmss(sec: Column) -> Column:
    return F.concat(_s(F.floor(sec / 60).cast("bigint")), F.lit(":"), F.lpad(_s(sec % 60), 2, "0"))


def raw_map_tabs(d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Overview, performance and economy fragments per (match, game id); each
    tab also carries a match-wide 'all' fragment that the join must skip."""
    mm = d.match_maps
    gid = _s(F.col("map_id"))
    t1, t2 = F.col("team_1_id"), F.col("team_2_id")
    overview = mm.select(
        "match_id", gid.alias("game_id"), F.concat(F.lit("Map"), gid).alias("map_name"),
        F.when(F.col("duration").isNull(), F.lit("-")).otherwise(_mmss(F.col("duration"))).alias("duration_txt"),
        F.when(F.col("team_def_first") == t1, F.lit(" mod-ct ")).otherwise(F.lit("mod-t")).alias("def_first_class"),
        F.when(F.col("team_pick") == t1, F.lit("picked mod-1")).when(F.col("team_pick") == t2, F.lit("picked mod-2"))
         .otherwise(F.lit("picked")).alias("pick_class"),
        *[_s(F.col(f"team_{t}_{s}_score")).alias(f"t{t}_{s}_txt") for t in (1, 2) for s in ("def", "atk", "ot")])
    all_rows = d.matches.select(F.col("id").alias("match_id"), F.lit("all").alias("game_id"))
    overview = overview.unionByName(all_rows, allowMissingColumns=True)
    perf = d.players_duel_stats.groupBy("match_id", gid.alias("game_id")).agg(
        F.count(F.lit(1)).alias("n_duel_cells")).unionByName(all_rows, allowMissingColumns=True)
    eco = d.round_stats.groupBy("match_id", gid.alias("game_id")).agg(
        F.count(F.lit(1)).alias("n_rounds")).unionByName(all_rows, allowMissingColumns=True)
    return overview, perf, eco


def raw_listing(d) -> DataFrame:
    """Result listing pages, one per week: a date header cell per day and a
    link cell per match, in document order ``pos`` (latest day first)."""
    m = d.matches.select("id", "url", "date")
    ud = F.unix_date(F.col("date"))
    page = F.floor(ud / 7).cast("bigint")
    day_rank = (F.lit(6) - (ud - page * 7)).cast("bigint") * F.lit(1_000_000_000)
    header_txt = F.date_format(F.col("date"), "EEE, MMMM d, yyyy")
    days = m.select("date").distinct().select(
        page.alias("page_no"), day_rank.alias("pos"), F.lit("date").alias("kind"), header_txt.alias("txt"))
    links = m.select(page.alias("page_no"), (day_rank + F.col("id") + 1).alias("pos"), F.lit("link").alias("kind"),
                     F.col("url").alias("txt"))
    return days.unionByName(links)
