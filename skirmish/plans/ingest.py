"""Ingest jobs: raw page fragments -> clean tables, for all
pages at once.

Each job is column rules (functions.rules) + joins; a row a rule cannot
parse becomes null plus a violation, and the reference's failure scopes
(one bad round rejects its map, ledger Q22) are window ``bool_and`` splits.
Per-match work stays co-partitioned on match_id; dimension lookups are
broadcast only behind a row bound.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skirmish.functions import rules as R
from skirmish.operators.joins import bounded_broadcast, match_join
from skirmish.operators.windows import all_or_nothing, carry_forward, slot_team
from skirmish.sources import raw_views as RV
from skirmish.sources.fixtures import COUNT_STATS, Domain


def maps_by_name(d: Domain) -> DataFrame:
    return bounded_broadcast(d.maps.select(F.col("name").alias("map_name"), F.col("id").alias("map_id")))


# ------------------------------------------------------------------ matches
def job_matches(d: Domain) -> DataFrame:
    """Match header rows; url and date come from the queue, the rest from the page."""
    r = d.raw_matches
    return r.select(
        R.url_id(F.col("url")).alias("id"), "url", "date",
        R.url_id(F.col("event_href")).alias("tournament_id"),
        R.stage(F.col("series_txt")).alias("stage"),
        R.url_id(F.col("team_1_href")).alias("team_1_id"),
        R.url_id(F.col("team_2_href")).alias("team_2_id"),
        *[R.to_int(F.col(f"team_{t}_score_txt")).alias(f"team_{t}_score") for t in (1, 2)],
        *[R.rating(F.col(f"team_{t}_rating_txt")).alias(f"team_{t}_rating") for t in (1, 2)],
        R.duration(F.col("duration_txt")).alias("duration"),
    )


# ------------------------------------------------------------------ maps (join_tabs)
def join_tabs(d: Domain) -> DataFrame:
    """Overview ⋈ performance ⋈ economy fragments on (match, game id), the
    match-wide 'all' fragment excluded. Co-partitioned on match_id."""
    ov, perf, eco = RV.raw_map_tabs(d)
    keep = F.col("game_id") != "all"
    return ov.filter(keep).join(perf.filter(keep), ["match_id", "game_id"], "inner") \
             .join(eco.filter(keep), ["match_id", "game_id"], "inner")


def job_match_maps(d: Domain) -> DataFrame:
    t = join_tabs(d).join(maps_by_name(d), "map_name", "left")
    teams = d.matches.select(F.col("id").alias("match_id"), "team_1_id", "team_2_id")
    j = t.join(teams, "match_id")
    t1, t2 = F.col("team_1_id"), F.col("team_2_id")
    return j.select(
        "match_id", "map_id", R.duration(F.col("duration_txt")).alias("duration"), "team_1_id", "team_2_id",
        *[R.to_int(F.col(f"t{t}_{s}_txt")).alias(f"team_{t}_{s}_score") for t in (1, 2) for s in ("def", "atk", "ot")],
        R.def_first(F.col("def_first_class"), t1, t2).alias("team_def_first"),
        R.team_pick(F.col("pick_class"), t1, t2).alias("team_pick"),
        "n_rounds", "n_duel_cells",
    )


# ------------------------------------------------------------------ rounds
def parse_rounds(d: Domain, pistol_rounds=R.PISTOL_ROUNDS, raw: tuple[str, ...] = ()) -> DataFrame:
    """Raw round cells -> typed round rows, with the columns ``raw`` as they
    arrived in front of them as raw_<name>. Text cells are trimmed once in a
    first projection so every rule works on clean columns (keeps the
    generated code small and each trim evaluated once)."""
    text = ["t1_win_class", "win_class", "win_img", "t1_buy_txt", "t2_buy_txt", "t1_bank_txt", "t2_bank_txt"]
    r = d.raw_rounds.select("match_id", "map_id", "round_no", "team_1_id", "team_2_id",
                            *[R.strip(F.col(c)).alias(c) for c in text], *[F.col(c).alias(f"raw_{c}") for c in raw])
    t1, t2, rn = F.col("team_1_id"), F.col("team_2_id"), F.col("round_no")
    won = F.when(F.col("t1_win_class") == "", t2).otherwise(t1)       # f_team_won on trimmed text
    r = r.withColumn("team_won", won)
    return r.select(
        "match_id", "map_id", "round_no", "team_1_id", "team_2_id",
        R.team_def(F.col("win_class"), t1, t2, F.col("team_won"), trimmed=True).alias("team_def"),
        R.buy_type(F.col("t1_buy_txt"), rn, pistol_rounds, trimmed=True).alias("team_1_buy_type"),
        R.buy_type(F.col("t2_buy_txt"), rn, pistol_rounds, trimmed=True).alias("team_2_buy_type"),
        R.bank(F.col("t1_bank_txt"), trimmed=True).alias("team_1_bank"),
        R.bank(F.col("t2_bank_txt"), trimmed=True).alias("team_2_bank"),
        "team_won",
        R.won_method(F.col("win_img"), trimmed=True).alias("won_method"), *[f"raw_{c}" for c in raw],
    )


ROUND_FIELDS = ["team_def", "team_1_buy_type", "team_2_buy_type", "team_1_bank", "team_2_bank", "team_won",
                "won_method"]


def round_row_ok(cols=ROUND_FIELDS) -> Column:
    ok = F.lit(True)
    for c in cols:
        ok = ok & F.col(c).isNotNull()
    return ok


def job_rounds(d: Domain) -> tuple[DataFrame, DataFrame]:
    """(clean rounds, quarantined rows): one unparseable round rejects its
    whole map (win_all_or_nothing, map scope)."""
    return all_or_nothing(parse_rounds(d), ["match_id", "map_id"], round_row_ok())


def round_violations(d: Domain) -> DataFrame:
    """One row per failed field of a round, with the raw text (quarantine)."""
    p = parse_rounds(d, raw=("t1_bank_txt",)).withColumnRenamed("raw_t1_bank_txt", "t1_bank_txt")
    checks = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in ROUND_FIELDS])
    v = p.select("match_id", "map_id", "round_no", "t1_bank_txt", F.explode(checks).alias("rule"))
    return v.filter(F.col("rule").isNotNull())


def round_rejects(d: Domain) -> DataFrame:
    """Rounds of rejected maps, parsed and with their raw text."""
    parsed = parse_rounds(d, raw=("t1_bank_txt", "t2_bank_txt", "win_img"))
    return all_or_nothing(parsed, ["match_id", "map_id"], round_row_ok())[1]


# ------------------------------------------------------------------ player stats
def side_rounds_of_team(d: Domain, ot_mode: str = "fixed") -> DataFrame:
    """(match, map, team) -> def/atk rounds from the map scores (ledger Q9)."""
    mm = d.match_maps
    sr = R.side_rounds(*(F.col(f"team_{t}_{s}_score") for t in (1, 2) for s in ("def", "atk", "ot")),
                       ot_mode=ot_mode)
    both = mm.select("match_id", "map_id", F.inline(F.array(
        F.struct(F.col("team_1_id").alias("team_id"), sr["team_1_def_rounds"].alias("def_rounds"),
                 sr["team_1_atk_rounds"].alias("atk_rounds")),
        F.struct(F.col("team_2_id").alias("team_id"), sr["team_2_def_rounds"].alias("def_rounds"),
                 sr["team_2_atk_rounds"].alias("atk_rounds")))))
    return both


ROUND_STATS = ("rating", "acs", "kast", "adr")
PLAYER_STATS = ("rating", "acs", "kills", "deaths", "assists", "kast", "adr", "hs", "first_kills", "first_deaths")
PLAYER_KEYS = ("match_id", "map_id", "team_id", "player_id")


def fill_player_stats(d: Domain, ot_mode: str = "fixed") -> DataFrame:
    """Gap filling of all ten statistics: counts from the total, per-round ones
    weighted by the side's rounds, headshots by the filled kills. ``failed``
    lists the statistics whose gap cannot be filled."""
    raw = d.raw_player_stats.join(side_rounds_of_team(d, ot_mode), ["match_id", "map_id", "team_id"], "left")
    c = F.col
    filled, gaps = [], {}
    for s in COUNT_STATS + ROUND_STATS:
        cells = c(f"def_{s}"), c(f"atk_{s}"), c(f"both_{s}")
        def_v, atk_v, gaps[s] = (R.fill_count(*cells) if s in COUNT_STATS
                                 else R.fill_weighted(*cells, c("def_rounds"), c("atk_rounds")))
        filled += [v.alias(f"f_{side}_{s}") for side, v in (("def", def_v), ("atk", atk_v))]
    f = raw.select(*PLAYER_KEYS, "agent_name", "def_hs", "atk_hs", "both_hs", *filled,
                   F.array(*[F.when(~ok, F.lit(s)) for s, ok in gaps.items()]).alias("gaps"))
    def_hs, atk_hs, hs_ok = R.fill_weighted(c("def_hs"), c("atk_hs"), c("both_hs"), c("f_def_kills"), c("f_atk_kills"))
    failed = F.array_compact(F.concat("gaps", F.array(F.when(~hs_ok, F.lit("hs")))))
    f = f.select(*PLAYER_KEYS, "agent_name", *[f"f_{side}_{s}" for s in gaps for side in ("def", "atk")],
                 def_hs.alias("f_def_hs"), atk_hs.alias("f_atk_hs"), failed.alias("failed"))
    return f.select(*PLAYER_KEYS, "agent_name",
                    *[(c(f"f_{side}_{s}") if s in COUNT_STATS else R.round6(c(f"f_{side}_{s}"))).alias(f"{side}_{s}")
                      for s in [*gaps, "hs"] for side in ("def", "atk")], "failed")


def job_player_stats(d: Domain, ot_mode: str = "fixed") -> tuple[DataFrame, DataFrame]:
    """(side rows, rejected players): filled def/atk columns stacked into two
    side rows per player, the agent's name resolved to its id. One player with
    a gap that cannot be filled or an unknown agent rejects the match; the
    rejected players carry what failed (nothing for those that were sound)."""
    agents = bounded_broadcast(d.agents.select(F.col("name").alias("agent_name"), F.col("id").alias("agent_id")))
    f = fill_player_stats(d, ot_mode).join(agents, "agent_name", "left")
    f = f.withColumn("failed", F.when(F.col("agent_id").isNull(), F.array_append("failed", F.lit("agent")))
                     .otherwise(F.col("failed")))
    clean, bad = all_or_nothing(f, ["match_id"], F.size("failed") == 0)
    sides = ", ".join(f"'{side}', " + ", ".join(f"{side}_{s}" for s in PLAYER_STATS) for side in ("def", "atk"))
    rows = clean.select(*PLAYER_KEYS, "agent_id", F.expr(f"stack(2, {sides}) AS (side, {', '.join(PLAYER_STATS)})"))
    return rows, bad.select(*PLAYER_KEYS, F.array_join("failed", ",").alias("failed"))


# ------------------------------------------------------------------ rosters
def map_teams(d: Domain) -> DataFrame:
    """Teams of each map, each with its roster as a map from display name to
    player id: the game bounds it, and names are looked up in it without a join."""
    ro = RV.roster(d).where("team_id IS NOT NULL AND name IS NOT NULL")
    entries = ro.groupBy("match_id", "map_id").agg(F.collect_list(F.struct("team_id", "name", "player_id")).alias("roster"))

    def names(team: str) -> Column:
        own = F.filter("roster", lambda p: p["team_id"] == F.col(team))
        return F.map_from_entries(F.transform(own, lambda p: F.struct(p["name"], p["player_id"])))

    teams = match_join(d.match_maps.select("match_id", "map_id", "team_1_id", "team_2_id"), entries, ["match_id", "map_id"], "left")
    return teams.select("match_id", "map_id", "team_1_id", "team_2_id",
                        *[names(f"team_{t}_id").alias(f"team_{t}_names") for t in (1, 2)])


# ------------------------------------------------------------------ duels
def join_duel_grid(d: Domain) -> DataFrame:
    """Row header x column header x cell on (match, map, i, j). Header names
    are resolved to player ids on the header table first (5 rows per team
    and map); a map's headers meet its cells as two short lists, so the cells
    take one join, on (match, map)."""
    g = RV.raw_duel_grid(d)
    h = match_join(RV.raw_duel_headers(d), map_teams(d), ["match_id", "map_id"])
    h = h.select("match_id", "map_id", "pos", "row_name", F.col("team_1_names")[F.col("row_name")].alias("team_1_player_id"),
                 "col_name", F.col("team_2_names")[F.col("col_name")].alias("team_2_player_id"))
    lists = h.groupBy("match_id", "map_id").agg(
        F.collect_list(F.struct(F.col("pos").alias("row_pos"), "row_name", "team_1_player_id")).alias("rows"),
        F.collect_list(F.struct(F.col("pos").alias("col_pos"), "col_name", "team_2_player_id")).alias("cols"))
    j = match_join(g, lists, ["match_id", "map_id"])
    j = j.select(*g.columns, "cols", F.inline("rows")).where("row_pos = i").drop("row_pos")
    return j.select(*[c for c in j.columns if c != "cols"], F.inline("cols")).where("col_pos = j").drop("col_pos")


def _cell_part(c: Column, idx: int) -> Column:
    """'a b' -> a (idx 0) or b (idx 1); blank -> 0 (f_default_blank)."""
    part = F.get(F.split(R.strip(c), r"\s+"), F.lit(idx))
    return R.default_blank(c, 0, R.to_int(part)).cast("bigint")


DUEL_CELLS = ("kills", "first_kills", "op_kills")


def split_duels(d: Domain) -> tuple[DataFrame, DataFrame]:
    """(duels, rejected cells). Cells are trimmed and split once into arrays,
    then each number is read from its array (blank cell -> 0,
    f_default_blank). An unknown name or a cell that cannot be read rejects the
    duels of its map (25 rows); rejected cells keep their raw text and what
    failed in them."""
    j = join_duel_grid(d)
    keys = ["match_id", "map_id", "team_1_player_id", "team_2_player_id"]
    raw = F.concat_ws("|", F.col("i"), F.col("j"), "row_name", "col_name", *[f"{c}_txt" for c in DUEL_CELLS])
    arrays = j.select(*keys, "i", "j", raw.alias("raw"), *[R.strip_cell(F.col(f"{c}_txt")).alias(c) for c in DUEL_CELLS])
    arrays = arrays.withColumns({c: R.split_words(F.col(c)) for c in DUEL_CELLS})

    def part(c: str, idx: int) -> Column:
        arr = F.col(c)
        blank = (F.size(arr) == 1) & (arr.getItem(0) == "")
        text = F.get(arr, F.lit(idx))
        plain = text.try_cast("bigint")
        # Odd cells alone take the rule's patterns, in a lambda: inlined six
        # times they made the stage's method too large to be compiled.
        odd = F.transform(F.array(text), lambda x: R.to_int(x)).getItem(0)
        return F.when(blank, F.lit(0).cast("bigint")).when(plain.cast("string") == text, plain).otherwise(odd)

    out = [F.col(k) for k in keys]
    for c in DUEL_CELLS:
        out += [part(c, 0).alias(f"team_1_player_{c}_vs_team_2_player"),
                part(c, 1).alias(f"team_2_player_{c}_vs_team_1_player")]
    parsed = arrays.select(*out, "i", "j", "raw")
    fields = [c for c in parsed.columns if c not in ("match_id", "map_id", "i", "j", "raw")]
    sound = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in fields])
    clean, bad = all_or_nothing(parsed, ["match_id", "map_id"], sound)
    return clean.drop("i", "j", "raw"), bad.select("match_id", "map_id", "i", "j", "raw", _failed(fields))


def job_duels(d: Domain) -> DataFrame:
    return split_duels(d)[0]


def _failed(fields) -> Column:
    """The names of the fields that are null, one after another by a comma."""
    return F.array_join(F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in fields])), ",").alias("failed")


# ------------------------------------------------------------------ highlights
def _highlight_cells(d: Domain) -> DataFrame:
    """Highlight cells with their owner's id and whether all owners of the map are known."""
    c = match_join(RV.raw_highlight_cells(d), map_teams(d), ["match_id", "map_id"])

    def slot(a: str, b: str) -> Column:
        return slot_team(F.col("pos"), F.col(a), F.col(b))

    # owner resolved once per cell, before the opponents are exploded
    return c.select("match_id", "map_id", "round_no", "highlight_type", "pos", "owner_txt", "opponents_txt",
                    slot("team_1_id", "team_2_id").alias("team_id"),
                    slot("team_1_names", "team_2_names")[F.col("owner_txt")].alias("player_id"),
                    slot("team_2_names", "team_1_names").alias("opp_names"))


def split_highlights(d: Domain) -> tuple[DataFrame, DataFrame]:
    """(highlights, rejected cells). One row per highlight opponent. Owner slot
    0-4 -> team 1, 5-9 -> team 2 (win_slot); names -> ids via the roster; an
    unknown opponent -> 0, an unknown owner rejects all highlights of the map
    (Q17); rejected cells keep their raw text and what failed in them."""
    clean, bad = all_or_nothing(_highlight_cells(d), ["match_id", "map_id"], F.col("player_id").isNotNull())
    raw = F.concat_ws("|", F.col("round_no"), "highlight_type", F.col("pos"), "owner_txt", "opponents_txt")
    rejected = bad.select("match_id", "map_id", "round_no", raw.alias("raw"),
                          F.when(F.col("player_id").isNull(), "player_id").otherwise("").alias("failed"))
    c = clean.select("match_id", "map_id", "round_no", "team_id", "player_id", "highlight_type", "opp_names",
                     F.explode(F.split(F.col("opponents_txt"), ",")).alias("opp_txt"))
    against = F.col("opp_names")[R.strip(F.col("opp_txt"))]
    return c.select("match_id", "map_id", "round_no", "team_id", "player_id", "highlight_type",
                    F.coalesce(against, F.lit(0).cast("bigint")).alias("player_against_id")), rejected


def job_highlights(d: Domain) -> DataFrame:
    return split_highlights(d)[0]


def rejects(d: Domain) -> DataFrame:
    """The violations store: every row that a job rejected, whatever the job.

    job, scope (what is rejected as a whole: map or match), match_id, map_id,
    failed (the fields that could not be read, one after another by a comma;
    nothing for sound rows that fell with their scope) and raw, the row's text
    as it arrived. Each job parses once; the raw text travels with the row.
    """
    duels, highlights = split_duels(d)[1], split_highlights(d)[1]
    players = job_player_stats(d)[1]

    def part(df: DataFrame, job: str, scope: str, failed: Column, raw: Column) -> DataFrame:
        return df.select(F.lit(job).alias("job"), F.lit(scope).alias("scope"), "match_id", "map_id", failed.alias("failed"), raw.alias("raw"))

    round_text = F.concat_ws("|", F.col("round_no"), "raw_t1_bank_txt", "raw_t2_bank_txt", "raw_win_img")
    return (part(round_rejects(d), "rounds", "map", _failed(ROUND_FIELDS), round_text)
            .unionByName(part(players, "player_stats", "match", F.col("failed"), F.concat_ws("|", F.col("team_id"), F.col("player_id"))))
            .unionByName(part(duels, "duels", "map", F.col("failed"), F.col("raw")))
            .unionByName(part(highlights, "highlights", "map", F.col("failed"), F.col("raw"))))


# ------------------------------------------------------------------ vetoes
def job_vetoes(d: Domain) -> DataFrame:
    """Veto note -> turns: 'T ban Map' / 'T pick Map' (3 words) and
    'Map remains' (2 words); veto_order = position + 1; ban_pick_order =
    running count per (match, action), our definition (ledger Q14)."""
    v = d.veto_notes.select("match_id", "team_1_id", "team_2_id", "t1_short", "t2_short",
                            F.posexplode(F.split(F.col("note"), ";")).alias("pos", "turn"))
    w = F.split(R.strip(F.col("turn")), r"\s+")
    n = F.size(w)
    team_txt = F.when(n == 3, w.getItem(0))
    action_txt = F.when(n == 3, w.getItem(1)).when(n == 2, w.getItem(1))
    map_txt = F.when(n == 3, w.getItem(2)).when(n == 2, w.getItem(0))
    t = v.select("match_id", (F.col("pos") + 1).alias("veto_order"),
                 F.when(team_txt == F.col("t1_short"), F.col("team_1_id"))
                  .when(team_txt == F.col("t2_short"), F.col("team_2_id")).alias("team_id"),
                 F.when((n == 3) & action_txt.isin("ban", "pick"), action_txt)
                  .when((n == 2) & action_txt.isin("remains", "remain"), F.lit("remain")).alias("veto_action"),
                 map_txt.alias("map_name"))
    t = t.join(maps_by_name(d), "map_name", "left")
    order = Window.partitionBy("match_id", "veto_action").orderBy("veto_order")
    return t.select("match_id", "team_id", "veto_order", "map_id", "veto_action",
                    F.row_number().over(order).alias("ban_pick_order"))


# ------------------------------------------------------------------ dimensions
def name_parts(d: Domain, by: str) -> DataFrame:
    """Every part of a snake-cased geography name with the first row (file
    order) that contains it: (part, g). Names are short, so a name has a
    bounded number of parts, and "contains" becomes an equality."""
    g = RV.geography(d).select(R.snake(F.col(by)).alias("name"), F.struct("country", "continent", "row_no").alias("g"))
    starts = g.select("name", "g", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("i"))
    parts = starts.select("g", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("name") - F.col("i") + 1), lambda n: F.substring("name", F.col("i"), n))).alias("part"))
    return parts.groupBy("part").agg(F.min_by("g", F.col("g.row_no")).alias("g"))


def geo_lookup(names: DataFrame, d: Domain, name_col: str, by: str = "country") -> DataFrame:
    """Free text -> first geography row (file order) whose snake-cased
    ``by`` column contains the snake-cased text (ledger Q16; blank -> null):
    an equality join of the distinct names with the parts of all names."""
    distinct = names.select(F.col(name_col).alias("_place")).distinct() \
        .filter(F.col("_place").isNotNull() & (R.strip(F.col("_place")) != ""))
    first = distinct.withColumn("part", R.snake(F.col("_place"))).join(name_parts(d, by), "part")
    return first.select(F.col("_place").alias(name_col), F.col("g.country").alias(f"{by}_country"),
                        F.col("g.continent").alias(f"{by}_continent"))


def job_teams(d: Domain) -> DataFrame:
    """Country by country name, region by region name only (a team listed
    under a country has no region of its own)."""
    t = RV.raw_teams(d)
    # one row per distinct place: broadcast behind a bound, so a popular place
    # (few distinct values, many teams) never becomes one hot shuffle key
    by_country = bounded_broadcast(geo_lookup(t, d, "location_txt", "country"))
    by_region = bounded_broadcast(geo_lookup(t, d, "location_txt", "continent"))
    j = t.join(by_country, "location_txt", "left").join(by_region, "location_txt", "left")
    return j.select(
        "id", "name", R.short_name(F.col("name"), F.col("shorthand_txt")).alias("shorthand_name"), "url",
        F.col("country_country").alias("country"), F.col("continent_continent").alias("region"))


def job_players(d: Domain) -> DataFrame:
    p = RV.raw_players(d)
    by_country = bounded_broadcast(geo_lookup(p, d, "country_txt", "country"))
    j = p.join(by_country, "country_txt", "left")
    return j.select("id", "name", "url", F.col("country_country").alias("country"))


def job_tournaments(d: Domain) -> DataFrame:
    t = RV.raw_tournaments(d)
    prize = R.prize(F.col("prize_txt"))
    return t.select("id", "name", "url", prize.alias("prize_pool"),
                    R.tier_1(F.col("group_href"), prize).alias("tier_1"))


def dense_ids(df: DataFrame, order_col: str, start: Column | int) -> DataFrame:
    """Number rows 1..n by ``order_col`` without a single-partition window:
    range-sort, count per partition, prefix-sum the (few) partition counts,
    then row_number inside each partition."""
    s = df.repartitionByRange(order_col).sortWithinPartitions(order_col) \
          .withColumn("_part", F.spark_partition_id())
    counts = s.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offs = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")
                                                    .rowsBetween(Window.unboundedPreceding, -1))).alias("_off"))
    w = Window.partitionBy("_part").orderBy(order_col)
    out = s.join(F.broadcast(offs), "_part").withColumn(
        "_rn", F.row_number().over(w) + F.coalesce(F.col("_off"), F.lit(0)))
    start_col = start if isinstance(start, Column) else F.lit(start)
    return out.withColumn("id", start_col + F.col("_rn")).drop("_part", "_off", "_rn")


def stored_countries(d: Domain) -> DataFrame:
    """Country dimension as stored before the run: all but the last region's."""
    nation = d.t.nation
    last = nation.agg(F.max("n_regionkey").alias("last"))
    return nation.crossJoin(F.broadcast(last)).filter("n_regionkey < last").select(
        (F.col("n_nationkey") + 1).cast("bigint").alias("id"), F.col("n_name").alias("name"))


def job_dim_upsert(d: Domain) -> DataFrame:
    """Get-or-create countries: a place that geography resolves to a country
    the table lacks adds that country, with ids after the current max in name
    order; an unresolved place adds nothing."""
    existing = stored_countries(d)
    new_names = job_teams(d).select(F.col("country").alias("name")).filter(F.col("name").isNotNull()) \
        .distinct().join(existing.select("name"), "name", "left_anti")
    start = existing.agg(F.coalesce(F.max("id"), F.lit(0)).alias("start"))
    numbered = dense_ids(new_names, "name", 0).crossJoin(F.broadcast(start)) \
        .select((F.col("start") + F.col("id")).alias("id"), "name")
    return existing.unionByName(numbered)


# ------------------------------------------------------------------ listing
def job_listing(d: Domain) -> DataFrame:
    """Carry each date header down to the links after it on the same page, block
    by block: a page of any length takes no long task."""
    header = F.when(F.col("kind") == "date", F.col("txt"))
    carried = carry_forward(RV.raw_listing(d), ["page_no"], "pos", header, "header")
    links = carried.filter(F.col("kind") == "link")
    return links.select(F.col("txt").alias("url"), R.listing_date(F.col("header")).alias("date"))


def pair_cells(a: DataFrame, b: DataFrame, on: list[str], a_name: str, b_name: str) -> DataFrame:
    """Full pairing of two positioned fragments; ``missing`` names the fragment
    that lacks the cell (null: both have it)."""
    x, y = a.withColumn("_a", F.lit(True)), b.withColumn("_b", F.lit(True))
    missing = F.when(F.col("_a").isNull(), a_name).when(F.col("_b").isNull(), b_name)
    return x.join(y, on, "full").withColumn("missing", missing).drop("_a", "_b")
