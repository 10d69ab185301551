"""Feature jobs, computed for every team, map and match at once.

Layout and shuffles
-------------------
All fact views are hash-partitioned on match_id (``Domain.matches``), and the
session lets a join on (match_id, ...) reuse that partitioning, so every
per-match step below (round flags, player pivot, highlight counts, map
composition) runs without an exchange. Only the steps that cross matches
shuffle: team history and league map form, each on a (key, date bucket)
key, never on a bare low-cardinality key.

No group is collected into an array unless its size is bounded by the game
itself (≤ 5 players, ≤ 3 maps per match); league-wide lists (map form, a
team's history) stay long-form rows keyed by (target, ...).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.functions.rules import round6
from skirmish.operators import loaders as L
from skirmish.operators.joins import match_join
from skirmish.operators.ranges import bundled, expanded, numbered, opened, ranges
from skirmish.sources.fixtures import Domain

CLUTCH_TYPES = ["1v1", "1v2", "1v3", "1v4", "1v5"]
MULTIKILL_TYPES = ["2k", "3k", "4k", "5k"]
ROLE_COUNTS = [("duelists", "duelist"), ("controllers", "controller"),
               ("sentinels", "sentinel"), ("initiators", "initiator")]


def rate(num: Column, den: Column) -> Column:
    """num / den as double, 0 when den is 0 or null (ledger Q3).
    The guard makes the division safe under ANSI mode (only evaluated when den != 0)."""
    d = den.cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(0.0)).otherwise(F.coalesce(num.cast("double") / d, F.lit(0.0)))


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


# ------------------------------------------------------------------ rounds
def clutch_teams(d: Domain) -> DataFrame:
    """Per map: the (round, team) pairs with a clutch highlight, at most two a
    round. They are made distinct by a hash aggregate, so the list, which takes a
    sort, is built of one row per pair and not of one per opponent."""
    h = d.player_highlights.filter(F.col("highlight_type").isin(CLUTCH_TYPES))
    pairs = h.where("round_no IS NOT NULL AND team_id IS NOT NULL").select("match_id", "map_id", "round_no", "team_id").distinct()
    return pairs.groupBy("match_id", "map_id").agg(F.collect_list(_clutch("round_no", "team_id")).alias("clutch_teams"))


def _clutch(round_no: str, team: str) -> Column:
    return F.struct(F.col(round_no).cast("bigint").alias("round_no"), F.col(team).cast("bigint").alias("team_id"))


def feat_rounds(d: Domain) -> DataFrame:
    r = match_join(d.round_stats, clutch_teams(d), ["match_id", "map_id"], "left")
    r = r.withColumns({f"clutch_{t}": F.array_contains("clutch_teams", _clutch("round_no", f"team_{t}_id")) for t in (1, 2)})
    f = L.flip(r, ["match_id", "map_id", "round_no", "team_def", "team_won", "won_method"],
               {**L.ROUND_PAIRS, "clutch": ("clutch_1", "clutch_2"), "clutch_against": ("clutch_2", "clutch_1")})
    won = F.col("team_won") == F.col("team_id")
    lost = ~won
    m = F.col("won_method")
    own, opp = F.col("team_buy_type"), F.col("team_against_buy_type")

    def thrifty(a: Column, b: Column) -> Column:
        return ((a == "eco") & b.isin("semi_buy", "full_buy")) | ((a == "semi_eco") & (b == "full_buy"))

    cols = [
        "match_id", "map_id", "team_id", "round_no",
        (F.col("team_def") == F.col("team_id")).cast("int").alias("def"),
        "team_buy_type", "team_against_buy_type", "team_bank", "team_against_bank",
        won.cast("int").alias("won"),
    ]
    for tag, method in (("elim", "eliminate"), ("spike_explode", "spike_explode"),
                        ("defuse", "defuse"), ("timeout", "out_of_time")):
        cols += [flag(won & (m == method)).alias(f"won_buy_{tag}"),
                 flag(lost & (m == method)).alias(f"loss_buy_{tag}")]
    cols += [
        flag(won & thrifty(own, opp)).alias("won_by_thrifty"),
        flag(lost & thrifty(opp, own)).alias("loss_by_thrifty"),
        flag(won & F.col("clutch")).alias("won_buy_clutch"),
        flag(lost & F.col("clutch_against")).alias("loss_buy_clutch"),
    ]
    return f.select(*cols)


# ------------------------------------------------------------------ players
SIDE_STATS = ["agent_id", "rating", "acs", "kills", "deaths", "assists", "kast", "adr", "hs",
              "first_kills", "first_deaths"]
PLAYER_KEYS = ["match_id", "map_id", "team_id", "player_id"]


def side_pivot(players: DataFrame) -> DataFrame:
    """Two side rows -> one row per player (def_*/atk_* columns) + row counts."""
    side = F.col("side")
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            F.count_if(side == "def").alias("n_def"),
            F.count_if(side == "atk").alias("n_atk")]
    for c in SIDE_STATS:
        aggs.append(F.max(F.when(side == "def", F.col(c))).alias(f"def_{c}"))
        aggs.append(F.max(F.when(side == "atk", F.col(c))).alias(f"atk_{c}"))
    return players.groupBy(*PLAYER_KEYS).agg(*aggs)


def round_counts(d: Domain) -> DataFrame:
    """Total, def and atk rounds per (match, map, team): aggregated per map
    on the unflipped rounds, then flipped (2 rows per map, not per round)."""
    r = d.round_stats
    per_map = r.groupBy("match_id", "map_id", "team_1_id", "team_2_id").agg(
        F.count(F.lit(1)).alias("rounds"),
        F.count_if(F.col("team_def") == F.col("team_1_id")).alias("def_1"),
        F.count_if(F.col("team_def") == F.col("team_2_id")).alias("def_2"))
    f = L.flip(per_map, ["match_id", "map_id", "rounds"], {"team_id": ("team_1_id", "team_2_id"),
                                                          "def_rounds": ("def_1", "def_2")})
    return f.withColumn("atk_rounds", F.col("rounds") - F.col("def_rounds"))


def enriched_highlights(d: Domain) -> DataFrame:
    """Highlights once per (match, map, team, player, round, type) with the
    round's def/won for that team (ledger Q5, Q6). Joined to the unflipped
    rounds on (match, map, round): one round row serves both teams."""
    keys = ["match_id", "map_id", "team_id", "player_id", "round_no", "highlight_type"]
    h = d.player_highlights.select(*keys).dropDuplicates(keys)
    r = d.round_stats.select("match_id", "map_id", "round_no", "team_1_id", "team_2_id", "team_def", "team_won")
    j = h.join(r, ["match_id", "map_id", "round_no"], "inner") \
         .filter(F.col("team_id").isin(F.col("team_1_id"), F.col("team_2_id")))
    return j.select(*keys, (F.col("team_def") == F.col("team_id")).cast("int").alias("def"),
                    (F.col("team_won") == F.col("team_id")).cast("int").alias("won"))


def highlight_counts(d: Domain) -> DataFrame:
    h = enriched_highlights(d)
    t, dfn, won = F.col("highlight_type"), F.col("def"), F.col("won")
    aggs = []
    for kind in CLUTCH_TYPES + MULTIKILL_TYPES:
        aggs += [F.count_if((t == kind) & (dfn == 1)).alias(f"n_def_{kind}"),
                 F.count_if((t == kind) & (dfn == 0)).alias(f"n_atk_{kind}"),
                 F.count_if(t == kind).alias(f"n_{kind}")]
    for kind in MULTIKILL_TYPES:
        aggs += [F.avg(F.when((t == kind) & (dfn == 1), won)).alias(f"cv_def_{kind}"),
                 F.avg(F.when((t == kind) & (dfn == 0), won)).alias(f"cv_atk_{kind}"),
                 F.avg(F.when(t == kind, won)).alias(f"cv_{kind}")]
    return h.groupBy(*PLAYER_KEYS).agg(*aggs)


def player_feature_columns() -> list[Column]:
    """The 71 feature columns, in the reference's order, over the joined frame;
    rates are not rounded yet (``rounded``)."""
    c = F.col
    D, A = c("def_rounds"), c("atk_rounds")
    T = D + A
    cols: list[Column] = [c("def_agent_id").alias("agent_id"), c("role")]

    def weighted(m: str) -> list[Column]:
        return [c(f"def_{m}").alias(f"def_{m}"), c(f"atk_{m}").alias(f"atk_{m}"),
                rate(c(f"def_{m}") * D + c(f"atk_{m}") * A, T).alias(m)]

    def per_round(src: str, out: str) -> list[Column]:
        return [rate(c(f"def_{src}"), D).alias(f"def_{out}_per_round"),
                rate(c(f"atk_{src}"), A).alias(f"atk_{out}_per_round"),
                rate(c(f"def_{src}") + c(f"atk_{src}"), T).alias(f"{out}_per_round")]

    cols += weighted("rating") + weighted("acs")
    cols += per_round("kills", "kills") + per_round("deaths", "deaths") + per_round("assists", "assists")
    cols += weighted("kast") + weighted("adr")
    kills_t = c("def_kills") + c("atk_kills")
    cols += [c("def_hs").alias("def_hs"), c("atk_hs").alias("atk_hs"),
             rate(c("def_hs") * c("def_kills") + c("atk_hs") * c("atk_kills"), kills_t).alias("hs")]
    cols += per_round("first_kills", "fk") + per_round("first_deaths", "fd")

    def n(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0))

    for kind in CLUTCH_TYPES:
        cols += [rate(n(f"n_def_{kind}"), D).alias(f"def_{kind}_per_round"),
                 rate(n(f"n_atk_{kind}"), A).alias(f"atk_{kind}_per_round"),
                 rate(n(f"n_{kind}"), T).alias(f"{kind}_per_round")]
    for kind in MULTIKILL_TYPES:
        k = kind[0]
        for pre, cnt, cv, den in (("def_", f"n_def_{kind}", f"cv_def_{kind}", D),
                                  ("atk_", f"n_atk_{kind}", f"cv_atk_{kind}", A),
                                  ("", f"n_{kind}", f"cv_{kind}", T)):
            cols += [rate(n(cnt), den).alias(f"{pre}{k}ks_per_round"),
                     F.coalesce(c(cv), F.lit(0.0)).alias(f"{pre}{k}ks_convert_rate")]
    return cols


#: Feature columns that are taken from the side rows as they are.
UNROUNDED = {"agent_id", "role", *[f"{s}_{m}" for s in ("def", "atk") for m in ("rating", "acs", "kast", "adr", "hs")]}


def rounded(features: DataFrame) -> DataFrame:
    """Every rate rounded to 6 places, in a projection of its own."""
    keep = {*PLAYER_KEYS, *UNROUNDED}
    return features.select(*[c if c in keep else round6(F.col(c)).alias(c) for c in features.columns])


def player_inputs(d: Domain) -> tuple[DataFrame, DataFrame]:
    """(clean pivot with role, violations): players without exactly one def
    and one atk row go to violations (ledger Q4)."""
    piv = side_pivot(d.player_overview_stats)
    ok = (F.col("n_def") == 1) & (F.col("n_atk") == 1)
    clean = L.join_role(piv.filter(ok).withColumnRenamed("def_agent_id", "agent_id"), d) \
        .withColumnRenamed("agent_id", "def_agent_id")
    bad = piv.filter(~ok).select(*PLAYER_KEYS, "n_rows", "n_def", "n_atk")
    return clean, bad


def feat_players(d: Domain) -> DataFrame:
    clean, _ = player_inputs(d)
    j = (clean.join(round_counts(d), ["match_id", "map_id", "team_id"], "left")
         .join(highlight_counts(d), PLAYER_KEYS, "left"))
    j = j.fillna(0, subset=["def_rounds", "atk_rounds"])
    return rounded(j.select(*PLAYER_KEYS, *player_feature_columns()))


# ------------------------------------------------------------------ maps
def composition(players: DataFrame, keys: list[str]) -> DataFrame:
    """Agents (sorted distinct) and role counts over side='def' rows per ``keys``."""
    role = F.col("role")
    p = players.filter(F.col("side") == "def")
    return p.groupBy(*keys).agg(
        F.sort_array(F.collect_set("agent_id")).alias("agents"),
        *[F.count_if(role == r).alias(name) for name, r in ROLE_COUNTS])


def _players_with_role(d: Domain) -> DataFrame:
    return L.join_role(d.player_overview_stats, d)


def match_map_sides(d: Domain) -> DataFrame:
    """Per (match, map, team): oriented scores and duration."""
    return L.flip(d.match_maps, ["match_id", "map_id", "duration"], {
        "team_id": ("team_1_id", "team_2_id"),
        "team_against_id": ("team_2_id", "team_1_id"),
        "team_def_score": ("team_1_def_score", "team_2_def_score"),
        "team_atk_score": ("team_1_atk_score", "team_2_atk_score"),
        "team_ot_score": ("team_1_ot_score", "team_2_ot_score"),
        "team_against_def_score": ("team_2_def_score", "team_1_def_score"),
        "team_against_atk_score": ("team_2_atk_score", "team_1_atk_score"),
        "team_against_ot_score": ("team_2_ot_score", "team_1_ot_score"),
    })


def feat_match_maps(d: Domain) -> DataFrame:
    """Per (match, map, team): oriented scores, duration, both compositions."""
    comp = composition(_players_with_role(d), ["match_id", "map_id", "team_id"])
    own = comp.select("match_id", "map_id", "team_id", F.col("agents").alias("team_agents"),
                      *[F.col(n).alias(f"team_{n}") for n, _ in ROLE_COUNTS])
    opp = comp.select("match_id", "map_id", F.col("team_id").alias("team_against_id"),
                      F.col("agents").alias("team_against_agents"),
                      *[F.col(n).alias(f"team_against_{n}") for n, _ in ROLE_COUNTS])
    f = match_map_sides(d)
    j = match_join(match_join(f, own, ["match_id", "map_id", "team_id"], "left"),
                  opp, ["match_id", "map_id", "team_against_id"], "left")
    return j.select(
        "match_id", "team_id", "team_against_id", "map_id",
        "team_def_score", "team_atk_score", "team_ot_score",
        "team_against_def_score", "team_against_atk_score", "team_against_ot_score", "duration",
        "team_agents", "team_against_agents",
        *[F.coalesce(F.col(f"team_{n}"), F.lit(0)).alias(f"team_{n}") for n, _ in ROLE_COUNTS],
        *[F.coalesce(F.col(f"team_against_{n}"), F.lit(0)).alias(f"team_against_{n}") for n, _ in ROLE_COUNTS],
    )


def feat_maps(d: Domain, scope: str = "match") -> DataFrame:
    """Per (match, map), team-neutral. ``scope='match'`` reproduces the
    reference (compositions span all maps of the match, ledger Q7);
    ``scope='map'`` restricts them to the map."""
    keys = ["match_id", "team_id"] if scope == "match" else ["match_id", "map_id", "team_id"]
    comp = composition(_players_with_role(d), keys)
    mm = d.match_maps
    join_keys = ["match_id"] if scope == "match" else ["match_id", "map_id"]
    out = mm
    for t in ("team_1", "team_2"):
        c = comp.select(*join_keys, F.col("team_id").alias(f"{t}_id"),
                        F.col("agents").alias(f"{t}_agents"),
                        *[F.col(n).alias(f"{t}_{n}") for n, _ in ROLE_COUNTS])
        out = match_join(out, c, join_keys + [f"{t}_id"], "left")
    return out.select(
        "match_id", "map_id",
        "team_1_def_score", "team_1_atk_score", "team_1_ot_score",
        "team_2_def_score", "team_2_atk_score", "team_2_ot_score", "duration",
        "team_1_agents", "team_2_agents",
        *[F.coalesce(F.col(f"team_1_{n}"), F.lit(0)).alias(f"team_1_{n}") for n, _ in ROLE_COUNTS],
        *[F.coalesce(F.col(f"team_2_{n}"), F.lit(0)).alias(f"team_2_{n}") for n, _ in ROLE_COUNTS],
    )


def feat_duels(d: Domain) -> DataFrame:
    return L.load_duels(d)


# ------------------------------------------------------------------ dataset
def targets(d: Domain) -> DataFrame:
    """Every match is a target: (team 1, team 2, stage, tier, date).

    The tier comes from the tournament dimension. Only the tournaments the
    targets reference are kept (semi join), and that subset is broadcast
    behind a row bound, so a popular tournament never becomes one hot
    shuffle key.
    """
    from skirmish.operators.joins import bounded_broadcast
    from skirmish.plans.ingest import job_tournaments
    m = d.matches
    used = job_tournaments(d).select(F.col("id").alias("tournament_id"), F.col("tier_1").alias("tier")) \
        .join(m.select("tournament_id").distinct(), "tournament_id", "left_semi")
    t = m.join(bounded_broadcast(used), "tournament_id", "left")
    return t.select(F.col("id").alias("target_id"), F.col("date").alias("target_date"),
                    "stage", "tier", "team_1_id", "team_2_id")


def latest_targets(d: Domain) -> DataFrame:
    """The targets of the last day that has matches: those to be predicted next."""
    t = targets(d)
    last = t.agg(F.max("target_date").alias("target_date"))
    return t.join(F.broadcast(last), "target_date", "left_semi")


def _sides(t: DataFrame) -> DataFrame:
    """One row per target and side (1, 2) with that side's team."""
    return t.select("target_id", "target_date", "stage", "tier", F.inline(F.array(
        F.struct(F.col("team_1_id").alias("team_id"), F.lit(1).alias("side")),
        F.struct(F.col("team_2_id").alias("team_id"), F.lit(2).alias("side")))))


def team_sequence(d: Domain) -> DataFrame:
    """Both perspectives of all matches, numbered per team by (date, match)."""
    h = L.load_matches(d).select(
        F.col("id").alias("history_id"), F.col("date").alias("history_date"), "team_id", "team_against_id",
        F.col("stage").alias("history_stage"), "team_score", "team_against_score", "team_rating", "team_against_rating")
    return numbered(h, ["team_id"], "history_date", ["history_id"])


def history_ranges(d: Domain, named: DataFrame | None = None, days: int = L.HISTORY_DAYS) -> DataFrame:
    """Per target and side: that team's matches in [D - days, D) as a range
    (lo, hi] of ``team_sequence``. ``named``: a table like ``targets`` (any
    teams and date, played or not); without it every match is a target."""
    t = _sides(targets(d) if named is None else named)
    events = L.load_matches(d).select("team_id", F.col("date").alias("target_date"))
    return t.join(ranges(events, t, ["team_id"], "target_date", days), ["team_id", "target_date"])


TARGET = ["target_id", "stage", "tier", "side"]


def day_history(d: Domain, named: DataFrame | None = None, days: int = L.HISTORY_DAYS, events: DataFrame | None = None,
                of: list[str] = TARGET) -> DataFrame:
    """What the targets of one team and day share: a row per (team_id,
    target_date, history match), with the columns ``of`` of these targets in
    lists (``opened`` makes a row of each). ``events``: ``team_sequence``, or what
    was joined to it; whatever hangs on the history match alone is joined there,
    before the windows multiply it, and what hangs on the day as well is worked
    out before the lists are opened."""
    shared = ["team_id", "target_date", "lo", "hi"]
    days_of_teams = bundled(history_ranges(d, named, days).select(*shared, *of), shared)
    return expanded(days_of_teams, team_sequence(d) if events is None else events, ["team_id"]).drop("seq")


def team_history(d: Domain, named: DataFrame | None = None, days: int = L.HISTORY_DAYS,
                 events: DataFrame | None = None) -> DataFrame:
    """``history_ranges`` expanded: one row per (target, side, history match).
    ``events``: as in ``day_history``."""
    rows = opened(day_history(d, named, days, events))
    first = ["team_id", "target_date", *TARGET]
    return rows.select(*first, *[c for c in rows.columns if c not in first])


def _map_games(d: Domain) -> DataFrame:
    return L.load_maps(d).select(F.col("match_id").alias("form_match_id"), "map_id", F.col("date").alias("form_date"))


def map_sequence(d: Domain) -> DataFrame:
    """All league maps, numbered per map_id by (date, match)."""
    return numbered(_map_games(d), ["map_id"], "form_date", ["form_match_id"])


def form_ranges(d: Domain, keys: DataFrame | None = None, days: int = L.HISTORY_DAYS) -> DataFrame:
    """Per (form date D, map_id): the league maps with that map_id in
    [D - days, D) (ledger Q8: the history match itself included) as a range of
    ``map_sequence``. ``keys``: the wanted pairs; without it those of all matches."""
    games = _map_games(d)
    return ranges(games, games if keys is None else keys, ["map_id"], "form_date", days)


def map_form(d: Domain, keys: DataFrame | None = None, days: int = L.HISTORY_DAYS,
             events: DataFrame | None = None, text: bool = False) -> DataFrame:
    """``form_ranges`` expanded: one row per (form date, map_id, league map).
    ``events``: ``map_sequence`` with other columns joined to it. ``text``: the
    form date as text, made once per range."""
    games = (map_sequence(d) if events is None else events).drop("form_date")
    forms = form_ranges(d, keys, days)
    if text:
        forms = forms.withColumn("form_date", F.col("form_date").cast("string"))
    return expanded(forms, games, ["map_id"]).drop("seq")


def forms_by_date(d: Domain, dates: DataFrame, days: int = L.HISTORY_DAYS) -> DataFrame:
    """Per date of ``dates`` (form_date) the forms of all maps at that date, as
    map_id -> (lo, hi). A row a day with an entry a map: small enough to be
    broadcast to rows that the windows have multiplied."""
    maps = d.match_maps.select("map_id").where("map_id IS NOT NULL").distinct()
    keys = dates.select("form_date").where("form_date IS NOT NULL").distinct().crossJoin(maps)
    entry = F.struct("map_id", F.struct("lo", "hi").alias("form"))
    return form_ranges(d, keys, days).groupBy("form_date").agg(F.map_from_entries(F.collect_list(entry)).alias("forms"))


def _target_dates(d: Domain, named: DataFrame | None) -> DataFrame:
    return d.matches.select(F.col("date").alias("form_date")) if named is None else \
        named.select(F.col("target_date").alias("form_date"))


def feat_append_maps(d: Domain, named: DataFrame | None = None, days: int = L.HISTORY_DAYS,
                     maps: DataFrame | None = None, text: bool = False) -> DataFrame:
    """(target, side, history match, map) -> the map's 17 features from the
    history team's perspective, and its map form as a range (form_lo, form_hi]
    of ``map_sequence`` at the target's date. ``maps``: ``feat_match_maps`` with
    its columns as they are wanted. ``text``: form_date as text."""
    mm = (feat_match_maps(d) if maps is None else maps).where("map_id IS NOT NULL").withColumnRenamed("match_id", "history_id")
    events = team_sequence(d).select("history_id", "team_id", "team_against_id", "seq").join(
        mm, ["history_id", "team_id", "team_against_id"])
    j = day_history(d, named, days, events, ["target_id", "side"]).withColumnRenamed("target_date", "form_date")
    j = j.join(F.broadcast(forms_by_date(d, _target_dates(d, named), days)), "form_date")
    form = F.col("forms")[F.col("map_id")]
    j = j.withColumns({"form_lo": form["lo"], "form_hi": form["hi"]}).drop("team_id", "team_against_id", "forms")
    rows = opened(j.withColumn("form_date", F.col("form_date").cast("string")) if text else j)
    first = ["form_date", "target_id", "side"]
    return rows.select(*first, *[c for c in rows.columns if c not in first])


MAP_FEATURES = ["team_def_score", "team_atk_score", "team_ot_score", "team_against_def_score", "team_against_atk_score",
                "team_against_ot_score", "duration", "team_agents", "team_against_agents",
                *[f"team_{n}" for n, _ in ROLE_COUNTS], *[f"team_against_{n}" for n, _ in ROLE_COUNTS]]
FORM_FEATURES = ["team_1_def_score", "team_1_atk_score", "team_1_ot_score", "team_2_def_score", "team_2_atk_score",
                 "team_2_ot_score", "duration", "team_1_agents", "team_2_agents",
                 *[f"team_1_{n}" for n, _ in ROLE_COUNTS], *[f"team_2_{n}" for n, _ in ROLE_COUNTS]]


def rounds_of_stored_matches(matches: DataFrame, maps: DataFrame, rounds: DataFrame) -> DataFrame:
    """Per match: maps, rounds and those that team 1 won, from three tables in
    buckets of match_id."""
    j = rounds.select("match_id", "map_id", "team_won").join(maps.select("match_id", "map_id").hint("merge"), ["match_id", "map_id"])
    j = j.join(matches.select("match_id", "team_1_id", "team_1_score").hint("merge"), "match_id")
    return j.groupBy("match_id", "team_1_score").agg(
        F.countDistinct("map_id").alias("n_maps"), F.count("*").alias("n_rounds"),
        F.count_if(F.col("team_won") == F.col("team_1_id")).alias("team_1_rounds"))


FORM_PART = 1000  # games of a form that are nested in one row


def match_documents(d: Domain, maps: DataFrame | None = None) -> DataFrame:
    """Per match and team its maps nested (at most three): map_id and the 17
    features, or the columns of ``maps`` (match_id, team_id, map_id, ...)."""
    fm = (feat_match_maps(d).select("match_id", "team_id", "map_id", *MAP_FEATURES) if maps is None else maps)
    one_map = F.struct("map_id", *[c for c in fm.columns if c not in ("match_id", "team_id", "map_id")])
    return (fm.where("map_id IS NOT NULL").groupBy("match_id", "team_id")
            .agg(F.sort_array(F.collect_list(one_map)).alias("maps")))


def _events_with_maps(d: Domain, maps: DataFrame) -> DataFrame:
    """``team_sequence`` with the maps of the match (null where it has none)."""
    return team_sequence(d).drop("team_against_id", "history_date").join(
        maps.withColumnRenamed("match_id", "history_id"), ["history_id", "team_id"], "left")


def _with_form_ranges(rows: DataFrame, forms: DataFrame) -> DataFrame:
    """``rows`` (form_date, maps) with each map's form range as its last fields."""
    fields = rows.schema["maps"].dataType.elementType.fieldNames()

    def one(m):
        form = F.col("forms")[m["map_id"]]
        return F.struct(*[m[f].alias(f) for f in fields], form["lo"].alias("form_lo"), form["hi"].alias("form_hi"))

    return rows.join(F.broadcast(forms), "form_date", "left").withColumn("maps", F.transform("maps", one)).drop("forms")


DOCUMENT = ["target_id", "side", "target_stage", "target_tier", "history_id", "stage", "team_score", "team_against_score",
            "team_rating", "team_against_rating", "form_date", "maps"]


def training_sides(d: Domain, named: DataFrame | None = None, days: int = L.HISTORY_DAYS) -> DataFrame:
    """The sides of the targets, each with its history as a range (lo, hi]."""
    return history_ranges(d, named, days).withColumnsRenamed(
        {"stage": "target_stage", "tier": "target_tier", "target_date": "form_date"})


def shared_rows(sides: DataFrame, events: DataFrame, key: tuple[str, ...] = ("team_id",)) -> DataFrame:
    """``sides`` (from ``training_sides``) expanded to ``events`` once for all
    that one team and day have, with the targets in lists (``opened``)."""
    return expanded(bundled(sides, ["team_id", "form_date", "lo", "hi"]), events, list(key))


def shared_document(d: Domain, named: DataFrame | None = None, days: int = L.HISTORY_DAYS,
                    maps: DataFrame | None = None) -> DataFrame:
    """``training_document`` before the targets that share a team and day are opened."""
    events = _events_with_maps(d, match_documents(d, maps)).withColumnRenamed("history_stage", "stage")
    return _with_form_ranges(shared_rows(training_sides(d, named, days), events), forms_by_date(d, _target_dates(d, named), days))


def training_document(d: Domain, named: DataFrame | None = None, days: int = L.HISTORY_DAYS,
                      maps: DataFrame | None = None) -> DataFrame:
    """The training document of the ``named`` targets (a table like ``targets``;
    without it every match is a target).

    One row per target, side and history match: the target's stage and tier, the
    match's fields, and its maps nested (at most three) with their 17 features
    and their map form as the range (form_lo, form_hi] at form_date; the form's
    games are in ``training_forms``. Maps are nested per match, before the
    windows multiply them, and meet their forms once per team and day. ``maps``:
    as in ``match_documents``.
    """
    return opened(shared_document(d, named, days, maps)).select(*DOCUMENT)


def training_histories(d: Domain, named: DataFrame | None = None, days: int = L.HISTORY_DAYS) -> DataFrame:
    """What targets of one team and day share: per (team_id, form_date) the
    history matches with their number, fields and maps. ``training_sides``
    expanded to it on (team_id, form_date) is the ``training_document``."""
    shared = training_sides(d, named, days).select("team_id", "form_date", "lo", "hi").distinct()
    played = expanded(shared, team_sequence(d).drop("team_against_id", "history_date"), ["team_id"])
    # Matches go to their maps, which are not shuffled: most are in no window of the named targets.
    maps = match_documents(d).withColumnRenamed("match_id", "history_id")
    rows = played.withColumnRenamed("history_stage", "stage").join(maps, ["history_id", "team_id"], "left")
    return _with_form_ranges(rows, forms_by_date(d, _target_dates(d, named), days))


def reached_forms(d: Domain, named: DataFrame, days: int = L.HISTORY_DAYS) -> DataFrame:
    """The (form_date, map_id) that the document of the ``named`` targets refers
    to, from the ranges of its teams and days alone."""
    shared = training_sides(d, named, days).select("team_id", "form_date", "lo", "hi").distinct()
    played = expanded(shared, team_sequence(d).select("team_id", "seq", "history_id"), ["team_id"]) \
        .select("form_date", F.col("history_id").alias("match_id")).distinct()
    return played.join(d.match_maps.select("match_id", "map_id"), "match_id").select("form_date", "map_id").distinct()


def training_forms(d: Domain, document: DataFrame, days: int = L.HISTORY_DAYS) -> DataFrame:
    """The map forms that a ``training_document`` refers to, once per (date, map):
    the features of the league maps in the window, nested in the order of their
    numbers, ``FORM_PART`` games a row (part 0, 1, ...)."""
    return nested_forms(d, document.select("form_date", F.explode("maps").alias("m")).select("form_date", "m.map_id").distinct(), days)


def nested_forms(d: Domain, keys: DataFrame, days: int = L.HISTORY_DAYS) -> DataFrame:
    """``training_forms`` of the given (form_date, map_id)."""
    ranged = form_ranges(d, keys, days).withColumn("first", F.col("lo"))
    games = expanded(ranged, map_sequence(d).drop("form_date"), ["map_id"])
    league = feat_maps(d).withColumnRenamed("match_id", "form_match_id")
    league = league.join(games.select("form_match_id", "map_id").distinct(), ["form_match_id", "map_id"], "left_semi")
    game = F.struct("seq", F.col("form_match_id").alias("match_id"), *FORM_FEATURES)
    part = F.floor((F.col("seq") - F.col("first") - 1) / FORM_PART).cast("int")
    return (games.join(league, ["form_match_id", "map_id"]).withColumn("part", part)
            .groupBy("form_date", "map_id", "part").agg(F.sort_array(F.collect_list(game)).alias("map_form")))


def with_forms(document: DataFrame, forms: DataFrame) -> DataFrame:
    """The document with every map's whole form nested in it, as one file for
    one target has it. The form is repeated under each history map, so this is
    for a few targets; for many, keep the two tables."""
    whole = forms.groupBy("form_date", "map_id").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("part", "map_form"))), lambda x: x["map_form"])).alias("map_form"))
    keys = ["target_id", "side", "history_id"]
    each = document.select(*keys, "form_date", F.explode("maps").alias("m")).withColumn("map_id", F.col("m.map_id"))
    nested = each.join(whole, ["form_date", "map_id"], "left").groupBy(*keys).agg(F.sort_array(F.collect_list(
        F.struct(*[F.col(f"m.{f}").alias(f) for f in ["map_id", *MAP_FEATURES]], "map_form"))).alias("maps"))
    return document.drop("maps").join(nested, keys, "left")


def shared_dataset(d: Domain, days: int = L.HISTORY_DAYS, maps: DataFrame | None = None) -> DataFrame:
    """``feat_dataset`` before the targets that share a team and day are opened."""
    events = _events_with_maps(d, match_documents(d) if maps is None else maps).withColumnRenamed("history_stage", "stage")
    return shared_rows(training_sides(d, days=days), events)


def feat_dataset(d: Domain, days: int = L.HISTORY_DAYS, maps: DataFrame | None = None) -> DataFrame:
    """The training document, long form: one row per (target, side, history
    match) with the match fields kept by the reference and its maps nested
    (≤ 3 per match, so the array is bounded). ``map_form`` is referenced by
    (form_date, map_id) into ``map_form``. ``maps``: ``match_documents`` with
    the maps as they are wanted."""
    return opened(shared_dataset(d, days, maps)).select(*DOCUMENT)
