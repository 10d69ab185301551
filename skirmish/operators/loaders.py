"""Loaders: projections, flips and filters over whole tables.

The reference loads one team (or match) at a time with an ``OR`` on the two
team columns. Here every loader returns all teams at once: a two-team row is
flipped into one row per team with ``inline(array(struct, struct))`` (one
scan, no union, no OR), so any later per-team filter is an equality that a
hash join or a parquet filter can use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skirmish.operators.joins import bounded_broadcast, match_join
from skirmish.sources.fixtures import Domain
from skirmish.sources.schemas import SCHEMAS

HISTORY_DAYS = 180


# ---------------------------------------------------------------- predicates
def as_date(value) -> Column:
    """A date literal ('YYYY-MM-DD' or datetime.date) or a Column as a date Column."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def window_predicate(date_col: Column | str, as_of, days: int = HISTORY_DAYS) -> Column:
    """Half-open trailing window ``[D - days, D)`` (ledger Q1)."""
    d = F.col(date_col) if isinstance(date_col, str) else date_col
    dd = as_date(as_of)
    return (d >= F.date_sub(dd, days)) & (d < dd)


def filter_window(df: DataFrame, as_of, days: int = HISTORY_DAYS, date_col: str = "date") -> DataFrame:
    return df.filter(window_predicate(date_col, as_of, days))


def filter_optional(df: DataFrame, **equals) -> DataFrame:
    """Add ``col == value`` only for arguments that are given (not None)."""
    for name, value in equals.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df


def flip(df: DataFrame, keep: list[str], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per team from a two-team row.

    ``pairs`` maps an output name to (team-1 column, team-2 column); the
    first perspective takes team 1's value, the second team 2's.
    """
    def side(first: bool) -> Column:
        return F.struct(*[F.col(a if first else b).alias(out) for out, (a, b) in pairs.items()])

    return df.select(*keep, F.inline(F.array(side(True), side(False))))


def recode_ordinal(team: Column, team_1: Column, team_2: Column, other: int | None = None) -> Column:
    """id -> 1 (team 1) / 2 (team 2) / ``other``."""
    out = F.when(team == team_1, F.lit(1))
    if other is None:
        return out.otherwise(F.lit(2))
    return out.when(team == team_2, F.lit(2)).otherwise(F.lit(other))


# ---------------------------------------------------------------- loaders
def load_matches(d: Domain, as_of=None, days: int = HISTORY_DAYS) -> DataFrame:
    """Matches from each team's own side (both rows per match)."""
    df = flip(d.matches, ["id", "url", "date", "tournament_id", "stage"], {
        "team_id": ("team_1_id", "team_2_id"),
        "team_against_id": ("team_2_id", "team_1_id"),
        "team_score": ("team_1_score", "team_2_score"),
        "team_against_score": ("team_2_score", "team_1_score"),
        "team_rating": ("team_1_rating", "team_2_rating"),
        "team_against_rating": ("team_2_rating", "team_1_rating"),
    })
    return df if as_of is None else filter_window(df, as_of, days)


def match_dates(d: Domain) -> DataFrame:
    """(match_id, date): the join side that gives facts their date."""
    return d.matches.select(F.col("id").alias("match_id"), "date")


def join_date(facts: DataFrame, d: Domain) -> DataFrame:
    """Facts ⋈ matches for the date. Both sides are partitioned on the match id,
    so this is a co-partitioned join with no exchange."""
    return match_join(facts, match_dates(d), "match_id", "inner")


# Columns of a map that name one of its two teams, and the code of neither.
TEAM_CODES = {"team_def_first": None, "team_pick": 3}


def load_maps(d: Domain, as_of=None, days: int = HISTORY_DAYS, match_id: int = -1) -> DataFrame:
    """Maps with their date; columns that name a team hold its place (1, 2)."""
    places = {c: recode_ordinal(F.col(c), F.col("team_1_id"), F.col("team_2_id"), other) for c, other in TEAM_CODES.items()}
    df = join_date(d.match_maps, d).where(F.col("match_id") != match_id).withColumns(places)
    df = df.select(*SCHEMAS["match_maps"].fieldNames(), "date")
    return df if as_of is None else filter_window(df, as_of, days)


ROUND_PAIRS = {
    "team_id": ("team_1_id", "team_2_id"),
    "team_against_id": ("team_2_id", "team_1_id"),
    "team_buy_type": ("team_1_buy_type", "team_2_buy_type"),
    "team_against_buy_type": ("team_2_buy_type", "team_1_buy_type"),
    "team_bank": ("team_1_bank", "team_2_bank"),
    "team_against_bank": ("team_2_bank", "team_1_bank"),
}


def flip_rounds(rounds: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Rounds from each team's side with def/won as 0/1 (no date), and the columns ``also``."""
    f = flip(rounds, ["match_id", "map_id", "round_no", "team_def", "team_won", "won_method", *also], ROUND_PAIRS)
    return f.select(
        "match_id", "map_id", "round_no", "team_id", "team_against_id",
        "team_buy_type", "team_against_buy_type", "team_bank", "team_against_bank",
        (F.col("team_def") == F.col("team_id")).cast("int").alias("def"),
        (F.col("team_won") == F.col("team_id")).cast("int").alias("won"),
        "won_method", *also,
    )


def load_rounds(d: Domain, as_of=None, days: int = HISTORY_DAYS, sort: bool = False) -> DataFrame:
    if sort:
        dates = match_dates(d) if as_of is None else filter_window(match_dates(d), as_of, days)
        return flip_rounds(sort_rounds(d.round_stats, dates), ("date",))
    df = join_date(flip_rounds(d.round_stats), d)
    return df if as_of is None else filter_window(df, as_of, days)


def sort_rounds(rounds: DataFrame, dates: DataFrame) -> DataFrame:
    """Rounds with their match's date, latest first, then by match, map and round.
    A map's rounds (the game bounds them) are put in order where they lie and
    travel as one row with a list for each column, so the sort moves maps and
    not the two sides of each round; ``flip_rounds`` keeps the order."""
    of = ["match_id", "map_id"]
    fields = ["round_no", *[c for c in rounds.columns if c not in (*of, "round_no")]]
    maps = rounds.groupBy(*of).agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_rounds"))
    days = dates.groupBy("match_id", "date").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    each = F.col("_rounds")
    copies = F.flatten(F.transform(each, lambda x: F.array_repeat(x, F.col("_n"))))  # a match that is there twice
    j = match_join(maps, days, "match_id").withColumn("_rounds", F.when(F.col("_n") == 1, each).otherwise(copies))
    lists = j.select("date", *of, *[F.col(f"_rounds.{c}").alias(c) for c in fields])
    lists = lists.orderBy(F.desc("date"), *of)
    return lists.select("date", *of, F.inline(F.arrays_zip(*fields)))


def agents_dim(d: Domain) -> DataFrame:
    """Agent dimension, broadcast only behind a size bound."""
    return bounded_broadcast(d.agents.select(F.col("id").alias("agent_id"),
                                             F.col("agent_type").alias("role")))


def join_role(players: DataFrame, d: Domain) -> DataFrame:
    """Agent -> role; null when the agent is unknown (left join, ledger Q24)."""
    return players.join(agents_dim(d), "agent_id", "left")


def load_players(d: Domain, as_of=None, days: int = HISTORY_DAYS, match_id=None, map_id=None) -> DataFrame:
    df = join_role(join_date(d.player_overview_stats, d), d)
    if as_of is not None:
        df = filter_window(df, as_of, days)
    return filter_optional(df, match_id=match_id, map_id=map_id)


def load_highlights(d: Domain, as_of=None, days: int = HISTORY_DAYS) -> DataFrame:
    df = join_date(d.player_highlights, d)
    return df if as_of is None else filter_window(df, as_of, days)


DUEL_COUNTERS = ("kills", "first_kills", "op_kills")


def load_duels(d: Domain) -> DataFrame:
    """Each duel row oriented both ways: (player, opponent) and back."""
    pairs = {"player_id": ("team_1_player_id", "team_2_player_id"),
             "opp_id": ("team_2_player_id", "team_1_player_id")}
    for c in DUEL_COUNTERS:
        a = f"team_1_player_{c}_vs_team_2_player"
        b = f"team_2_player_{c}_vs_team_1_player"
        pairs[f"player_{c}_vs_opp"] = (a, b)
        pairs[f"opp_{c}_vs_players"] = (b, a)
    return flip(d.players_duel_stats, ["match_id", "map_id"], pairs)


def duel_features(d: Domain) -> DataFrame:
    return load_duels(d).drop("match_id", "map_id", "player_id", "opp_id")
