"""Windows: the reference's per-team/per-match loops, set-based.

win_history never puts a team's raw rows into one window partition: rows
are first pre-aggregated to one row per (team, day) -- a partial aggregate
done map-side -- and the trailing ``rangeBetween(-days, -1)`` frame runs
over that daily series, whose size is bounded by the number of calendar
days, not by how many matches a team plays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skirmish.operators.loaders import HISTORY_DAYS


def trailing_daily(daily: DataFrame, key: list[str], date_col: str, sums: list[str],
                   days: int = HISTORY_DAYS) -> DataFrame:
    """Sum ``sums`` over [date - days, date) per ``key`` on a one-row-per-day frame."""
    w = (Window.partitionBy(*key).orderBy(F.unix_date(F.col(date_col)))
         .rangeBetween(-days, -1))
    return daily.select(*key, date_col, *[F.sum(c).over(w).alias(c) for c in sums])


def win_history(team_matches: DataFrame, days: int = HISTORY_DAYS) -> DataFrame:
    """Per (match, team): matches played, wins and mean score margin in the
    ``days`` before the match date (window [D-days, D), ledger Q1)."""
    margin = F.col("team_score") - F.col("team_against_score")
    daily = (team_matches.groupBy("team_id", "date")
             .agg(F.count(F.lit(1)).alias("n"),
                  F.sum((margin > 0).cast("bigint")).alias("w"),
                  F.sum(margin).alias("m")))
    # The window leaves hist partitioned on team_id alone; re-key the small
    # daily side on (team_id, date) so the join below spreads over all
    # (team, day) keys instead of a handful of team keys.
    hist = trailing_daily(daily, ["team_id"], "date", ["n", "w", "m"], days) \
        .repartition("team_id", "date")
    targets = team_matches.select(F.col("id").alias("match_id"), "team_id", "date")
    out = targets.join(hist, ["team_id", "date"], "inner")
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    return out.select(
        "match_id", "team_id", F.col("date").cast("string").alias("date"),
        n.alias("n_matches"),
        F.coalesce(F.col("w"), F.lit(0)).cast("bigint").alias("n_wins"),
        F.round(F.try_divide(F.col("m").cast("double"), n.cast("double")), 6).alias("avg_margin"),
    )


def first_row(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """Deterministic first row per group (no bare first(); ledger Q6)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def all_or_nothing(df: DataFrame, keys: list[str], valid: Column) -> tuple[DataFrame, DataFrame]:
    """One bad row rejects every row of its group (ledger Q22).

    Returns (clean, quarantined). ``bool_and`` over a window partitioned by the
    group key; groups are maps or matches, so partitions stay small.
    """
    w = Window.partitionBy(*keys)
    flagged = df.withColumn("_row_ok", F.coalesce(valid, F.lit(False))) \
                .withColumn("_group_ok", F.bool_and("_row_ok").over(w))
    clean = flagged.filter(F.col("_group_ok")).drop("_row_ok", "_group_ok")
    bad = flagged.filter(~F.col("_group_ok")).drop("_group_ok")
    return clean, bad


def slot_team(pos: Column, team_1: Column, team_2: Column, per_team: int = 5) -> Column:
    """Row position 0..4 -> team 1, 5..9 -> team 2, else null."""
    return (F.when(pos.between(0, per_team - 1), team_1)
            .when(pos.between(per_team, 2 * per_team - 1), team_2))


def carry_forward(df: DataFrame, key: list[str], pos: str, value: Column, name: str, width: int = 1000, levels: int = 3) -> DataFrame:
    """``df`` with the last non-null ``value`` at or before each row, per
    ``key`` in the order of ``pos`` (unique whole numbers per key).

    A segmented scan: rows fall into blocks of ``width`` positions, each block
    gives its last value, the values before each block are found in the same way
    over blocks of blocks, and rows are filled inside their block. No window
    holds more than ``width`` rows, except the topmost, which has one row per
    ``width ** levels`` positions of a key, so a long key takes no long task.
    """
    blocked = df.withColumn("_value", value).withColumn("_block", F.floor(F.col(pos) / width))
    before = _before_blocks(_last_of_blocks(blocked, key, pos), key, width, levels - 1)
    w = Window.partitionBy(*key, "_block").orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    filled = blocked.withColumn("_inside", F.last("_value", ignorenulls=True).over(w))
    joined = filled.join(before.select(*key, "_block", "_carried"), [*key, "_block"])
    return joined.withColumn(name, F.coalesce("_inside", "_carried")).drop("_value", "_block", "_inside", "_carried")


def _last_of_blocks(df: DataFrame, key: list[str], pos: str) -> DataFrame:
    """The last non-null _value of each block (null where it has none)."""
    held = F.when(F.col("_value").isNotNull(), F.col(pos))
    return df.groupBy(*key, "_block").agg(F.max_by("_value", held).alias("_value"))


def _before_blocks(blocks: DataFrame, key: list[str], width: int, levels: int) -> DataFrame:
    """``blocks`` with _carried, the last non-null value of the blocks before."""
    earlier = (Window.unboundedPreceding, -1)
    if levels <= 0:
        w = Window.partitionBy(*key).orderBy("_block").rowsBetween(*earlier)
        return blocks.withColumn("_carried", F.last("_value", ignorenulls=True).over(w))
    inner = blocks.withColumnRenamed("_block", "_at").withColumn("_block", F.floor(F.col("_at") / width))
    outer = _before_blocks(_last_of_blocks(inner, key, "_at"), key, width, levels - 1)
    w = Window.partitionBy(*key, "_block").orderBy("_at").rowsBetween(*earlier)
    inner = inner.withColumn("_inside", F.last("_value", ignorenulls=True).over(w))
    joined = inner.join(outer.select(*key, "_block", "_carried"), [*key, "_block"])
    return joined.select(*key, F.col("_at").alias("_block"), "_value", F.coalesce("_inside", "_carried").alias("_carried"))
