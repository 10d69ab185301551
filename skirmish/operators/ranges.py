"""Range-coded windows: a trailing window as two numbers instead of its rows.

Events are numbered 1, 2, ... per key in date order. The window [D - days, D)
of a target is then one half-open range (lo, hi] of those numbers, so what is
stored grows with the targets, not with targets times window depth. Where the
rows themselves are wanted, ranges meet events in blocks of ``BLOCK`` numbers:
what is shuffled is the events and one row per range and block it touches, the
rows of the windows only leave the join. A block's events bound what a task
holds, and a busy key has many blocks, so none is hot. Ranges that are equal are
met once: ``bundled`` puts what else their rows hold into short lists, and
``opened`` makes the rows again when all that they share has been worked out.

No key's events meet in one window partition. Numbers come from two levels: the
running total of a key's daily counts, a series that the calendar bounds, plus
the rank inside one (key, day).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 1024  # numbers of a key that meet in one place
BUNDLE = 256  # rows with one range that travel as a list


def _daily(events: DataFrame, key: list[str], date: str) -> DataFrame:
    return events.groupBy(*key, date).agg(F.count(F.lit(1)).alias("n"))


def numbered(events: DataFrame, key: list[str], date: str, order: list[str], name: str = "seq") -> DataFrame:
    """``events`` with a dense number per ``key`` in the order of ``date``, then ``order``."""
    by_day = Window.partitionBy(*key).orderBy(F.unix_date(date)).rangeBetween(Window.unboundedPreceding, -1)
    before = _daily(events, key, date).select(*key, date, F.coalesce(F.sum("n").over(by_day), F.lit(0)).alias("_before"))
    # The window leaves the daily series partitioned by key alone; the join spreads over (key, day).
    before = before.repartition(*key, date)
    rank = F.row_number().over(Window.partitionBy(*key, date).orderBy(*order))
    ranked = events.withColumn("_rank", rank)
    return ranked.join(before, [*key, date]).withColumn(name, F.col("_before") + F.col("_rank")).drop("_before", "_rank")


def ranges(events: DataFrame, points: DataFrame, key: list[str], date: str, days: int) -> DataFrame:
    """The window [date - days, date) of every distinct (key, date) of
    ``points`` as (lo, hi], in the numbers of ``numbered``. A date or key
    without events has an empty range (lo = hi)."""
    wanted = points.select(*key, date).distinct().withColumn("_wanted", F.lit(True))
    series = _daily(events, key, date).join(wanted, [*key, date], "full")
    by_day = Window.partitionBy(*key).orderBy(F.unix_date(date))

    def until(last: int):
        return F.coalesce(F.sum("n").over(by_day.rangeBetween(Window.unboundedPreceding, last)), F.lit(0)).cast("long")

    coded = series.select(*key, date, "_wanted", until(-days - 1).alias("lo"), until(-1).alias("hi"))
    return coded.where("_wanted").drop("_wanted").repartition(*key, date)


def expanded(ranged: DataFrame, events: DataFrame, key: list[str], name: str = "seq", block: int = BLOCK) -> DataFrame:
    """One row per event of each range. ``events``: a frame from ``numbered``,
    or one joined to it (a number may have several rows or none). The order of
    columns is key, those of ``ranged`` without lo and hi, those of ``events``."""
    n = int(ranged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    touched = F.sequence(F.expr(f"lo div {block}"), F.expr(f"(hi - 1) div {block}"))
    each = ranged.where("hi > lo").withColumn("_block", F.explode(touched)).repartition(n, *key, "_block")
    held = events.withColumn("_block", F.expr(f"({name} - 1) div {block}")).repartition(n, *key, "_block")
    j = each.join(held.hint("merge"), [*key, "_block"])
    return j.where((F.col(name) > F.col("lo")) & (F.col(name) <= F.col("hi"))).drop("lo", "hi", "_block")


def bundled(ranged: DataFrame, same: list[str], name: str = "_rows") -> DataFrame:
    """Rows of ``ranged`` that agree in ``same`` (the key, lo, hi and what goes
    with them) as one row with the list ``name`` of their other columns; more
    than ``BUNDLE`` of them as several such rows."""
    rest = [c for c in ranged.columns if c not in same]
    nth = F.row_number().over(Window.partitionBy(*same).orderBy(*rest))
    parts = ranged.withColumn("_nth", nth).withColumn("_part", F.expr(f"(_nth - 1) div {BUNDLE}"))
    return parts.groupBy(*same, "_part").agg(F.collect_list(F.struct(*rest)).alias(name)).drop("_part")


def opened(bundles: DataFrame, name: str = "_rows") -> DataFrame:
    """The rows that ``bundled`` put together, each with all columns of its bundle."""
    return bundles.select(*[c for c in bundles.columns if c != name], F.inline(name))
