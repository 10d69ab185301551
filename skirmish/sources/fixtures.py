"""Domain views over the driver tables (matches, maps, rounds, players, ...).

Every view is derived row-by-row from ``orders`` (one match per order) with
``explode(sequence(...))`` for the fan-out, so building them needs no join
and no shuffle: they are narrow transformations of one parquet scan and
scale linearly with the input.  ``nation``/``region`` only back the small
agents/maps dimensions.

The same views are written in SQL for the DuckDB oracle in
``skirmish.sources.fixture_sql``; both must give equal rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skirmish.sources.tables import Tables


def _seq(upper_inclusive: Column) -> Column:
    """explode(sequence(0, n)) as an int column (the 'numbers table' fan-out)."""
    return F.explode(F.sequence(F.lit(0), upper_inclusive.cast("int")))


def _cycle(expr: Column, values: list[str]) -> Column:
    """CASE expr WHEN 0 THEN values[0] WHEN 1 THEN values[1] ... ELSE values[-1]."""
    out = F.lit(values[-1])
    for i in reversed(range(len(values) - 1)):
        out = F.when(expr == i, F.lit(values[i])).otherwise(out)
    return out


# Fixed values of the fixture definition (see FIXTURES.md §C).
N_TEAMS = 20
BUY_TYPES = ["eco", "semi_eco", "semi_buy", "full_buy"]
WON_METHODS = ["eliminate", "spike_explode", "defuse", "out_of_time"]
ROLES = ["duelist", "controller", "sentinel", "initiator"]
HIGHLIGHT_TYPES = ["2k", "3k", "4k", "5k", "1v1", "1v2", "1v3", "1v4", "1v5"]
HIGHLIGHT_OPPONENTS = [2, 3, 4, 5, 1, 2, 3, 4, 5]
COUNT_STATS = ("kills", "deaths", "assists", "first_kills", "first_deaths")
WEIGHTED_STATS = ("rating", "acs", "kast", "adr", "hs")
PART_MATCHES = 5_000  # matches that one task takes, with all that hangs on them


class Domain:
    """Lazily built domain views for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, partitions: int | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)
        self._partitions = partitions

    @cached_property
    def partitions(self) -> int:
        """Partitions of the match id: the session's number, or as many as keep
        ``PART_MATCHES`` matches in one, so a task does not grow with the table.
        (The count comes from the files' footers.)"""
        if self._partitions:
            return self._partitions
        least = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return max(least, -(-self.t.orders.count() // PART_MATCHES))

    # ---- dimensions -------------------------------------------------
    @cached_property
    def agents(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.t.nation.select(
            (n + 1).cast("int").alias("id"),
            F.concat(F.lit("agent_"), n.cast("string")).alias("name"),
            _cycle(n % 4, ROLES).alias("agent_type"),
        )

    @cached_property
    def maps(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self.t.nation.filter(n < 12).select(
            (n + 1).cast("bigint").alias("id"),
            F.concat(F.lit("Map"), (n + 1).cast("string")).alias("name"),
        )

    # ---- facts --------------------------------------------------------
    @cached_property
    def matches(self) -> DataFrame:
        k, c = F.col("o_orderkey"), F.col("o_custkey")
        prio = F.col("o_orderpriority")
        # One hash partitioning on the match id; every fact view below is a
        # narrow fan-out of it, so all of them stay co-partitioned on match_id
        # (like tables bucketed by match_id) and per-match joins need no shuffle.
        orders = self.t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        return orders.repartition(self.partitions, "o_orderkey").select(
            k.alias("id"),
            F.concat(F.lit("/"), k.cast("string"), F.lit("/m-"), c.cast("string")).alias("url"),
            F.to_date("o_orderdate").alias("date"),
            (c % 7).alias("tournament_id"),
            F.when(prio == "1-URGENT", "grand_final").when(prio == "2-HIGH", "playoff")
             .otherwise("group_stage").alias("stage"),
            (c % N_TEAMS + 1).alias("team_1_id"),
            ((c + 1 + (k * 7) % 19) % N_TEAMS + 1).alias("team_2_id"),
            (k % 3).alias("team_1_score"),
            ((k + 1) % 3).alias("team_2_score"),
            F.when(c % 11 == 0, F.lit(None)).otherwise(1400 + c % 700).alias("team_1_rating"),
            (1400 + (k * 3) % 700).alias("team_2_rating"),
        )

    @cached_property
    def match_maps(self) -> DataFrame:
        m = self.matches.select("id", "team_1_id", "team_2_id", _seq(F.col("id") % 3).alias("n"))
        i, n = F.col("id"), F.col("n")
        t1, t2 = F.col("team_1_id"), F.col("team_2_id")
        return m.select(
            i.alias("match_id"),
            ((i + n * 5) % 12 + 1).alias("map_id"),
            F.when(i % 13 == 0, F.lit(None)).otherwise(1800 + (i * 7) % 1800).alias("duration"),
            t1, t2,
            ((i + n) % 8).alias("team_1_def_score"),
            ((i * 3 + n) % 7).alias("team_1_atk_score"),
            ((i + n) % 3).alias("team_1_ot_score"),
            ((i * 5 + n) % 8).alias("team_2_def_score"),
            ((i * 11 + n) % 7).alias("team_2_atk_score"),
            ((i + n * 2) % 3).alias("team_2_ot_score"),
            F.when((i + n) % 2 == 0, t1).otherwise(t2).alias("team_def_first"),
            F.when((i + n) % 3 == 0, t1).when((i + n) % 3 == 1, t2).alias("team_pick"),
        )

    @cached_property
    def round_stats(self) -> DataFrame:
        mm = self.match_maps.select(
            "match_id", "map_id", "team_1_id", "team_2_id", "team_def_first",
            _seq(F.lit(15) + (F.col("match_id") + F.col("map_id")) % 9).alias("n"))
        mi, mp, n = F.col("match_id"), F.col("map_id"), F.col("n")
        t1, t2, tdf = F.col("team_1_id"), F.col("team_2_id"), F.col("team_def_first")

        def buy(expr: Column) -> Column:
            return F.when(n % 12 == 0, F.lit("pistol")).otherwise(_cycle(expr % 4, BUY_TYPES))

        return mm.select(
            mi, mp, (n + 1).alias("round_no"), t1, t2,
            F.when(n < 12, tdf).otherwise(t1 + t2 - tdf).alias("team_def"),
            buy(mi + mp * 3 + n * 7).alias("team_1_buy_type"),
            buy(mi * 3 + mp + n * 5).alias("team_2_buy_type"),
            (((mi * 7 + n * 311) % 300) * 100).alias("team_1_bank"),
            (((mi * 11 + n * 173) % 300) * 100).alias("team_2_bank"),
            F.when((mi * 13 + mp * 7 + n * 3) % 5 < 3, t1).otherwise(t2).alias("team_won"),
            _cycle((mi + mp + n) % 4, WON_METHODS).alias("won_method"),
        )

    @staticmethod
    def two_sides(df: DataFrame, keep: list[str]) -> DataFrame:
        """Both team perspectives of rows carrying team_1_id/team_2_id, in one scan."""
        s1 = F.struct(F.col("team_1_id").alias("team_id"), F.col("team_2_id").alias("opp_id"),
                      F.lit(1).alias("slot"))
        s2 = F.struct(F.col("team_2_id").alias("team_id"), F.col("team_1_id").alias("opp_id"),
                      F.lit(2).alias("slot"))
        return df.select(*keep, F.inline(F.array(s1, s2)))

    @cached_property
    def sides(self) -> DataFrame:
        return self.two_sides(self.match_maps, ["match_id", "map_id"])

    @cached_property
    def player_overview_stats(self) -> DataFrame:
        s = self.sides.select("match_id", "map_id", "team_id",
                              _seq(F.lit(4)).alias("p")).select(
            "*", F.explode(F.array(F.lit(0), F.lit(1))).alias("d"))
        mi, mp, tm, p, d = (F.col(x) for x in ("match_id", "map_id", "team_id", "p", "d"))
        return s.select(
            mi, mp, tm, (tm * 10 + p).alias("player_id"),
            F.when(d == 0, "def").otherwise("atk").alias("side"),
            ((mi + mp + tm + p * 6) % 25 + 1).cast("int").alias("agent_id"),
            (((mi + p * 31 + d * 17) % 200).cast("double") / 100).alias("rating"),
            ((mi * 3 + p * 41 + d * 29) % 350).cast("double").alias("acs"),
            ((mi + mp * 5 + p * 3 + d) % 14).alias("kills"),
            ((mi + mp * 3 + p * 5 + d * 7) % 14).alias("deaths"),
            ((mi + p) % 9).alias("assists"),
            ((mi * 7 + p * 13 + d) % 101).cast("double").alias("kast"),
            ((mi * 5 + p * 19 + d) % 220).cast("double").alias("adr"),
            ((mi * 9 + p * 23 + d) % 101).cast("double").alias("hs"),
            ((mi + p) % 4).alias("first_kills"),
            ((mi + p * 2) % 4).alias("first_deaths"),
        )

    @cached_property
    def player_highlights(self) -> DataFrame:
        r = self.two_sides(self.round_stats, ["match_id", "map_id", "round_no"])
        mi, mp, rn, slot = F.col("match_id"), F.col("map_id"), F.col("round_no"), F.col("slot")
        kind = (mi + mp + rn * 5 + slot) % 9
        h = (r.filter((mi + rn * 3 + slot) % 4 == 0)
             .select(mi, mp, rn, "team_id", "opp_id",
                     (F.col("team_id") * 10 + (rn + mi) % 5).alias("player_id"),
                     _cycle(kind, HIGHLIGHT_TYPES).alias("highlight_type"),
                     F.element_at(F.array(*[F.lit(v) for v in HIGHLIGHT_OPPONENTS]),
                                  (kind + 1).cast("int")).alias("n_opp")))
        h = h.select("*", _seq(F.col("n_opp") - 1).alias("o"))
        return h.select(mi, mp, rn, "team_id", "player_id", "highlight_type",
                        (F.col("opp_id") * 10 + F.col("o")).alias("player_against_id"))

    @cached_property
    def players_duel_stats(self) -> DataFrame:
        g = (self.match_maps.select("match_id", "map_id", "team_1_id", "team_2_id",
                                    _seq(F.lit(4)).alias("a"))
             .select("*", _seq(F.lit(4)).alias("b")))
        mi, mp, a, b = F.col("match_id"), F.col("map_id"), F.col("a"), F.col("b")
        return g.select(
            mi, mp,
            (F.col("team_1_id") * 10 + a).alias("team_1_player_id"),
            (F.col("team_2_id") * 10 + b).alias("team_2_player_id"),
            ((mi + a * 3 + b) % 7).alias("team_1_player_kills_vs_team_2_player"),
            ((mi + a + b * 3) % 7).alias("team_2_player_kills_vs_team_1_player"),
            ((mi + a) % 3).alias("team_1_player_first_kills_vs_team_2_player"),
            ((mi + b) % 3).alias("team_2_player_first_kills_vs_team_1_player"),
            ((mp + a) % 2).alias("team_1_player_op_kills_vs_team_2_player"),
            ((mp + b) % 2).alias("team_2_player_op_kills_vs_team_1_player"),
        )

    # ---- raw (pre-parse) views -----------------------------------------
    @cached_property
    def raw_matches(self) -> DataFrame:
        m = self.matches
        i = F.col("id")
        return m.select(
            i, "url", "date",
            F.concat(F.lit("/event/"), F.col("tournament_id").cast("string"), F.lit("/cup-"),
                     F.col("tournament_id").cast("string"), F.lit("/stage")).alias("event_href"),
            F.when(F.col("stage") == "grand_final", "Playoffs: Grand  Final")
             .when(F.col("stage") == "playoff", " Playoffs: Upper Round 1")
             .otherwise("Main Event: Week 2").alias("series_txt"),
            F.concat(F.lit("/team/"), F.col("team_1_id").cast("string"), F.lit("/t"),
                     F.col("team_1_id").cast("string")).alias("team_1_href"),
            F.concat(F.lit("/team/"), F.col("team_2_id").cast("string"), F.lit("/t"),
                     F.col("team_2_id").cast("string")).alias("team_2_href"),
            *[F.when(F.col(f"team_{t}_rating").isNull(), F.lit(""))
              .otherwise(F.concat(F.lit(" ["), F.col(f"team_{t}_rating").cast("string"), F.lit("] ")))
              .alias(f"team_{t}_rating_txt") for t in (1, 2)],
            *[F.concat(F.lit(" "), F.col(f"team_{t}_score").cast("string"), F.lit("\n")).alias(f"team_{t}_score_txt")
              for t in (1, 2)],
            F.when(i % 17 == 0, F.lit("-")).when(i % 3 == 0, F.lit("1:02:05"))
             .otherwise(F.concat((20 + i % 39).cast("string"), F.lit(":"), (10 + i % 49).cast("string")))
             .alias("duration_txt"),
        )

    @cached_property
    def raw_overview_cells(self) -> DataFrame:
        """Overview fragment of each map: one cell a round, some lacking."""
        r = self.raw_rounds.where((F.col("match_id") + F.col("map_id") + F.col("round_no")) % 43 != 0)
        return r.select("match_id", "map_id", (F.col("round_no") - 1).alias("pos"), "win_class")

    @cached_property
    def raw_economy_cells(self) -> DataFrame:
        """Economy fragment of each map: one cell a round, others lacking."""
        r = self.raw_rounds.where((F.col("match_id") * 3 + F.col("map_id") + F.col("round_no")) % 41 != 0)
        return r.select("match_id", "map_id", (F.col("round_no") - 1).alias("pos"), "t1_bank_txt")

    @cached_property
    def raw_side_rows(self) -> DataFrame:
        """Player side rows as they arrive: an atk row in 97 is lost, a def row in 101 comes twice."""
        p = self.player_overview_stats.select("match_id", "map_id", "team_id", "player_id", "side")
        key = F.col("match_id") + F.col("player_id")
        lost = (F.col("side") == "atk") & (key % 97 == 0)
        copies = F.when((F.col("side") == "def") & (key % 101 == 0), 2).otherwise(1)
        return p.where(~lost).withColumn("_n", F.explode(F.sequence(F.lit(1), copies))).drop("_n")

    @cached_property
    def raw_rounds(self) -> DataFrame:
        r = self.round_stats
        won, tdef = F.col("team_won"), F.col("team_def")

        def buy_txt(c: str) -> Column:
            x = F.col(c)
            return (F.when(x == "semi_eco", "$").when(x == "semi_buy", "$$")
                    .when(x == "full_buy", "$$$").otherwise(""))

        def bank_txt(c: str) -> Column:
            x = F.col(c)
            return F.concat(F.floor(x / 1000).cast("int").cast("string"), F.lit("."),
                            ((x % 1000) / 100).cast("int").cast("string"), F.lit("k"))

        img = (F.when(F.col("won_method") == "eliminate", "elim")
               .when(F.col("won_method") == "spike_explode", "boom")
               .when(F.col("won_method") == "defuse", "defuse").otherwise("time"))
        return r.select(
            "match_id", "map_id", "round_no", "team_1_id", "team_2_id",
            F.when(won == F.col("team_1_id"), "rnd-sq mod-win").otherwise("").alias("t1_win_class"),
            F.concat(F.lit("rnd-sq mod-win "), F.when(won == tdef, "mod-ct").otherwise("mod-t")).alias("win_class"),
            F.concat(F.lit("/img/vlr/game/round/"), img, F.lit(".webp")).alias("win_img"),
            buy_txt("team_1_buy_type").alias("t1_buy_txt"),
            buy_txt("team_2_buy_type").alias("t2_buy_txt"),
            F.when((F.col("match_id") % 50 == 0) & (F.col("round_no") == 5), F.lit("n/a"))
             .otherwise(bank_txt("team_1_bank")).alias("t1_bank_txt"),
            bank_txt("team_2_bank").alias("t2_bank_txt"),
        )

    @cached_property
    def raw_player_stats(self) -> DataFrame:
        p = self.player_overview_stats
        pid, side = F.col("player_id"), F.col("side")

        mid = F.col("match_id")

        def side_val(c: str, s: str, drop_when: int) -> Column:
            return F.when(pid % 5 == drop_when, F.lit(None)).otherwise(
                F.max(F.when(side == s, F.col(c))))

        cells = [F.when((mid % 97 == 0) & (pid % 10 == 3), F.lit("agent_new"))
                 .otherwise(F.concat(F.lit("agent_"), (F.max("agent_id") - 1).cast("string"))).alias("agent_name")]
        for c in COUNT_STATS + WEIGHTED_STATS:
            both = F.sum(c) if c in COUNT_STATS else F.avg(c)
            if c == "deaths":  # a gap that cannot be filled
                both = F.when((mid % 101 == 0) & (pid % 10 == 0), F.lit(None)).otherwise(both)
            cells += [side_val(c, "def", 0).alias(f"def_{c}"), side_val(c, "atk", 1).alias(f"atk_{c}"),
                      both.alias(f"both_{c}")]
        return p.groupBy("match_id", "map_id", "team_id", "player_id").agg(*cells)

    @cached_property
    def veto_notes(self) -> DataFrame:
        i = F.col("id")
        t1, t2 = F.col("team_1_id").cast("string"), F.col("team_2_id").cast("string")

        def mp(off: int) -> Column:
            return F.concat(F.lit("Map"), ((i + off) % 12 + 1).cast("string"))

        return self.matches.select(
            i.alias("match_id"), "team_1_id", "team_2_id",
            F.concat(F.lit("T"), t1).alias("t1_short"), F.concat(F.lit("T"), t2).alias("t2_short"),
            F.concat(F.lit("T"), t1, F.lit(" ban "), mp(0), F.lit("; T"), t2, F.lit(" ban "), mp(5),
                     F.lit("; T"), t1, F.lit(" pick "), mp(7), F.lit("; "), mp(9), F.lit(" remains")).alias("note"),
        )
