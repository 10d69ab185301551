"""Scalar rules against the reference's own golden values (FIXTURES.md §B)."""

from pyspark.sql import functions as F

from skirmish.functions import rules as R


def _one(spark, col, values, schema="x string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_snake_case(spark):
    got = _one(spark, R.snake(F.col("x")), ["Main event: Group stage", "Playoff: Semifinal",
                                            "Playoff: Grand final", "Playoffs: Upper Round 1", "  a \t b  "])
    assert got == ["main_event:_group_stage", "playoff:_semifinal", "playoff:_grand_final",
                   "playoffs:_upper_round_1", "a_b"]


def test_time_to_seconds(spark):
    got = _one(spark, R.time_seconds(F.col("x")), ["00:00", "49:10", "1:50:20", "5:10", "60:00", "1:2:3", "-"])
    assert got == [0, 2950, 6620, None, None, None, None]


def test_duration_blank_and_dash(spark):
    assert _one(spark, R.duration(F.col("x")), ["", " - ", "49:10"]) == [None, None, 2950]


def test_url_info(spark):
    urls = ["/506931/bilibili-gaming-vs-team-heretics", "/team/12010/bilibili-gaming",
            "/event/2499/vct-2025-china-stage-2/group-stage", "/player/10698/nephh", "/news/1",
            "https://www.vlr.gg/team/5/x?tab=stats"]
    kinds = _one(spark, R.url_kind(F.col("x")), urls)
    ids = _one(spark, R.url_id(F.col("x")), urls)
    assert kinds == ["match", "team", "tournament", "player", None, "team"]
    assert ids == [506931, 12010, 2499, 10698, None, 5]


def test_int_parser_modes(spark):
    vals = ["-7", " 12 ", "$ 300", "1,234", "abc"]
    assert _one(spark, R.to_int(F.col("x")), vals) == [-7, 12, 300, None, None]
    assert _one(spark, R.to_int(F.col("x"), "reference"), vals) == [7, 12, 300, None, None]


def test_float_and_bank(spark):
    assert _one(spark, R.to_float(F.col("x")), ["7.3k", "1,234", "n/a", "-2.5"]) == [7.3, None, None, -2.5]
    assert _one(spark, R.bank(F.col("x")), ["0.2k", "22.3k", "n/a"]) == [200, 22300, None]


def test_prize_and_tier(spark):
    df = spark.createDataFrame([("$17,500 USD", "/event/group/open"), ("TBD", "/x"),
                                ("$1,250,000 USD", "/x"), ("$3,017 USD", "/event/group/vct-2024")],
                               "p string, g string")
    rows = df.select(R.prize(F.col("p")).alias("p"), R.tier_1(F.col("g"), R.prize(F.col("p"))).alias("t")).collect()
    assert [(r.p, r.t) for r in rows] == [(17500, 0), (0, 0), (1250000, 1), (3017, 1)]


def test_rating_and_stage(spark):
    assert _one(spark, R.rating(F.col("x")), [" [1520] ", "", "1520"]) == [1520, 0, None]
    assert _one(spark, R.stage(F.col("x")), ["Playoffs: Grand  Final", " Playoffs: Upper Round 1", "Week 2"]) == \
        ["grand_final", "playoff", "group_stage"]


def test_buy_type_pistol_rounds_q10(spark):
    df = spark.createDataFrame([("", 1), ("$$$", 12), ("", 13), ("$", 2), ("$$", 3), ("?", 4)], "x string, r int")
    got = [r[0] for r in df.select(R.buy_type(F.col("x"), F.col("r"))).collect()]
    assert got == ["pistol", "pistol", "eco", "semi_eco", "semi_buy", None]


def test_side_rounds_ot_modes_q9(spark):
    df = spark.createDataFrame([(6, 5, 2, 4, 7, 1)], "a int, b int, c int, d int, e int, f int")
    cols = [F.col(x) for x in "abcdef"]
    fixed = df.select(*[v.alias(k) for k, v in R.side_rounds(*cols).items()]).first().asDict()
    ref = df.select(*[v.alias(k) for k, v in R.side_rounds(*cols, ot_mode="reference").items()]).first().asDict()
    # fixed: (2 + 1) // 2 = 1 overtime round per side; reference: (2 + 2) // 2 = 2
    assert fixed == {"team_1_def_rounds": 6 + 7 + 1, "team_1_atk_rounds": 5 + 4 + 1,
                     "team_2_def_rounds": 4 + 5 + 1, "team_2_atk_rounds": 7 + 6 + 1}
    assert ref["team_1_def_rounds"] == 6 + 7 + 2


def test_fill_rules(spark):
    df = spark.createDataFrame([(None, 5, 12), (9, 5, 12), (None, None, 3), (None, 20, 12)],
                               "d int, a int, b int")
    d, a, ok = R.fill_count(F.col("d"), F.col("a"), F.col("b"))
    rows = [tuple(r) for r in df.select(d, a, ok).collect()]
    assert rows == [(7, 5, True), (9, 5, True), (None, None, False), (0, 20, True)]
    w = spark.createDataFrame([(None, 1.0, 1.2, 10, 10), (2.0, None, 1.0, 10, 0)],
                              "d double, a double, b double, dw int, aw int")
    d, a, ok = R.fill_weighted(F.col("d"), F.col("a"), F.col("b"), F.col("dw"), F.col("aw"))
    rows = [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in w.select(d, a, ok).collect()]
    assert rows == [(1.4, 1.0, True), (2.0, 0.0, True)]


def test_listing_date(spark):
    assert [str(x) for x in _one(spark, R.listing_date(F.col("x")), ["Sat, January 7, 1995", "junk"])] == \
        ["1995-01-07", "None"]
