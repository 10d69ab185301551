"""Queries for the scalar rules, each applied over a whole raw
view; the oracle side is the same rule in DuckDB SQL (plans/rules_sql.py)."""

from __future__ import annotations

from pyspark.sql import functions as F

from skirmish.functions import registry as REG
from skirmish.functions import rules as R
from skirmish.plans import features as FT
from skirmish.plans import q_features as QF
from skirmish.plans import rules_sql as S
from skirmish.plans.registry import dom, query
from skirmish.sources import raw_views as RV


@query("f_snake", sql=f"SELECT id, series_txt, {S.snake('series_txt')} AS snake FROM g_raw_matches")
def f_snake(spark, sf_dir):
    r = dom(spark, sf_dir).raw_matches
    return r.select("id", "series_txt", R.snake(F.col("series_txt")).alias("snake"))


@query("f_stage", sql=f"SELECT id, {S.stage('series_txt')} AS stage FROM g_raw_matches")
def f_stage(spark, sf_dir):
    return dom(spark, sf_dir).raw_matches.select("id", R.stage(F.col("series_txt")).alias("stage"))


@query("f_time_seconds", sql=f"SELECT id, duration_txt, {S.time_seconds('duration_txt')} AS seconds FROM g_raw_matches")
def f_time_seconds(spark, sf_dir):
    r = dom(spark, sf_dir).raw_matches
    return r.select("id", "duration_txt", R.time_seconds(F.col("duration_txt")).alias("seconds"))


@query("f_duration", sql=f"""
SELECT match_id, game_id, {S.duration('duration_txt')} AS duration FROM g_raw_map_overview WHERE game_id != 'all'""")
def f_duration(spark, sf_dir):
    ov, _, _ = RV.raw_map_tabs(dom(spark, sf_dir))
    return ov.filter(F.col("game_id") != "all").select("match_id", "game_id",
                                                       R.duration(F.col("duration_txt")).alias("duration"))


@query("f_rating", sql=f"SELECT id, {S.rating('team_1_rating_txt')} AS team_1_rating FROM g_raw_matches")
def f_rating(spark, sf_dir):
    r = dom(spark, sf_dir).raw_matches
    return r.select("id", R.rating(F.col("team_1_rating_txt")).alias("team_1_rating"))


_MARGIN_TXT_SQL = "CAST(team_1_score - team_2_score AS VARCHAR)"
_BANK_TXT_SQL = "concat('$ ', team_1_rating)"


@query("f_int", sql=f"""
SELECT id, {S.to_int(_MARGIN_TXT_SQL)} AS margin, {S.to_int(_MARGIN_TXT_SQL, 'reference')} AS margin_unsigned,
  {S.to_int(_BANK_TXT_SQL)} AS rating FROM g_matches""")
def f_int(spark, sf_dir):
    """Int rule over score-margin text ('-1') in both modes (ledger Q11) and
    over currency-marked text ('$ 1520')."""
    m = dom(spark, sf_dir).matches
    margin = (F.col("team_1_score") - F.col("team_2_score")).cast("string")
    bank = F.concat(F.lit("$ "), F.col("team_1_rating").cast("string"))
    return m.select("id", R.to_int(margin).alias("margin"), R.to_int(margin, "reference").alias("margin_unsigned"),
                    R.to_int(bank).alias("rating"))


@query("f_float", sql=f"""
SELECT match_id, map_id, round_no, {S.to_float('t1_bank_txt')} AS t1_bank, {S.to_float('t2_bank_txt')} AS t2_bank
FROM g_raw_rounds""")
def f_float(spark, sf_dir):
    r = dom(spark, sf_dir).raw_rounds
    return r.select("match_id", "map_id", "round_no", R.to_float(F.col("t1_bank_txt")).alias("t1_bank"),
                    R.to_float(F.col("t2_bank_txt")).alias("t2_bank"))


@query("f_bank", sql=f"""
SELECT match_id, map_id, round_no, {S.bank('t1_bank_txt')} AS team_1_bank, {S.bank('t2_bank_txt')} AS team_2_bank
FROM g_raw_rounds""")
def f_bank(spark, sf_dir):
    r = dom(spark, sf_dir).raw_rounds
    return r.select("match_id", "map_id", "round_no", R.bank(F.col("t1_bank_txt")).alias("team_1_bank"),
                    R.bank(F.col("t2_bank_txt")).alias("team_2_bank"))


@query("f_string", sql=f"SELECT id, series_txt AS raw, {S.strip('series_txt')} AS clean FROM g_raw_matches")
def f_string(spark, sf_dir):
    r = dom(spark, sf_dir).raw_matches
    return r.select("id", R.as_string(F.col("series_txt")).alias("raw"),
                    R.as_string(F.col("series_txt"), clean=True).alias("clean"))


@query("f_date", sql=f"""
SELECT id, strftime(date, '%a, %B %-d, %Y') AS listing_txt,
  CAST({S.listing_date("strftime(date, '%a, %B %-d, %Y')")} AS VARCHAR) AS date FROM g_matches""")
def f_date(spark, sf_dir):
    m = dom(spark, sf_dir).matches
    txt = F.date_format(F.col("date"), "EEE, MMMM d, yyyy")
    return m.select("id", txt.alias("listing_txt"), R.listing_date(txt).cast("string").alias("date"))


@query("f_typed_coerce", sql=f"""
SELECT match_id, map_id, round_no, {S.bank('t1_bank_txt')} AS team_1_bank,
  CAST(t1_bank_txt IS NULL OR {S.strip('t1_bank_txt')} = '' OR {S.bank('t1_bank_txt')} IS NOT NULL AS INTEGER) AS team_1_bank_ok,
  {S.won_method('win_img')} AS won_method,
  CAST(win_img IS NULL OR {S.strip('win_img')} = '' OR {S.won_method('win_img')} IS NOT NULL AS INTEGER) AS won_method_ok,
  {S.strip('t1_buy_txt')} AS t1_buy,
  CAST(1 AS INTEGER) AS t1_buy_ok
FROM g_raw_rounds""")
def f_typed_coerce(spark, sf_dir):
    """Schema-driven select: a field spec (output, raw column, rule name)."""
    r = dom(spark, sf_dir).raw_rounds
    spec = [("team_1_bank", "t1_bank_txt", "bank"), ("won_method", "win_img", "won_method"),
            ("t1_buy", "t1_buy_txt", "string_clean")]
    return REG.typed_coerce(r, spec, keep=["match_id", "map_id", "round_no"])


@query("ext_rules", sql=f"""
SELECT id, {S.stage('series_txt')} AS stage, {S.rating('team_1_rating_txt')} AS team_1_rating FROM g_raw_matches""")
def ext_rules(spark, sf_dir):
    """Rules chosen by name from the registry (the field-spec extension point)."""
    r = dom(spark, sf_dir).raw_matches
    return r.select("id", REG.RULES["stage"](F.col("series_txt")).alias("stage"),
                    REG.RULES["rating"](F.col("team_1_rating_txt")).alias("team_1_rating"))


@query("f_def_first", sql=f"""
SELECT o.match_id, o.game_id, {S.def_first('o.def_first_class', 'm.team_1_id', 'm.team_2_id')} AS team_def_first,
  {S.team_pick('o.pick_class', 'm.team_1_id', 'm.team_2_id')} AS team_pick
FROM g_raw_map_overview o JOIN g_matches m ON m.id = o.match_id WHERE o.game_id != 'all'""")
def f_def_first(spark, sf_dir):
    d = dom(spark, sf_dir)
    ov, _, _ = RV.raw_map_tabs(d)
    m = d.matches.select(F.col("id").alias("match_id"), "team_1_id", "team_2_id")
    j = ov.filter(F.col("game_id") != "all").join(m, "match_id")
    t1, t2 = F.col("team_1_id"), F.col("team_2_id")
    return j.select("match_id", "game_id", R.def_first(F.col("def_first_class"), t1, t2).alias("team_def_first"),
                    R.team_pick(F.col("pick_class"), t1, t2).alias("team_pick"))


@query("f_team_pick", sql=f"""
SELECT o.match_id, o.game_id, {S.team_pick('o.pick_class', 'm.team_1_id', 'm.team_2_id')} AS team_pick
FROM g_raw_map_overview o JOIN g_matches m ON m.id = o.match_id WHERE o.game_id != 'all'""")
def f_team_pick(spark, sf_dir):
    return f_def_first(spark, sf_dir).select("match_id", "game_id", "team_pick")


@query("f_team_won", sql=f"""
SELECT match_id, map_id, round_no, {S.team_won('t1_win_class', 'team_1_id', 'team_2_id')} AS team_won FROM g_raw_rounds""")
def f_team_won(spark, sf_dir):
    r = dom(spark, sf_dir).raw_rounds
    return r.select("match_id", "map_id", "round_no",
                    R.team_won(F.col("t1_win_class"), F.col("team_1_id"), F.col("team_2_id")).alias("team_won"))


@query("f_won_method", sql=f"SELECT match_id, map_id, round_no, {S.won_method('win_img')} AS won_method FROM g_raw_rounds")
def f_won_method(spark, sf_dir):
    r = dom(spark, sf_dir).raw_rounds
    return r.select("match_id", "map_id", "round_no", R.won_method(F.col("win_img")).alias("won_method"))


@query("f_team_def", sql=f"""
SELECT match_id, map_id, round_no,
  {S.team_def('win_class', 'team_1_id', 'team_2_id', S.team_won('t1_win_class', 'team_1_id', 'team_2_id'))} AS team_def
FROM g_raw_rounds""")
def f_team_def(spark, sf_dir):
    r = dom(spark, sf_dir).raw_rounds
    t1, t2 = F.col("team_1_id"), F.col("team_2_id")
    won = R.team_won(F.col("t1_win_class"), t1, t2)
    return r.select("match_id", "map_id", "round_no", R.team_def(F.col("win_class"), t1, t2, won).alias("team_def"))


@query("f_buy_type", sql=f"""
SELECT match_id, map_id, round_no, {S.buy_type('t1_buy_txt', 'round_no')} AS team_1_buy_type,
  {S.buy_type('t2_buy_txt', 'round_no')} AS team_2_buy_type FROM g_raw_rounds""")
def f_buy_type(spark, sf_dir):
    r = dom(spark, sf_dir).raw_rounds
    rn = F.col("round_no")
    return r.select("match_id", "map_id", "round_no", R.buy_type(F.col("t1_buy_txt"), rn).alias("team_1_buy_type"),
                    R.buy_type(F.col("t2_buy_txt"), rn).alias("team_2_buy_type"))


@query("f_prize", sql=f"SELECT id, prize_txt, {S.prize('prize_txt')} AS prize_pool FROM g_raw_tournaments")
def f_prize(spark, sf_dir):
    t = RV.raw_tournaments(dom(spark, sf_dir))
    return t.select("id", "prize_txt", R.prize(F.col("prize_txt")).alias("prize_pool"))


@query("f_tier", sql=f"""
SELECT id, group_href, {S.tier_1('group_href', S.prize('prize_txt'))} AS tier_1 FROM g_raw_tournaments""")
def f_tier(spark, sf_dir):
    t = RV.raw_tournaments(dom(spark, sf_dir))
    return t.select("id", "group_href", R.tier_1(F.col("group_href"), R.prize(F.col("prize_txt"))).alias("tier_1"))


@query("f_short_name", sql=f"""
SELECT id, name, shorthand_txt, {S.short_name('name', 'shorthand_txt')} AS shorthand_name FROM g_raw_teams""")
def f_short_name(spark, sf_dir):
    t = RV.raw_teams(dom(spark, sf_dir))
    return t.select("id", "name", "shorthand_txt",
                    R.short_name(F.col("name"), F.col("shorthand_txt")).alias("shorthand_name"))


_HREFS_SQL = """hrefs AS (
  SELECT id AS match_id, 'url' AS src, url AS href FROM g_raw_matches
  UNION ALL SELECT id, 'event', event_href FROM g_raw_matches
  UNION ALL SELECT id, 'team_1', team_1_href FROM g_raw_matches
  UNION ALL SELECT id, 'team_2', team_2_href FROM g_raw_matches)"""


def _hrefs(d):
    r = d.raw_matches
    return r.select(F.col("id").alias("match_id"), F.inline(F.array(
        *[F.struct(F.lit(n).alias("src"), F.col(c).alias("href"))
          for n, c in (("url", "url"), ("event", "event_href"), ("team_1", "team_1_href"), ("team_2", "team_2_href"))])))


@query("f_url_info", sql=f"""
SELECT match_id, src, {S.url_kind('href')} AS kind, {S.url_id('href')} AS ref_id FROM hrefs""", ctes=_HREFS_SQL)
def f_url_info(spark, sf_dir):
    h = _hrefs(dom(spark, sf_dir))
    return h.select("match_id", "src", R.url_kind(F.col("href")).alias("kind"), R.url_id(F.col("href")).alias("ref_id"))


@query("f_page_route", sql=f"""
SELECT match_id, src, {S.page_route(f"concat('{R.SITE_URL}', href)")} AS kind FROM hrefs""", ctes=_HREFS_SQL)
def f_page_route(spark, sf_dir):
    """Full site URLs routed to page kinds in a fixed order (event pages
    with a trailing segment and the like route to null = quarantine)."""
    h = _hrefs(dom(spark, sf_dir))
    return h.select("match_id", "src", R.page_route(F.concat(F.lit(R.SITE_URL), F.col("href"))).alias("kind"))


_FR = QF.FEAT_ROUNDS_SQL


@query("f_round_outcome", sql=f"""
SELECT match_id, map_id, team_id, round_no, won_buy_elim, loss_buy_elim, won_buy_spike_explode, loss_buy_spike_explode,
  won_buy_defuse, loss_buy_defuse, won_buy_timeout, loss_buy_timeout FROM ({_FR})""", ctes=QF.CLUTCH_CTE)
def f_round_outcome(spark, sf_dir):
    f = FT.feat_rounds(dom(spark, sf_dir))
    return f.select("match_id", "map_id", "team_id", "round_no", *[f"{o}_buy_{t}" for t in
                    ("elim", "spike_explode", "defuse", "timeout") for o in ("won", "loss")])


@query("f_thrifty", sql=f"SELECT match_id, map_id, team_id, round_no, won_by_thrifty, loss_by_thrifty FROM ({_FR})",
       ctes=QF.CLUTCH_CTE)
def f_thrifty(spark, sf_dir):
    return FT.feat_rounds(dom(spark, sf_dir)).select("match_id", "map_id", "team_id", "round_no", "won_by_thrifty",
                                                      "loss_by_thrifty")


@query("f_clutch_flag", sql=f"SELECT match_id, map_id, team_id, round_no, won_buy_clutch, loss_buy_clutch FROM ({_FR})",
       ctes=QF.CLUTCH_CTE)
def f_clutch_flag(spark, sf_dir):
    return FT.feat_rounds(dom(spark, sf_dir)).select("match_id", "map_id", "team_id", "round_no", "won_buy_clutch",
                                                      "loss_buy_clutch")


@query("f_orient_score", sql="""
SELECT s.match_id, s.map_id, s.team_id,
  CASE WHEN s.team_id = mm.team_1_id THEN mm.team_1_def_score ELSE mm.team_2_def_score END AS team_def_score,
  CASE WHEN s.team_id = mm.team_1_id THEN mm.team_2_def_score ELSE mm.team_1_def_score END AS team_against_def_score,
  CASE WHEN s.team_id = mm.team_1_id THEN mm.team_1_ot_score ELSE mm.team_2_ot_score END AS team_ot_score
FROM g_sides s JOIN g_match_maps mm ON mm.match_id = s.match_id AND mm.map_id = s.map_id""")
def f_orient_score(spark, sf_dir):
    d = dom(spark, sf_dir)
    j = d.sides.select("match_id", "map_id", "team_id").join(d.match_maps, ["match_id", "map_id"])
    t, t1 = F.col("team_id"), F.col("team_1_id")
    return j.select("match_id", "map_id", "team_id",
                    R.orient(t, t1, F.col("team_1_def_score"), F.col("team_2_def_score")).alias("team_def_score"),
                    R.orient(t, t1, F.col("team_2_def_score"), F.col("team_1_def_score")).alias("team_against_def_score"),
                    R.orient(t, t1, F.col("team_1_ot_score"), F.col("team_2_ot_score")).alias("team_ot_score"))


@query("f_nan_zero", sql="""
SELECT match_id, map_id, team_id, player_id, coalesce(CAST(def_rating AS DOUBLE), 0.0) AS def_rating,
  coalesce(CAST(atk_kills AS DOUBLE), 0.0) AS atk_kills FROM g_raw_player_stats""")
def f_nan_zero(spark, sf_dir):
    r = dom(spark, sf_dir).raw_player_stats
    return r.select("match_id", "map_id", "team_id", "player_id", R.nan_zero(F.col("def_rating")).alias("def_rating"),
                    R.nan_zero(F.col("atk_kills")).alias("atk_kills"))


@query("f_date_sub", sql="""
SELECT id, CAST(CAST(date - INTERVAL 180 DAY AS DATE) AS VARCHAR) AS window_start FROM g_matches""")
def f_date_sub(spark, sf_dir):
    m = dom(spark, sf_dir).matches
    return m.select("id", F.date_sub(F.col("date"), 180).cast("string").alias("window_start"))


@query("f_url_info_pages", sql=f"""
SELECT page_id, {S.url_kind('url', R.PAGE_URL_PATTERNS)} AS kind, {S.url_id('url', R.PAGE_URL_PATTERNS)} AS ref_id
FROM pages""")
def f_url_info_pages(spark, sf_dir):
    """URL rule over the captured pages with the pages' own pattern list
    (the reference's list matches no fixture URL, so it is a parameter)."""
    p = dom(spark, sf_dir).t.pages
    return p.select("page_id", R.url_kind(F.col("url"), R.PAGE_URL_PATTERNS).alias("kind"),
                    R.url_id(F.col("url"), R.PAGE_URL_PATTERNS).alias("ref_id"))


@query("f_page_route_pages", sql=f"SELECT page_id, {S.page_route('url')} AS kind FROM pages")
def f_page_route_pages(spark, sf_dir):
    """The reference's router over the captured pages: none of them is a
    known page kind, so every row routes to null (quarantine)."""
    p = dom(spark, sf_dir).t.pages
    return p.select("page_id", R.page_route(F.col("url")).alias("kind"))
