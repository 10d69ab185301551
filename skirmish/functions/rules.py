"""Scalar rules as Column -> Column expressions.

Every rule is a built-in expression (codegen'd, JVM-side); none is a Python
UDF. A rule that can fail returns null for the failing row, and a matching
``*_ok`` / ``violation`` expression says why, so jobs can split clean rows
from quarantined ones instead of raising.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# Number patterns of the int / float parsers:
INT_PATTERN = r"^-?[a-zA-Z$%]?\s*[0-9]+\s*[a-zA-Z$%]?$"
FLOAT_PATTERN = r"^-?[a-zA-Z$%]?\s*-?\d+(?:[,.]\d+)*(\.\d+)?\s*[a-zA-Z$%]?$"
FLOAT_TOKEN = r"-?\d+(?:[,.]\d+)*(\.\d+)?"
# Both in one: the sign stays with the token where it can.
FLOAT_PARSER = r"^-??[a-zA-Z$%]?\s*(-?\d+(?:[,.]\d+)*(?:\.\d+)?)\s*[a-zA-Z$%]?$"
# Round-outcome icons, in order eliminate / spike_explode / defuse / out_of_time:
WON_METHOD_IMAGES = {
    "/img/vlr/game/round/elim.webp": "eliminate",
    "/img/vlr/game/round/boom.webp": "spike_explode",
    "/img/vlr/game/round/defuse.webp": "defuse",
    "/img/vlr/game/round/time.webp": "out_of_time",
}
# Buy marks of the economy tab:
BUY_MARKS = {"": "eco", "$": "semi_eco", "$$": "semi_buy", "$$$": "full_buy"}
# Display codes:
BUY_SHORT = {"pistol": "P", "eco": "E", "semi_eco": "SE", "semi_buy": "SB", "full_buy": "FB"}
WON_METHOD_SHORT = {"defuse": "DEF", "eliminate": "ELIM", "out_of_time": "OOT", "spike_explode": "SPIKE"}
# Pistol rounds (ledger Q10: the second-half pistol is written as round 12):
PISTOL_ROUNDS = (1, 12)
# Tier-1 rule: circuit link pattern, or prize pool of at least 500,000:
TIER1_LINK_PATTERN = r"vct-20[0-9][0-9]"
TIER1_MIN_PRIZE = 500000
PRIZE_PATTERN = r"[0-9,]+ USD"
# URL path patterns -> (kind, id segment):
URL_PATTERNS = [
    ("match", r"^/[0-9]+/[a-zA-Z0-9-]*$", 1),
    ("player", r"^/player/[0-9]+/[a-zA-Z0-9-]*$", 2),
    ("team", r"^/team/[0-9]+/[a-zA-Z0-9-]*$", 2),
    ("tournament", r"^/event/[0-9]+/[a-zA-Z0-9-]*/?[a-zA-Z0-9-]*$", 2),
]
# URL path patterns of the captured pages table (the pattern list is a parameter):
PAGE_URL_PATTERNS = [
    ("article", r"^/[a-z]{2}/[0-9]+/?$", 2),
    ("article_html", r"^/[a-z]{2}/[0-9]+\.html$", 2),
]
# Host of the scraped site (page URLs are absolute on it):
SITE_URL = "https://www.vlr.gg"
SITE = re.escape(SITE_URL)
# Page router patterns (full URL or internal tag) -> page kind, in a fixed order (ledger Q20):
PAGE_ROUTES = [
    ("match", rf"^{SITE}/[0-9]+/[a-z0-9/-]*$"),
    ("match_maps", r"matchMaps"),
    ("team", rf"^{SITE}/team/[0-9]+/[a-z0-9/-]*$"),
    ("tournament", rf"^{SITE}/event/[0-9]+/[a-z0-9/-]*$"),
    ("round_stats", r"^roundStat$"),
    ("player_stats", r"^playerStats$"),
    ("duel_stats", r"^duelStats$"),
    ("highlights", r"^highlights$"),
    ("player", rf"^{SITE}/player/[0-9]+/[a-z0-9-]*$"),
]
# ---------------------------------------------------------------------------


def _lookup(c: Column, mapping: dict[str, str], default: Column | None = None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(c == k, F.lit(v)) if out is None else out.when(c == k, F.lit(v)))
    return out.otherwise(default if default is not None else F.lit(None))


# Whitespace trimmed by the text rules: ASCII space, \t \n \v \f \r, NEL and NBSP.
WHITESPACE = " \t\n\x0b\x0c\r\u0085\u00a0"


def strip(c: Column) -> Column:
    """Trim whitespace (not only spaces) at both ends; a character-set trim,
    no regular expression. Rules with ``trimmed`` take cells that went through it."""
    return F.btrim(c, F.lit(WHITESPACE))


def round6(c: Column) -> Column:
    """``F.round(c, 6)`` of a double, the same value, without a BigDecimal per
    row: where ``c`` is far from a tie in the seventh place, the nearest whole
    number of millionths is certain. ``c`` is named several times, so it should
    be a column of the input and not a long expression."""
    y = c * 1e6
    whole = F.floor(y + 0.5)
    sure = (F.abs(c) < 1e3) & (F.abs(y - F.floor(y) - 0.5) > 1e-6)
    return F.when(sure, whole.cast("double") / F.lit(1e6)).otherwise(F.round(c, 6))


def strip_cell(c: Column) -> Column:
    """``strip`` of a column of the input: only cells with whitespace at an end are copied."""
    ends = [test for w in WHITESPACE for test in (c.startswith(w), c.endswith(w))]
    return F.when(~reduce(lambda a, b: a | b, ends), c).otherwise(strip(c))


def split_words(c: Column) -> Column:
    """``F.split(c, r"\\s+")``, by a single space (no regular expression) where
    ``c`` holds no other white space."""
    other = [c.contains(x) for x in ("  ", "\t", "\n", "\x0b", "\x0c", "\r")]
    return F.when(reduce(lambda a, b: a | b, other), F.split(c, r"\s+")).otherwise(F.split(c, " "))


def snake(c: Column) -> Column:
    """lower-case, split on whitespace, join with '_'."""
    return F.regexp_replace(strip(F.lower(c)), r"\s+", "_")


def time_seconds(c: Column) -> Column:
    """'mm:ss' or 'h:mm:ss' -> seconds; minutes/seconds two digits and < 60,
    hours < 24; anything else -> null."""
    x = strip(c)
    two = x.rlike(r"^[0-9]{2}:[0-9]{2}$")
    three = x.rlike(r"^[0-9]{1,2}:[0-9]{2}:[0-9]{2}$")
    h = F.when(three, F.regexp_extract(x, r"^([0-9]+):", 1).cast("int")).otherwise(F.lit(0))
    m = F.when(three, F.regexp_extract(x, r"^[0-9]+:([0-9]+):", 1)).otherwise(
        F.regexp_extract(x, r"^([0-9]+):", 1)).cast("int")
    s = F.regexp_extract(x, r":([0-9]+)$", 1).cast("int")
    ok = (two | three) & (h < 24) & (m < 60) & (s < 60)
    return F.when(ok, h * 3600 + m * 60 + s)


def duration(c: Column) -> Column:
    """blank or '-' -> null, else seconds."""
    x = strip(c)
    return F.when((x == "") | (x == "-"), F.lit(None).cast("int")).otherwise(time_seconds(x))


def duration_ok(c: Column) -> Column:
    x = strip(c)
    return (x == "") | (x == "-") | time_seconds(x).isNotNull()


def to_int(c: Column, mode: str = "signed") -> Column:
    """Int parser (ledger Q11): pattern check, then the first digit run;
    ``mode='reference'`` drops the sign like the reference does."""
    x = strip(c)
    digits = F.regexp_extract(x, r"[0-9]+", 0).cast("bigint")
    signed = F.when(x.startswith("-"), -digits).otherwise(digits)
    parsed = F.when(x.rlike(INT_PATTERN), digits if mode == "reference" else signed)
    plain = c.try_cast("bigint")  # a number written as Spark writes it needs no trim and no pattern
    return F.when(plain.cast("string") == c, F.abs(plain) if mode == "reference" else plain).otherwise(parsed)


def to_float(c: Column, trimmed: bool = False) -> Column:
    """Float parser: the number token of a text that has the pattern; '1,234' passes
    the pattern but is not a number -> null (a violation)."""
    x = c if trimmed else strip(c)
    return F.regexp_extract(x, FLOAT_PARSER, 1).try_cast("double")


def as_string(c: Column, clean: bool = False) -> Column:
    return strip(c) if clean else c


def listing_date(c: Column) -> Column:
    """'Mon, January 2, 2006' -> date (the weekday is dropped before parsing)."""
    x = F.regexp_replace(strip(c), r"^[A-Za-z]+,\s*", "")
    return F.to_date(F.try_to_timestamp(x, F.lit("MMMM d, yyyy")))


def default_blank(c: Column, default, alt: Column) -> Column:
    """blank -> ``default``, else the other rule's value."""
    return F.when(strip(c) == "", F.lit(default)).otherwise(alt)


def stage(c: Column) -> Column:
    s = snake(c)
    return (F.when(s.contains("grand_final"), "grand_final").when(s.contains("playoff"), "playoff")
            .otherwise("group_stage"))


def rating(c: Column) -> Column:
    """'[n]' -> n, blank -> 0, else null (error)."""
    x = strip(c)
    return F.when(x == "", F.lit(0).cast("bigint")).when(
        x.rlike(r"^\[[0-9]+\]$"), F.regexp_extract(x, r"^\[([0-9]+)\]$", 1).cast("bigint"))


def def_first(c: Column, team_1: Column, team_2: Column) -> Column:
    x = strip(c)
    return F.when(x == "mod-ct", team_1).when(x == "mod-t", team_2)


def team_pick(c: Column, team_1: Column, team_2: Column) -> Column:
    x = strip(c)
    return F.when(x.contains("mod-1"), team_1).when(x.contains("mod-2"), team_2)


def team_won(c: Column, team_1: Column, team_2: Column) -> Column:
    return F.when(strip(c) == "", team_2).otherwise(team_1)


def won_method(c: Column, trimmed: bool = False) -> Column:
    return _lookup(c if trimmed else strip(c), WON_METHOD_IMAGES)


def team_def(c: Column, team_1: Column, team_2: Column, winner: Column, trimmed: bool = False) -> Column:
    loser = F.when(winner == team_1, team_2).otherwise(team_1)
    x = c if trimmed else strip(c)
    return F.when(x.contains("mod-ct"), winner).when(x.contains("mod-t"), loser)


def buy_type(c: Column, round_no: Column, pistol_rounds=PISTOL_ROUNDS, trimmed: bool = False) -> Column:
    return F.when(round_no.isin(*pistol_rounds), F.lit("pistol")).otherwise(_lookup(c if trimmed else strip(c), BUY_MARKS))


def bank(c: Column, trimmed: bool = False) -> Column:
    """'7.3k' -> 7300 (float x 1000, truncated)."""
    return (to_float(c, trimmed) * 1000).cast("int")


def prize(c: Column) -> Column:
    """'N,NNN USD' -> N; anything else -> 0 (ledger Q15)."""
    tok = F.regexp_replace(F.regexp_replace(F.regexp_extract(strip(c), PRIZE_PATTERN, 0), "USD", ""), ",", "")
    return F.coalesce(strip(tok).try_cast("bigint"), F.lit(0).cast("bigint"))


def tier_1(group_href: Column, prize_pool: Column) -> Column:
    return (F.coalesce(strip(group_href).rlike(TIER1_LINK_PATTERN), F.lit(False))
            | (prize_pool >= TIER1_MIN_PRIZE)).cast("int")


def short_name(name: Column, shorthand: Column) -> Column:
    use_name = ((shorthand.isNull() | (shorthand == "")) & ~name.contains(" ")
                & (F.octet_length(name) <= 4))
    return F.when(use_name, name).otherwise(shorthand)


def url_path(url: Column) -> Column:
    """Path part of an absolute or relative URL (query and fragment dropped)."""
    return F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def url_kind(url: Column, patterns=URL_PATTERNS) -> Column:
    p = url_path(url)
    out = None
    for kind, pat, _ in patterns:
        out = F.when(p.rlike(pat), F.lit(kind)) if out is None else out.when(p.rlike(pat), F.lit(kind))
    return out


def url_id(url: Column, patterns=URL_PATTERNS) -> Column:
    p = url_path(url)
    out = None
    for _, pat, seg in patterns:
        val = F.regexp_extract(F.split(p, "/").getItem(seg), r"^[0-9]+", 0).try_cast("bigint")
        out = F.when(p.rlike(pat), val) if out is None else out.when(p.rlike(pat), val)
    return out


def page_route(target: Column, routes=PAGE_ROUTES) -> Column:
    """First matching route in a fixed order; null = unmatched (quarantine)."""
    out = None
    for kind, pat in routes:
        out = F.when(target.rlike(pat), F.lit(kind)) if out is None else out.when(target.rlike(pat), F.lit(kind))
    return out


def side_rounds(t1_def: Column, t1_atk: Column, t1_ot: Column, t2_def: Column, t2_atk: Column, t2_ot: Column,
                ot_mode: str = "fixed") -> dict[str, Column]:
    """Rounds each team played on each side (ledger Q9). Overtime rounds are
    shared evenly: (T1OT + T2OT) / 2 each; ``ot_mode='reference'`` uses the
    reference's (T1OT + T1OT) / 2."""
    total_ot = (t1_ot + t1_ot) if ot_mode == "reference" else (t1_ot + t2_ot)
    half = F.floor(total_ot / 2).cast("bigint")
    return {
        "team_1_def_rounds": t1_def + t2_atk + half,
        "team_1_atk_rounds": t1_atk + t2_def + half,
        "team_2_def_rounds": t2_def + t1_atk + half,
        "team_2_atk_rounds": t2_atk + t1_def + half,
    }


def fill_count(def_v: Column, atk_v: Column, both: Column) -> tuple[Column, Column, Column]:
    """Missing side count = total - other side, floored at 0.
    Returns (def, atk, ok); ok is false when the gap cannot be filled."""
    ok = (def_v.isNotNull() & atk_v.isNotNull()) | (both.isNotNull() & (def_v.isNotNull() | atk_v.isNotNull()))
    d = F.coalesce(def_v, F.greatest(both - atk_v, F.lit(0)))
    a = F.coalesce(atk_v, F.greatest(both - def_v, F.lit(0)))
    return F.when(ok, d), F.when(ok, a), ok


def fill_weighted(def_v: Column, atk_v: Column, both: Column, def_w: Column, atk_w: Column
                  ) -> tuple[Column, Column, Column]:
    """Missing side of a weighted stat (per round, or per kill):
    (total * (wd + wa) - other * other_w) / own_w, 0 when own_w is 0, floored at 0."""
    ok = (def_v.isNotNull() & atk_v.isNotNull()) | (both.isNotNull() & (def_v.isNotNull() | atk_v.isNotNull()))
    tot = (def_w + atk_w).cast("double")

    def solve(other: Column, other_w: Column, own_w: Column) -> Column:
        v = F.when(own_w == 0, F.lit(0.0)).otherwise(
            (both.cast("double") * tot - other_w.cast("double") * other.cast("double")) / own_w.cast("double"))
        return F.greatest(v, F.lit(0.0))

    d = F.coalesce(def_v.cast("double"), solve(atk_v, atk_w, def_w))
    a = F.coalesce(atk_v.cast("double"), solve(def_v, def_w, atk_w))
    return F.when(ok, d), F.when(ok, a), ok


def nan_zero(c: Column) -> Column:
    return F.coalesce(F.nanvl(c.cast("double"), F.lit(0.0)), F.lit(0.0))


def short_buy_type(c: Column) -> Column:
    return _lookup(c, BUY_SHORT, F.lit(""))


def short_won_method(c: Column) -> Column:
    return _lookup(c, WON_METHOD_SHORT, F.lit(""))


def orient(team: Column, team_1: Column, own_1: Column, own_2: Column) -> Column:
    """Value of ``team``'s side: team 1's when team is team 1, else team 2's."""
    return F.when(team == team_1, own_1).otherwise(own_2)
