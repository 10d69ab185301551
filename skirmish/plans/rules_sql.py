"""The scalar rules of functions/rules.py written as DuckDB SQL text (oracle side)."""

from __future__ import annotations

from skirmish.functions import rules as R


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_WS_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(133) || chr(160)"


def strip(x: str) -> str:
    return f"trim({x}, {_WS_SQL})"


def snake(x: str) -> str:
    return f"regexp_replace({strip(f'lower({x})')}, '\\s+', '_', 'g')"


def time_seconds(x: str) -> str:
    s = strip(x)
    two = f"regexp_matches({s}, '^[0-9]{{2}}:[0-9]{{2}}$')"
    three = f"regexp_matches({s}, '^[0-9]{{1,2}}:[0-9]{{2}}:[0-9]{{2}}$')"
    p = lambda i: f"TRY_CAST(split_part({s}, ':', {i}) AS INTEGER)"
    return (f"(CASE WHEN {two} AND {p(1)} < 60 AND {p(2)} < 60 THEN {p(1)} * 60 + {p(2)} "
            f"WHEN {three} AND {p(1)} < 24 AND {p(2)} < 60 AND {p(3)} < 60 THEN {p(1)} * 3600 + {p(2)} * 60 + {p(3)} END)")


def duration(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN {s} = '' OR {s} = '-' THEN NULL ELSE {time_seconds(x)} END)"


def to_int(x: str, mode: str = "signed") -> str:
    s = strip(x)
    digits = f"CAST(regexp_extract({s}, '[0-9]+', 0) AS BIGINT)"
    val = digits if mode == "reference" else f"(CASE WHEN starts_with({s}, '-') THEN -{digits} ELSE {digits} END)"
    return f"(CASE WHEN regexp_matches({s}, {q(R.INT_PATTERN)}) THEN {val} END)"


def to_float(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN regexp_matches({s}, {q(R.FLOAT_PATTERN)}) "
            f"THEN TRY_CAST(regexp_extract({s}, {q(R.FLOAT_TOKEN)}, 0) AS DOUBLE) END)")


def bank(x: str) -> str:
    return f"CAST(trunc({to_float(x)} * 1000) AS INTEGER)"


def rating(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN {s} = '' THEN CAST(0 AS BIGINT) WHEN regexp_matches({s}, '^\\[[0-9]+\\]$') "
            f"THEN CAST(regexp_extract({s}, '^\\[([0-9]+)\\]$', 1) AS BIGINT) END)")


def stage(x: str) -> str:
    s = snake(x)
    return (f"(CASE WHEN contains({s}, 'grand_final') THEN 'grand_final' WHEN contains({s}, 'playoff') "
            f"THEN 'playoff' ELSE 'group_stage' END)")


def url_path(x: str) -> str:
    return f"regexp_extract({x}, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)', 1)"


def url_kind(x: str, patterns=R.URL_PATTERNS) -> str:
    p = url_path(x)
    return "(CASE " + " ".join(f"WHEN regexp_matches({p}, {q(pat)}) THEN {q(k)}" for k, pat, _ in patterns) + " END)"


def url_id(x: str, patterns=R.URL_PATTERNS) -> str:
    p = url_path(x)
    return "(CASE " + " ".join(
        f"WHEN regexp_matches({p}, {q(pat)}) THEN TRY_CAST(regexp_extract(split_part({p}, '/', {seg + 1}), '^[0-9]+', 0) AS BIGINT)"
        for _, pat, seg in patterns) + " END)"


def page_route(x: str, routes=R.PAGE_ROUTES) -> str:
    return "(CASE " + " ".join(f"WHEN regexp_matches({x}, {q(pat)}) THEN {q(k)}" for k, pat in routes) + " END)"


def lookup(x: str, mapping: dict[str, str], default: str = "NULL") -> str:
    return "(CASE " + " ".join(f"WHEN {x} = {q(k)} THEN {q(v)}" for k, v in mapping.items()) + f" ELSE {default} END)"


def buy_type(x: str, round_no: str, pistol=R.PISTOL_ROUNDS) -> str:
    return (f"(CASE WHEN {round_no} IN ({', '.join(str(p) for p in pistol)}) THEN 'pistol' "
            f"ELSE {lookup(strip(x), R.BUY_MARKS)} END)")


def won_method(x: str) -> str:
    return lookup(strip(x), R.WON_METHOD_IMAGES)


def team_won(x: str, t1: str, t2: str) -> str:
    return f"(CASE WHEN {strip(x)} = '' THEN {t2} ELSE {t1} END)"


def team_def(x: str, t1: str, t2: str, won: str) -> str:
    loser = f"(CASE WHEN {won} = {t1} THEN {t2} ELSE {t1} END)"
    s = strip(x)
    return f"(CASE WHEN contains({s}, 'mod-ct') THEN {won} WHEN contains({s}, 'mod-t') THEN {loser} END)"


def def_first(x: str, t1: str, t2: str) -> str:
    s = strip(x)
    return f"(CASE WHEN {s} = 'mod-ct' THEN {t1} WHEN {s} = 'mod-t' THEN {t2} END)"


def team_pick(x: str, t1: str, t2: str) -> str:
    s = strip(x)
    return f"(CASE WHEN contains({s}, 'mod-1') THEN {t1} WHEN contains({s}, 'mod-2') THEN {t2} END)"


def prize(x: str) -> str:
    tok = f"replace(replace(regexp_extract({strip(x)}, {q(R.PRIZE_PATTERN)}, 0), 'USD', ''), ',', '')"
    return f"coalesce(TRY_CAST({strip(tok)} AS BIGINT), 0)"


def tier_1(href: str, prize_sql: str) -> str:
    return (f"CAST(coalesce(regexp_matches({strip(href)}, {q(R.TIER1_LINK_PATTERN)}), false) "
            f"OR {prize_sql} >= {R.TIER1_MIN_PRIZE} AS INTEGER)")


def short_name(name: str, short: str) -> str:
    return (f"(CASE WHEN ({short} IS NULL OR {short} = '') AND NOT contains({name}, ' ') AND strlen({name}) <= 4 "
            f"THEN {name} ELSE {short} END)")


def listing_date(x: str) -> str:
    return f"CAST(try_strptime(regexp_replace({strip(x)}, '^[A-Za-z]+,\\s*', ''), '%B %d, %Y') AS DATE)"
