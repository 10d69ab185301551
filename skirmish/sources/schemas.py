"""The one declaration of every table's schema.

Reads are done with these schemas (never inferred); ``conform`` casts a
frame to a declared schema in one ``select``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

L, I, D, S, DT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.DateType()


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


SCHEMAS: dict[str, T.StructType] = {
    "matches": _s(("id", L, False), ("url", S, False), ("date", DT, False), ("tournament_id", L, False),
                  ("stage", S, True), ("team_1_id", L, False), ("team_2_id", L, False),
                  ("team_1_score", I, False), ("team_2_score", I, False),
                  ("team_1_rating", I, True), ("team_2_rating", I, True)),
    "match_maps": _s(("match_id", L, False), ("map_id", I, False), ("duration", I, True),
                     ("team_1_id", L, False), ("team_2_id", L, False),
                     ("team_1_def_score", I, False), ("team_1_atk_score", I, False), ("team_1_ot_score", I, False),
                     ("team_2_def_score", I, False), ("team_2_atk_score", I, False), ("team_2_ot_score", I, False),
                     ("team_def_first", L, False), ("team_pick", L, True)),
    "round_stats": _s(("match_id", L, False), ("map_id", I, False), ("round_no", I, False),
                      ("team_1_id", L, False), ("team_2_id", L, False), ("team_def", L, False),
                      ("team_1_buy_type", S, False), ("team_2_buy_type", S, False),
                      ("team_1_bank", I, False), ("team_2_bank", I, False), ("team_won", L, False),
                      ("won_method", S, False)),
    "players_duel_stats": _s(("match_id", L, False), ("map_id", I, False), ("team_1_player_id", L, False),
                             ("team_2_player_id", L, False),
                             *[(f"team_{a}_player_{c}_vs_team_{b}_player", I, False)
                               for c in ("kills", "first_kills", "op_kills") for a, b in ((1, 2), (2, 1))]),
    "player_overview_stats": _s(("match_id", L, False), ("map_id", I, False), ("team_id", L, False),
                                ("player_id", L, False), ("side", S, False), ("agent_id", I, False),
                                ("rating", D, False), ("acs", D, False), ("kills", I, False), ("deaths", I, False),
                                ("assists", I, False), ("kast", D, False), ("adr", D, False), ("hs", D, False),
                                ("first_kills", I, False), ("first_deaths", I, False)),
    "player_highlights": _s(("match_id", L, False), ("map_id", I, False), ("round_no", I, False),
                            ("team_id", L, False), ("player_id", L, False), ("highlight_type", S, False),
                            ("player_against_id", L, False)),
    "ban_pick_log": _s(("match_id", L, False), ("team_id", L, True), ("veto_order", I, False), ("map_id", I, False),
                       ("veto_action", S, False), ("ban_pick_order", I, False)),
    "tournaments": _s(("id", L, False), ("name", S, False), ("url", S, False), ("prize_pool", L, False),
                      ("tier_1", I, False)),
    "players": _s(("id", L, False), ("name", S, False), ("real_name", S, True), ("country_id", I, True),
                  ("url", S, False), ("img_url", S, True)),
    "teams": _s(("id", L, False), ("name", S, False), ("shorthand_name", S, True), ("url", S, False),
                ("img_url", S, True), ("country_id", I, True), ("region_id", I, True)),
    "maps": _s(("id", I, False), ("name", S, False), ("release_date", S, False)),
    "maps_pool": _s(("date", S, False), ("patch_no", S, False), ("map_id", I, False)),
    "countries": _s(("id", I, False), ("name", S, False), ("region_id", I, False)),
    "regions": _s(("id", I, False), ("name", S, False)),
    "agents": _s(("id", I, False), ("name", S, False), ("agent_type", S, False), ("release_date", S, False)),
    "matches_to_be_scraped": _s(("id", L, False), ("url", S, False), ("date", S, False), ("failed", I, False),
                                ("error", S, True)),
    "cache": _s(("key", S, False), ("value", S, False), ("expiration_timestamp", L, True)),
    "geography": _s(("country", S, True), ("continent", S, True)),
}

# Enumerations of the CHECK rules.
ENUMS = {
    "stage": ["group_stage", "playoff", "grand_final"],
    "buy_type": ["pistol", "eco", "semi_eco", "semi_buy", "full_buy"],
    "won_method": ["eliminate", "spike_explode", "defuse", "out_of_time"],
    "side": ["def", "atk"],
    "highlight_type": ["2k", "3k", "4k", "5k", "1v1", "1v2", "1v3", "1v4", "1v5"],
    "veto_action": ["ban", "pick", "remain"],
    "agent_type": ["duelist", "controller", "sentinel", "initiator"],
}

# Keys (primary / unique) per table.
KEYS = {
    "matches": ["id"], "match_maps": ["match_id", "map_id"], "round_stats": ["match_id", "map_id", "round_no"],
    "players_duel_stats": ["match_id", "map_id", "team_1_player_id", "team_2_player_id"],
    "player_overview_stats": ["match_id", "map_id", "player_id", "side"],
    "player_highlights": ["match_id", "map_id", "round_no", "team_id", "player_id", "highlight_type",
                          "player_against_id"],
    "ban_pick_log": ["match_id", "veto_order"],
    "player_stats_rejected": ["match_id", "map_id", "player_id"],
    "duels_rejected": ["match_id", "map_id", "i", "j"], "highlights_rejected": ["match_id", "map_id", "raw"],
    "tournaments": ["id"], "teams": ["id"], "players": ["id"], "countries": ["id"],
}

# Foreign keys: table -> column -> parent table. Fixed values of the schema.
FOREIGN_KEYS = {
    "matches": {"tournament_id": "tournaments", "team_1_id": "teams", "team_2_id": "teams"},
    "match_maps": {"match_id": "matches", "map_id": "maps", "team_1_id": "teams", "team_2_id": "teams",
                   "team_def_first": "teams", "team_pick": "teams"},
    "round_stats": {"match_id": "matches", "map_id": "maps", "team_1_id": "teams", "team_2_id": "teams",
                    "team_def": "teams", "team_won": "teams"},
    "players_duel_stats": {"match_id": "matches", "map_id": "maps", "team_1_player_id": "players",
                           "team_2_player_id": "players"},
    "player_overview_stats": {"match_id": "matches", "map_id": "maps", "agent_id": "agents", "team_id": "teams",
                              "player_id": "players"},
    "player_highlights": {"match_id": "matches", "map_id": "maps", "player_id": "players",
                          "player_against_id": "players"},
    "raw_player_stats": {"agent_name": "agent names"},
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast and order ``df``'s columns to the declared schema of ``table``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table].fields])


# Fixed values of the schema: least and greatest value of checked numbers.
RANGES = {
    "matches": {c: (0, None) for c in ("team_1_score", "team_2_score", "team_1_rating", "team_2_rating")},
    "match_maps": {"duration": (0, None), **{f"team_{t}_{s}_score": (0, None) for t in (1, 2) for s in ("def", "atk", "ot")}},
    "round_stats": {"round_no": (1, None), "team_1_bank": (0, None), "team_2_bank": (0, None)},
    "players_duel_stats": {f.name: (0, None) for f in SCHEMAS["players_duel_stats"].fields if "_vs_" in f.name},
    "player_overview_stats": {"rating": (0, None), "acs": (0, None), "deaths": (0, None), "assists": (0, None), "kast": (0, 100),
                              "adr": (0, None), "hs": (0, 100), "first_kills": (0, None), "first_deaths": (0, None)},
    "player_highlights": {"round_no": (1, None)},
    "ban_pick_log": {"ban_pick_order": (0, None)},
}

# Columns that hold one of an enumeration.
ENUM_COLUMNS = {
    "matches": {"stage": "stage"},
    "round_stats": {"team_1_buy_type": "buy_type", "team_2_buy_type": "buy_type", "won_method": "won_method"},
    "player_overview_stats": {"side": "side"}, "player_highlights": {"highlight_type": "highlight_type"},
    "ban_pick_log": {"veto_action": "veto_action"}, "agents": {"agent_type": "agent_type"},
}


def rules_of(table: str, columns: list[str]) -> list[tuple[str, str, str, str]]:
    """All rules that the declarations state for the ``columns`` that a frame
    of ``table`` has: (name, column, the violation as SQL, a violating value as
    SQL). The SQL is plain enough for any engine; null passes all but NOT NULL."""
    out = []
    for f in SCHEMAS[table].fields:
        if f.name not in columns:
            continue
        c = f.name
        if not f.nullable:
            out.append((f"{c} not null", c, f"{c} IS NULL", "NULL"))
        least, most = RANGES.get(table, {}).get(c, (None, None))
        if least is not None:
            out.append((f"{c} >= {least}", c, f"{c} < {least}", str(least - 1)))
        if most is not None:
            out.append((f"{c} <= {most}", c, f"{c} > {most}", str(most + 1)))
        if c in ENUM_COLUMNS.get(table, {}):
            values = ", ".join(f"'{v}'" for v in ENUMS[ENUM_COLUMNS[table][c]])
            out.append((f"{c} enum", c, f"{c} NOT IN ({values})", "'other'"))
    return out
