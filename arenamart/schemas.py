"""Declared shapes of match documents and bronze tables.

JSON leaves are read as text and cast in the models: ids stay text, a quoted number still counts,
and an empty text counts as missing.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
TEXTS = T.ArrayType(TEXT)
COUNTS = T.MapType(TEXT, TEXT)
LOG = T.ArrayType(T.StructType([T.StructField("key", TEXT), T.StructField("time", TEXT)]))

PLAYER_TEXT = [
    "player_slot",
    "account_id",
    "hero_id",
    "team_number",
    "kills",
    "deaths",
    "assists",
    "gold",
    "gold_spent",
    "net_worth",
    "gold_per_min",
    "xp_per_min",
    "hero_damage",
    "hero_healing",
    "tower_damage",
    "tower_kills",
    "stuns",
    "last_hits",
    "denies",
    "camps_stacked",
    "creeps_stacked",
    "neutral_kills",
    "rune_pickups",
    "obs_placed",
    "sen_placed",
    "observer_kills",
    "sentry_kills",
    "purchase_ward_observer",
    "purchase_ward_sentry",
    "personaname",
    "level",
    "item_0",
    "item_1",
    "item_2",
    "item_3",
    "item_4",
    "item_5",
    "item_neutral",
    "backpack_0",
    "backpack_1",
    "backpack_2",
    "backpack_3",
    "leaver_status",
    "randomed",
    "firstblood_claimed",
    "buyback_count",
]

PLAYER_NESTED = {
    "obs_log": TEXTS,
    "sen_log": TEXTS,
    "times": TEXTS,
    "gold_t": TEXTS,
    "xp_t": TEXTS,
    "lh_t": TEXTS,
    "dn_t": TEXTS,
    "ability_upgrades_arr": TEXTS,
    "purchase_log": LOG,
    "kills_log": LOG,
    "runes": COUNTS,
    "damage": COUNTS,
    "damage_taken": COUNTS,
    "damage_inflictor_received": COUNTS,
}

PLAYER_IDENTITY = ["player_slot", "account_id", "hero_id"]

MATCH_TEXT = [
    "match_id",
    "radiant_win",
    "duration",
    "game_mode",
    "lobby_type",
    "region",
    "patch",
    "start_time",
    "radiant_score",
    "dire_score",
    "radiant_team_id",
    "dire_team_id",
    "leagueid",
    "first_blood_time",
    "human_players",
    "pre_game_duration",
    "replay_salt",
    "version",
    "timestamp_fetched",
]

PICK_BAN = T.ArrayType(
    T.StructType([T.StructField(n, TEXT) for n in ["is_pick", "hero_id", "team", "order", "player_slot"]])
)

# The player list of a fight stays JSON text, as published.
FIGHT = T.ArrayType(
    T.StructType([T.StructField(n, TEXT) for n in ["start", "end", "last_death", "deaths", "players"]])
)

FIGHT_PLAYER_TEXT = [
    "damage",
    "healing",
    "deaths",
    "buybacks",
    "xp_start",
    "xp_end",
    "xp_delta",
    "gold_delta",
    "ability_uses",
    "item_uses",
    "ability_targets",
    "killed",
    "deaths_pos",
]


def fight_players(fields: list[str] = FIGHT_PLAYER_TEXT) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, TEXT) for n in fields]))


def player_type(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, PLAYER_NESTED.get(n, TEXT)) for n in fields])


def match_document(fields: list[str], player_fields: list[str] | None = None) -> T.StructType:
    """Read schema with only the named fields; the JSON reader skips everything else."""
    nested = {"picks_bans": PICK_BAN, "teamfights": FIGHT}
    columns = [T.StructField(n, nested.get(n, TEXT)) for n in fields]
    if player_fields is not None:
        columns.append(T.StructField("players", T.ArrayType(player_type(player_fields))))
    return T.StructType(columns)


FULL_MATCH = match_document(
    [*MATCH_TEXT, "picks_bans", "teamfights"], [*PLAYER_TEXT, *PLAYER_NESTED]
)

# Bronze tables: name -> (key column, key type).
BRONZE_KEYS = {
    "matches": ("match_id", "bigint"),
    "leagues": ("leagueid", "bigint"),
    "players": ("account_id", "bigint"),
    "teams": ("team_id", "bigint"),
    "hero_stats": ("id", "int"),
    "constants": ("resource", "string"),
}


def bronze_schema(table: str) -> T.StructType:
    key, kind = BRONZE_KEYS[table]
    kinds = {"bigint": T.LongType(), "int": T.IntegerType(), "string": TEXT}
    return T.StructType(
        [
            T.StructField(key, kinds[kind]),
            T.StructField("payload", TEXT),
            T.StructField("loaded_at", T.TimestampType()),
        ]
    )
