"""Silver layer: match and reference documents to flat typed rows.

Match models work on a frame of nested columns. ``parse_matches`` makes it from bronze JSON text,
with only the fields a model reads; the pipeline parses once, stores the nested frame as Parquet
and lets column pruning pick the fields. Flattening itself never shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arenamart import fixed_values as fv
from arenamart import schemas
from arenamart.functions.columns import (
    blank_to_null,
    json_kind,
    log_minute,
    slot_side,
    to_exact,
    to_int,
)

# Fields each match model reads: (match fields, player fields).
FIELDS: dict[str, tuple[list[str], list[str] | None]] = {
    "stg_matches": (schemas.MATCH_TEXT, None),
    "stg_match_players": (
        ["match_id", "radiant_win", fv.FETCH_STAMP],
        [*schemas.PLAYER_TEXT, "obs_log", "sen_log"],
    ),
    "stg_picks_bans": (["match_id", "picks_bans", fv.FETCH_STAMP], None),
    "stg_teamfights": (["match_id", "teamfights", fv.FETCH_STAMP], None),
    "stg_match_player_minute": (
        ["match_id"],
        [*schemas.PLAYER_IDENTITY, "times", "gold_t", "xp_t", "lh_t", "dn_t"],
    ),
    "stg_match_player_skills": (["match_id"], [*schemas.PLAYER_IDENTITY, "ability_upgrades_arr"]),
    "stg_match_player_item_purchases": (["match_id"], [*schemas.PLAYER_IDENTITY, "purchase_log"]),
    "stg_match_player_kills": (["match_id"], [*schemas.PLAYER_IDENTITY, "kills_log"]),
    "stg_match_player_runes": (["match_id"], [*schemas.PLAYER_IDENTITY, "runes"]),
    "stg_match_player_damage": (["match_id"], [*schemas.PLAYER_IDENTITY, "damage"]),
    "stg_match_player_damage_taken": (["match_id"], [*schemas.PLAYER_IDENTITY, "damage_taken"]),
    "stg_match_player_damage_taken_type": (
        ["match_id"],
        [*schemas.PLAYER_IDENTITY, "damage_inflictor_received"],
    ),
}


def parse_matches(bronze: DataFrame, model: str | None = None) -> DataFrame:
    """Nested match frame from bronze JSON: the fields of one model, or all of them."""
    schema = schemas.match_document(*FIELDS[model]) if model else schemas.FULL_MATCH
    return parse_fields(bronze, "payload", schema, "loaded_at")


def parse_fields(df: DataFrame, text: str, schema, *keep: str) -> DataFrame:
    """The fields of a JSON text as columns, behind the kept ones.

    A generator over a one-element array pins the parse to one evaluation per row. Selecting the
    fields of a parsed column instead lets the optimizer push a parse of its own into each field.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(text, schema))))


def _loaded_at() -> Column:
    return F.coalesce(F.col(fv.FETCH_STAMP).cast("timestamp"), F.col("loaded_at"))


def stg_matches(nested: DataFrame) -> DataFrame:
    """One row per match."""
    radiant_win = F.col("radiant_win").cast("boolean")
    text = {
        n: blank_to_null(F.col(n))
        for n in ["game_mode", "lobby_type", "region", "patch", "radiant_team_id", "dire_team_id"]
    }
    return nested.select(
        "match_id",
        radiant_win.alias("radiant_win"),
        F.when(radiant_win, "radiant").when(~radiant_win, "dire").otherwise("draw").alias("winner"),
        to_int(F.col("duration")).alias("duration_sec"),
        *[text[n].alias(n) for n in ("game_mode", "lobby_type", "region", "patch")],
        F.timestamp_seconds(blank_to_null(F.col("start_time")).cast("double")).alias("start_time"),
        to_int(F.col("radiant_score")).alias("radiant_score"),
        to_int(F.col("dire_score")).alias("dire_score"),
        *[text[n].alias(n) for n in ("radiant_team_id", "dire_team_id")],
        text["radiant_team_id"].isNotNull().alias("has_radiant_team"),
        text["dire_team_id"].isNotNull().alias("has_dire_team"),
        blank_to_null(F.col("leagueid")).alias("leagueid"),
        *[
            to_int(F.col(n)).alias(n)
            for n in ("first_blood_time", "human_players", "pre_game_duration")
        ],
        blank_to_null(F.col("replay_salt")).alias("replay_salt"),
        blank_to_null(F.col("version")).alias("version"),
        _loaded_at().alias("loaded_at"),
    )


def explode_players(nested: DataFrame, fields: list[str], *match_fields: str | Column) -> DataFrame:
    """``match_id``, match fields and a struct ``p`` of the named fields for every player.

    The lists are taken field by field, as only that keeps the other fields out of the Parquet scan:
    behind a generator the whole struct would be read. Players with no other fields go as they are, as taking
    their lists apart and together again costs more than parsing them.
    """
    whole = nested.schema["players"].dataType.elementType.names == fields
    own = F.col("players") if whole else F.arrays_zip(*[F.col(f"players.{f}").alias(f) for f in fields])
    return nested.select("match_id", *match_fields, F.explode(own).alias("p"))


def player_match_fields() -> list[Column]:
    """What a player row takes from its match."""
    return [F.col("radiant_win").cast("boolean").alias("radiant_win"), _loaded_at().alias("at")]


def stg_match_players(nested: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per (match, player) with typed measures: the named columns, or all.

    Naming the columns keeps the other fields out of the player lists, which Spark does not do by itself
    behind a generator.
    """
    rows = explode_players(nested, player_reads(columns), *player_match_fields())
    return rows.select(*player_columns(columns))


def _team_win() -> Column:
    team, win = F.col("p.team_number"), F.col("radiant_win")
    return F.when(team == "0", win).when(team == "1", ~win).alias("team_win")


def player_results(nested: DataFrame) -> DataFrame:
    """Hero and outcome of every player, from two fields of the player list."""
    rows = explode_players(nested, ["hero_id", "team_number"], player_match_fields()[0])
    return rows.select("match_id", blank_to_null(F.col("p.hero_id")).alias("hero_id"), _team_win())


PLAYER_COLUMNS = [
    *"match_id player_slot account_id hero_id team_number team_win kills deaths assists kda".split(),
    *"gold gold_spent net_worth gold_per_min xp_per_min".split(),
    *"hero_damage hero_healing tower_damage tower_kills stuns".split(),
    *"last_hits denies camps_stacked creeps_stacked neutral_kills rune_pickups".split(),
    *"obs_placed sen_placed".split(),
    *"observer_kills sentry_kills purchase_ward_observer purchase_ward_sentry".split(),
    *"personaname level item_0 item_1 item_2 item_3 item_4 item_5 item_neutral".split(),
    *"backpack_0 backpack_1 backpack_2 backpack_3 leaver_status".split(),
    *"randomed firstblood_claimed buyback_count loaded_at".split(),
]

# Columns of a player that are made from other player fields than the one of their name.
PLAYER_SOURCES = {
    "match_id": [],
    "loaded_at": [],
    "team_win": ["team_number"],
    "kda": ["kills", "deaths", "assists"],
    "obs_placed": ["obs_log", "obs_placed"],
    "sen_placed": ["sen_log", "sen_placed"],
}


def player_reads(columns: list[str] | None = None) -> list[str]:
    """The player fields that the named columns of ``stg_match_players`` are made from."""
    fields = FIELDS["stg_match_players"][1]
    if columns is None:
        return fields
    read = {f for c in columns for f in PLAYER_SOURCES.get(c, [c])} | {"player_slot"}
    return [f for f in fields if f in read]


def player_columns(columns: list[str] | None = None) -> list[Column]:
    """The columns of a player from ``match_id``, ``radiant_win``, ``at`` and the struct ``p``."""
    if columns is not None:
        made = dict(zip(PLAYER_COLUMNS, player_columns(), strict=True))
        return [made[c] for c in columns]
    p = {n: F.col(f"p.{n}") for n in schemas.PLAYER_TEXT}
    kills, deaths, assists = (to_int(p[n]) for n in ("kills", "deaths", "assists"))
    takedowns = (kills + assists).cast("decimal(12,0)")
    kda = F.when(deaths > 0, F.round(takedowns / deaths.cast("decimal(10,0)"), 2)).otherwise(
        takedowns
    )

    def wards(log: str, count: str) -> Column:
        return F.coalesce(F.size(F.col(f"p.{log}")), to_int(p[count]), F.lit(0)).alias(count)

    def ints(names: str) -> list[Column]:
        return [to_int(p[n]).alias(n) for n in names.split()]

    def texts(names: str) -> list[Column]:
        return [blank_to_null(p[n]).alias(n) for n in names.split()]

    return [
        F.col("match_id"),
        p["player_slot"].alias("player_slot"),
        *texts("account_id hero_id team_number"),
        _team_win(),
        *ints("kills deaths assists"),
        kda.cast("decimal(12,2)").alias("kda"),
        *ints("gold gold_spent net_worth gold_per_min xp_per_min"),
        *ints("hero_damage hero_healing tower_damage tower_kills"),
        to_exact(p["stuns"]).alias("stuns"),
        *ints("last_hits denies camps_stacked creeps_stacked neutral_kills rune_pickups"),
        wards("obs_log", "obs_placed"),
        wards("sen_log", "sen_placed"),
        *ints("observer_kills sentry_kills purchase_ward_observer purchase_ward_sentry"),
        *texts("personaname level item_0 item_1 item_2 item_3 item_4 item_5 item_neutral"),
        *texts("backpack_0 backpack_1 backpack_2 backpack_3 leaver_status"),
        p["randomed"].cast("boolean").alias("randomed"),
        p["firstblood_claimed"].cast("int").alias("firstblood_claimed"),
        *ints("buyback_count"),
        F.col("at").alias("loaded_at"),
    ]


def stg_picks_bans(nested: DataFrame) -> DataFrame:
    """One row per (match, draft order); a missing or JSON-null list gives none."""
    rows = nested.select(
        "match_id", F.explode("picks_bans").alias("d"), _loaded_at().alias("loaded_at")
    )
    team = F.col("d.team")
    return rows.select(
        "match_id",
        F.col("d.order").alias("order_no"),
        to_int(F.col("d.order")).alias("order_no_int"),
        blank_to_null(F.col("d.hero_id")).alias("hero_id"),
        F.col("d.is_pick").cast("boolean").alias("is_pick"),
        blank_to_null(team).alias("team_number"),
        F.when(team == "0", fv.RADIANT).when(team == "1", fv.DIRE).alias("active_team"),
        blank_to_null(F.col("d.player_slot")).alias("player_slot"),
        "loaded_at",
    )


def stg_teamfights(nested: DataFrame) -> DataFrame:
    """One row per (match, fight number from 1); the player list stays JSON text."""
    rows = nested.select(
        "match_id", F.posexplode("teamfights").alias("at", "f"), _loaded_at().alias("loaded_at")
    )
    start, end = to_int(F.col("f.start")), to_int(F.col("f.end"))
    return rows.select(
        "match_id",
        (F.col("at") + 1).cast("string").alias("teamfight_id"),
        start.alias("start_time"),
        end.alias("end_time"),
        to_int(F.col("f.last_death")).alias("last_death"),
        to_int(F.col("f.deaths")).alias("deaths"),
        (end - start).alias("duration_sec"),
        F.col("f.players").alias("players"),
        "loaded_at",
    )


def _identity() -> list[Column]:
    slot = F.col("p.player_slot")
    return [
        F.col("match_id"),
        slot.alias("player_slot"),
        blank_to_null(F.col("p.account_id")).alias("account_id"),
        blank_to_null(F.col("p.hero_id")).alias("hero_id"),
        slot_side(slot).alias("side"),
    ]


def explode_list(nested: DataFrame, field: str, position: str = "at") -> DataFrame:
    """Identity columns, 0-based ``position`` and ``item`` for every element of a player's list."""
    rows = explode_players(nested, [*schemas.PLAYER_IDENTITY, field])
    return rows.select(*_identity(), F.posexplode(f"p.{field}").alias(position, "item"))


def explode_log(nested: DataFrame, log: str, index: str, key: str) -> DataFrame:
    """Entries of a ``[{key, time}]`` log. Positions count before incomplete entries are left out."""
    time = F.col("item.time").cast("int")
    return (
        explode_list(nested, log, index)
        .where("item.key is not null and item.time is not null")
        .withColumn(index, F.col(index).cast("bigint"))
        .withColumn(key, F.col("item.key"))
        .withColumn("time_sec", time)
        .withColumn("minute", log_minute(time))
        .drop("item")
    )


def explode_counts(nested: DataFrame, field: str, key: str, amount: str) -> DataFrame:
    """Entries with a positive value of a ``{key: number}`` map.

    Values are cast one by one, as a map typed in the schema would turn null when one value is odd.
    """
    return (
        explode_players(nested, [*schemas.PLAYER_IDENTITY, field])
        .select(*_identity(), F.explode(F.col(f"p.{field}")).alias(key, amount))
        .withColumn(amount, F.col(amount).cast("int"))
        .where(F.col(amount) > 0)
    )


def stg_match_player_minute(nested: DataFrame) -> DataFrame:
    """One row per (match, player, sample) from five parallel lists, cut or padded to ``times``."""
    series = ["gold_t", "xp_t", "lh_t", "dn_t"]
    length = F.size("p.times")
    samples = F.arrays_zip(
        F.col("p.times").alias("times"),
        *[F.slice(F.col(f"p.{n}"), F.lit(1), length).alias(n) for n in series],
    )
    present = " and ".join(f"p.{n} is not null" for n in ["times", *series])
    rows = (
        explode_players(nested, FIELDS["stg_match_player_minute"][1])
        .where(present)
        .select(*_identity(), F.explode(samples).alias("item"))
    )
    seconds = F.col("item.times").cast("decimal(18,3)")
    return rows.select(
        "match_id",
        "player_slot",
        "account_id",
        "hero_id",
        "side",
        seconds.alias("time_sec"),
        F.floor(seconds / F.lit(60)).cast("int").alias("minute"),
        F.col("item.gold_t").cast("int").alias("gold"),
        F.col("item.xp_t").cast("int").alias("xp"),
        F.col("item.lh_t").cast("int").alias("last_hits"),
        F.col("item.dn_t").cast("int").alias("denies"),
    )


def stg_match_player_skills(nested: DataFrame) -> DataFrame:
    """One row per (match, player, upgrade), numbered from 0."""
    return (
        explode_list(nested, "ability_upgrades_arr", "upgrade_index")
        .withColumn("upgrade_index", F.col("upgrade_index").cast("bigint"))
        .withColumnRenamed("item", "ability_id")
    )


def stg_match_player_item_purchases(nested: DataFrame) -> DataFrame:
    return explode_log(nested, "purchase_log", "purchase_index", "item_internal_name")


def stg_match_player_kills(nested: DataFrame) -> DataFrame:
    return explode_log(nested, "kills_log", "kill_index", "victim_hero_name")


def stg_match_player_runes(nested: DataFrame) -> DataFrame:
    return explode_counts(nested, "runes", "rune_key", "rune_count").withColumn(
        "rune_key", F.col("rune_key").cast("int")
    )


def stg_match_player_damage(nested: DataFrame) -> DataFrame:
    return explode_counts(nested, "damage", "target_key", "damage_amount")


def stg_match_player_damage_taken(nested: DataFrame) -> DataFrame:
    return explode_counts(nested, "damage_taken", "source_key", "damage_amount")


def stg_match_player_damage_taken_type(nested: DataFrame, constants: DataFrame) -> DataFrame:
    """Damage received per inflictor, typed by the ability list, then by the item list."""
    rows = explode_counts(nested, "damage_inflictor_received", "inflictor_key", "damage_amount")
    typed = rows
    for resource, name in (("abilities", "by_ability"), ("items", "by_item")):
        kinds = resource_entries(constants, resource, "struct<dmg_type:string>").select(
            F.col("key").alias("__k"), F.col("entry.dmg_type").alias(name)
        )
        typed = typed.join(kinds, F.col("inflictor_key") == F.col("__k"), "left").drop("__k")

    def known(name: str) -> Column:
        return F.when(F.col(name).isin(fv.DAMAGE_TYPES), F.col(name))

    kind = F.when(F.col("inflictor_key") == fv.PLAIN_ATTACK_KEY, fv.DAMAGE_TYPES[0]).otherwise(
        F.coalesce(known("by_ability"), known("by_item"), F.lit("Other"))
    )
    return typed.select(
        *[c for c in rows.columns if c != "damage_amount"],
        kind.alias("damage_type"),
        "damage_amount",
    )


def inflictor_kinds(constants: DataFrame) -> dict[str, str]:
    """Damage type of every listed inflictor: by the ability list, then by the item list.

    Two reference documents are read here, so the lists are as small as those are.
    """
    found: dict[str, str] = {}
    for resource in ("items", "abilities"):
        rows = resource_entries(constants, resource, "struct<dmg_type:string>")
        rows = rows.where(F.col("entry.dmg_type").isin(fv.DAMAGE_TYPES))
        found |= {key: kind for key, kind in rows.select("key", "entry.dmg_type").collect()}
    return found | {fv.PLAIN_ATTACK_KEY: fv.DAMAGE_TYPES[0]}


# Reference documents -------------------------------------------------------------------------


def stg_constants(constants: DataFrame) -> DataFrame:
    return constants.select(
        "resource",
        F.col("payload").alias("resource_payload"),
        json_kind(F.col("payload")).alias("payload_type"),
        "loaded_at",
    )


def resource_entries(constants: DataFrame, resource: str, entry_type: str) -> DataFrame:
    """Rows (key, entry) of a resource that is one JSON object keyed by id."""
    one = constants.where(F.col("resource") == resource)
    return one.select(
        F.explode(F.from_json("payload", f"map<string,{entry_type}>")).alias("key", "entry")
    )


def resource_records(constants: DataFrame, resource: str, record_type: str) -> DataFrame:
    """Rows of a resource that is one JSON array of objects."""
    one = constants.where(F.col("resource") == resource)
    return one.select(F.inline(F.from_json("payload", f"array<{record_type}>")))


def stg_heroes(constants: DataFrame) -> DataFrame:
    fields = ["localized_name", "primary_attr", "attack_type", "roles", "img"]
    entry = "struct<name:string," + ",".join(f"{f}:string" for f in fields) + ">"
    return resource_entries(constants, "heroes", entry).select(
        F.col("key").alias("hero_id"),
        F.col("entry.name").alias("hero_name"),
        *[F.col(f"entry.{f}").alias(f) for f in fields],
    )


def _records(bronze: DataFrame, key: str, fields: list[str]) -> DataFrame:
    shape = "struct<" + ",".join(f"{f}:string" for f in fields) + ">"
    keyed = bronze.withColumn(key, F.col(key).cast("string")).withColumnRenamed(key, "__id")
    return parse_fields(keyed, "payload", shape, "__id").withColumnRenamed("__id", key)


def stg_hero_stats(hero_stats: DataFrame) -> DataFrame:
    counts = ["pro_pick", "pro_win", "pro_ban", "pub_pick", "pub_win"]
    rows = _records(hero_stats, "id", counts).select(
        F.col("id").alias("hero_id"), *[to_int(F.col(n)).alias(n) for n in counts]
    )
    share = F.round(
        F.col("pub_win").cast("decimal(12,0)") * 100 / F.col("pub_pick").cast("decimal(10,0)"), 2
    ).cast("decimal(12,2)")
    return rows.withColumn("pub_win_rate", F.when(F.col("pub_pick") > 0, share))


def stg_leagues(leagues: DataFrame) -> DataFrame:
    return _records(leagues, "leagueid", ["name", "tier", "ticket", "banner"]).withColumnRenamed(
        "name", "league_name"
    )


def stg_players(players: DataFrame) -> DataFrame:
    rows = _records(players, "account_id", ["name", "rank_tier", "team_id", "avatarmedium"])
    return rows.select(
        "account_id",
        F.col("name").alias("player_name"),
        blank_to_null(F.col("rank_tier")).alias("rank_tier"),
        blank_to_null(F.col("team_id")).alias("team_id"),
        F.col("avatarmedium").alias("avatar_medium"),
    )


def stg_teams(teams: DataFrame) -> DataFrame:
    rows = _records(teams, "team_id", ["name", "tag", "rating", "wins", "losses", "logo_url"])
    return rows.select(
        "team_id",
        F.col("name").alias("team_name"),
        F.col("tag").alias("team_tag"),
        to_exact(F.col("rating")).alias("rating"),
        to_int(F.col("wins")).alias("wins"),
        to_int(F.col("losses")).alias("losses"),
        "logo_url",
    )


MATCH_MODELS = {
    "stg_matches": stg_matches,
    "stg_match_players": stg_match_players,
    "stg_picks_bans": stg_picks_bans,
    "stg_teamfights": stg_teamfights,
    "stg_match_player_minute": stg_match_player_minute,
    "stg_match_player_skills": stg_match_player_skills,
    "stg_match_player_item_purchases": stg_match_player_item_purchases,
    "stg_match_player_kills": stg_match_player_kills,
    "stg_match_player_runes": stg_match_player_runes,
    "stg_match_player_damage": stg_match_player_damage,
    "stg_match_player_damage_taken": stg_match_player_damage_taken,
}

# Rows of each incremental model are unique by these columns.
GRAINS = {
    "stg_matches": ["match_id"],
    "stg_match_players": ["match_id", "player_slot"],
    "stg_picks_bans": ["match_id", "order_no"],
    "stg_teamfights": ["match_id", "teamfight_id"],
    "stg_match_player_minute": ["match_id", "player_slot", "minute"],
    "stg_match_player_skills": ["match_id", "player_slot", "upgrade_index"],
    "stg_match_player_item_purchases": ["match_id", "player_slot", "purchase_index"],
    "stg_match_player_kills": ["match_id", "player_slot", "kill_index"],
    "stg_match_player_runes": ["match_id", "player_slot", "rune_key"],
    "stg_match_player_damage": ["match_id", "player_slot", "target_key"],
    "stg_match_player_damage_taken": ["match_id", "player_slot", "source_key"],
    "stg_match_player_damage_taken_type": ["match_id", "player_slot", "inflictor_key"],
}
