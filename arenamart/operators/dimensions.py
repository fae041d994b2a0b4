"""Gold dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arenamart import fixed_values as fv
from arenamart.functions.columns import (
    blank_to_null,
    display_name,
    exact_avg,
    hosted_image,
    rate,
)
from arenamart.functions.relations import latest_per_key, lookup, null_aware_not_in
from arenamart.operators.staging import resource_entries, resource_records


def dim_date(
    spark: SparkSession, first: str = fv.CALENDAR_FIRST, last: str = fv.CALENDAR_LAST
) -> DataFrame:
    """One row per day with calendar attributes; names are not padded."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date")
    )
    return with_calendar(days)


def with_calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes for a frame with a ``date`` column."""
    d = F.col("date")
    year, quarter = F.year(d), F.quarter(d)
    sunday_based = F.dayofweek(d) - 1
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return days.select(
        "date",
        F.dayofmonth(d).alias("day_of_month"),
        sunday_based.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.date_format(d, "EEE").alias("day_of_week_short_name"),
        (F.weekday(d) + 1).alias("iso_day_of_week"),
        sunday_based.isin(0, 6).alias("is_weekend"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.weekofyear(d).alias("iso_week_of_year"),
        F.trunc(d, "week").alias("week_start_date"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM").alias("month_short_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        quarter.alias("quarter"),
        F.concat(F.lit("Q"), quarter).alias("quarter_name"),
        F.concat(year, F.lit("-Q"), quarter).alias("year_quarter"),
        year.alias("year"),
        F.date_format(d, "yyyy-MMM").alias("year_month_name"),
        leap.alias("is_leap_year"),
    )


def _labels(constants: DataFrame, resource: str) -> DataFrame:
    entries = resource_entries(constants, resource, "struct<name:string,balanced:string>")
    return entries.select(
        F.col("key").alias(f"{resource}_id"),
        display_name(F.col("entry.name"), f"{resource}_").alias(f"{resource}_name"),
        F.col("entry.balanced").cast("boolean").alias("is_balanced"),
    )


def dim_game_mode(constants: DataFrame) -> DataFrame:
    return _labels(constants, "game_mode")


def dim_lobby_type(constants: DataFrame) -> DataFrame:
    return _labels(constants, "lobby_type")


def dim_region(constants: DataFrame) -> DataFrame:
    return resource_entries(constants, "region", "string").select(
        F.col("key").alias("region_id"), F.col("entry").alias("region_name")
    )


def dim_item(constants: DataFrame) -> DataFrame:
    """Item id to internal and display name; without a display name the internal one is shown."""
    shown = (
        resource_entries(constants, "items", "struct<dname:string,img:string>")
        .select("key", F.col("entry.dname").alias("dname"), F.col("entry.img").alias("image"))
        .where("dname is not null")
    )
    ids = resource_entries(constants, "item_ids", "string").select(
        F.col("key").alias("item_id"), F.col("entry").alias("item_internal_name")
    )
    return lookup(ids, shown, "item_internal_name", "key", {"dname": "dname", "image": "image"}).select(
        "item_id",
        "item_internal_name",
        F.coalesce("dname", "item_internal_name").alias("item_name"),
        hosted_image(F.col("image")).alias("img"),
    )


def dim_patch(constants: DataFrame, matches: DataFrame) -> DataFrame:
    """Patches of the matches and of the patch list, each once.

    A full outer join of two unique key sets gives the same rows as listing the seen patches and
    then the unseen ones.
    """
    listed = resource_records(constants, "patch", "struct<id:int,name:string,date:string>").select(
        F.col("id").cast("string").alias("patch_id"),
        F.col("name").alias("listed_name"),
        F.to_timestamp("date").cast("date").alias("patch_date"),
    )
    seen = matches.select(F.col("patch").alias("patch_id")).where("patch_id <> ''").distinct()
    return seen.join(listed, "patch_id", "full").select(
        "patch_id",
        F.coalesce("listed_name", F.lit("Unknown")).alias("patch_name"),
        "patch_date",
        F.coalesce(F.col("patch_id").cast("int"), F.lit(0)).alias("sort_order"),
    )


def dim_rune(seed: DataFrame) -> DataFrame:
    return seed.select(F.col("rune_key").cast("int").alias("rune_key"), "rune_name")


def rune_seed(spark: SparkSession) -> DataFrame:
    """The rune names as a seed table, keyed by position."""
    names = F.array(*[F.lit(n) for n in fv.RUNE_NAMES])
    return spark.range(1).select(F.posexplode(names).alias("rune_key", "rune_name"))


def dim_league(leagues: DataFrame) -> DataFrame:
    return leagues.select(
        "leagueid", F.upper("league_name").alias("league_name"), "tier", "ticket", "banner"
    )


# Statistics over the loaded matches --------------------------------------------------------------

AVERAGES = [
    # (column, decimals, scale of the column)
    ("kda", 2, 2),
    ("gold_per_min", 0, 0),
    ("xp_per_min", 0, 0),
    ("hero_damage", 0, 0),
    ("tower_damage", 0, 0),
    ("hero_healing", 0, 0),
    ("last_hits", 1, 0),
    ("denies", 1, 0),
    ("net_worth", 0, 0),
    ("stuns", 2, 8),
]
AVERAGE_NAMES = {"gold_per_min": "gpm", "xp_per_min": "xpm"}


def performance_stats(players: DataFrame, key: str) -> DataFrame:
    """Match statistics per hero or account. Sums and counts combine before the shuffle, so a
    value shared by very many rows costs no more than any other."""
    wins = F.count_if(F.col("team_win"))
    averages = [
        exact_avg(F.col(c), digits, scale).alias(f"match_avg_{AVERAGE_NAMES.get(c, c)}")
        for c, digits, scale in AVERAGES
    ]
    return players.groupBy(key).agg(
        F.count(F.lit(1)).alias("match_picks"),
        wins.alias("match_wins"),
        rate(wins, F.count(F.lit(1))).alias("match_win_rate"),
        *averages,
        exact_avg(blank_to_null(F.col("level")).cast("decimal(10,2)"), 2, 2).alias(
            "match_avg_level"
        ),
        *[F.sum(c).alias(f"match_total_{c}") for c in ("kills", "deaths", "assists")],
        F.count_if(F.col("firstblood_claimed") == 1).alias("match_firstbloods"),
        exact_avg(F.col("rune_pickups"), 2).alias("match_avg_rune_pickups"),
        exact_avg(F.col("buyback_count"), 2).alias("match_avg_buybacks"),
    )


ZERO_FILLED = [
    "match_picks",
    "match_wins",
    "match_win_rate",
    "match_total_kills",
    "match_total_deaths",
    "match_total_assists",
    "match_firstbloods",
]
HERO_STATS = [
    "match_picks",
    "match_wins",
    "match_win_rate",
    "match_avg_kda",
    "match_avg_gpm",
    "match_avg_xpm",
    "match_avg_hero_damage",
    "match_avg_tower_damage",
    "match_avg_hero_healing",
    "match_avg_last_hits",
    "match_avg_denies",
    "match_avg_net_worth",
    "match_avg_stuns",
    "match_avg_level",
    "match_total_kills",
    "match_total_deaths",
    "match_total_assists",
    "match_firstbloods",
]
PLAYER_STATS = [*HERO_STATS, "match_avg_rune_pickups", "match_avg_buybacks"]


def _zero_filled(names: list[str], filled: list[str]) -> list[Column]:
    return [F.coalesce(n, F.lit(0)).alias(n) if n in filled else F.col(n) for n in names]


def hero_identity(heroes: DataFrame, hero_stats: DataFrame) -> DataFrame:
    """Heroes with labels, images and public statistics, plus the unknown hero."""
    attr = F.col("primary_attr")
    label = F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for kv in fv.ATTRIBUTE_LABELS.items() for x in kv]), attr),
        attr,
    )
    name = F.col("hero_name")
    icon = F.concat(
        F.lit(fv.HERO_ICON_FOLDER),
        F.replace(name, F.lit(fv.HERO_NAME_PREFIX), F.lit("")),
        F.lit(".png"),
    )
    counts = ["pro_pick", "pro_win", "pro_ban", "pub_pick", "pub_win", "pub_win_rate"]
    known = lookup(heroes, hero_stats, "hero_id", "hero_id", {c: c for c in counts}).select(
        "hero_id",
        F.coalesce(name, F.lit("unknown")).alias("hero_name"),
        F.coalesce("localized_name", F.lit("Unknown")).alias("hero_localized_name"),
        label.alias("primary_attr"),
        "attack_type",
        "roles",
        F.concat(F.lit(fv.IMAGE_HOST), F.rtrim(F.col("img"), F.lit("?"))).alias("img"),
        F.when(name.like(fv.HERO_NAME_PREFIX + "%"), icon).alias("hero_icon_sm"),
        *counts,
    )
    return with_unknown_member(
        known,
        {
            "hero_id": fv.UNKNOWN_HERO_ID,
            "hero_name": "unknown",
            "hero_localized_name": "Unknown",
        },
    )


def with_unknown_member(dim: DataFrame, values: dict[str, str]) -> DataFrame:
    """Append one row that stands for members the dimension does not know."""
    row = dim.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema.fields]
    )
    return dim.unionByName(row)


def dim_hero(
    heroes: DataFrame, hero_stats: DataFrame, players: DataFrame, drafts: DataFrame
) -> DataFrame:
    """Hero dimension with statistics over the loaded player rows and drafts."""
    draft_counts = drafts.groupBy("hero_id").agg(
        F.count_if(F.col("is_pick")).alias("match_draft_picks"),
        F.count_if(~F.col("is_pick")).alias("match_draft_bans"),
    )
    identity = hero_identity(heroes, hero_stats)
    played = performance_stats(players, "hero_id").select("hero_id", *HERO_STATS)
    return (
        identity.join(played, "hero_id", "left")
        .join(draft_counts, "hero_id", "left")
        .select(
            *identity.columns,
            *_zero_filled(HERO_STATS, ZERO_FILLED),
            *_zero_filled(
                ["match_draft_picks", "match_draft_bans"], ["match_draft_picks", "match_draft_bans"]
            ),
        )
    )


def dim_hero_role(heroes: DataFrame) -> DataFrame:
    """Bridge (hero, role) from the JSON text list of roles."""
    return heroes.where(F.col("hero_id") != fv.UNKNOWN_HERO_ID).select(
        "hero_id", F.explode(F.from_json("roles", "array<string>")).alias("role")
    )


def player_identity(pros: DataFrame, players: DataFrame) -> DataFrame:
    """Pro players, and every other account of the matches under its latest name.

    Player rows fold to one row per account before they meet the pro list.
    """
    named = players.withColumn("personaname", blank_to_null(F.col("personaname")))
    latest = latest_per_key(
        named, ["account_id"], ["loaded_at", "match_id", "player_slot"], ["personaname"]
    )
    others = null_aware_not_in(latest, "account_id", pros, "account_id")
    none = F.lit(None).cast("string")
    return pros.withColumn("player_type", F.lit("Pro")).unionByName(
        others.select(
            "account_id",
            F.col("personaname").alias("player_name"),
            none.alias("rank_tier"),
            none.alias("team_id"),
            none.alias("avatar_medium"),
            F.lit("Match Participant").alias("player_type"),
        )
    )


def dim_player(pros: DataFrame, players: DataFrame, performance: DataFrame) -> DataFrame:
    """Player dimension. ``players`` are silver rows, ``performance`` the player fact."""
    identity = player_identity(pros, players)
    stats = performance_stats(performance, "account_id").select("account_id", *PLAYER_STATS)
    return identity.join(stats, "account_id", "left").select(
        *identity.columns, *_zero_filled(PLAYER_STATS, ZERO_FILLED)
    )


def team_identity(teams: DataFrame, matches: DataFrame) -> DataFrame:
    """Registered teams and the team ids that only matches know, without duplicates."""
    named = F.upper("team_name")
    shown = F.coalesce(
        blank_to_null(named),
        blank_to_null(F.upper("team_tag")),
        F.concat(F.lit("TEAM "), F.col("team_id")),
    )
    registered = teams.select(
        "team_id", shown.alias("team_name"), "team_tag", "rating", "wins", "losses", "logo_url"
    )
    seen = (
        matches.select(F.explode(F.array("radiant_team_id", "dire_team_id")).alias("team_id"))
        .where("team_id is not null")
        .distinct()
    )
    strangers = null_aware_not_in(seen, "team_id", teams, "team_id").select(
        "team_id",
        F.lit("UNKNOWN").alias("team_name"),
        *[
            F.lit(None).cast(registered.schema[c].dataType).alias(c)
            for c in ("team_tag", "rating", "wins", "losses", "logo_url")
        ],
    )
    return registered.distinct().unionByName(strangers)


TEAM_STATS = [
    "match_appearances",
    "match_wins",
    "match_losses",
    "match_win_rate",
    "match_avg_score",
    "match_avg_opponent_score",
    "match_avg_score_differential",
    "match_total_score",
]


def team_stats(team_matches: DataFrame) -> DataFrame:
    wins = F.count_if(F.col("team_win"))
    margin = F.col("team_score") - F.col("opponent_score")
    return team_matches.groupBy("team_id").agg(
        F.count(F.lit(1)).alias("match_appearances"),
        wins.alias("match_wins"),
        F.count_if(~F.col("team_win")).alias("match_losses"),
        rate(wins, F.count(F.lit(1))).alias("match_win_rate"),
        exact_avg(F.col("team_score"), 1).alias("match_avg_score"),
        exact_avg(F.col("opponent_score"), 1).alias("match_avg_opponent_score"),
        exact_avg(margin, 2).alias("match_avg_score_differential"),
        F.sum("team_score").alias("match_total_score"),
    )


def dim_team(teams: DataFrame, matches: DataFrame, team_matches: DataFrame) -> DataFrame:
    identity = team_identity(teams, matches)
    filled = [n for n in TEAM_STATS if "avg" not in n]
    return identity.join(team_stats(team_matches), "team_id", "left").select(
        *identity.columns, *_zero_filled(TEAM_STATS, filled)
    )
