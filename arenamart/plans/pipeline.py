"""The whole build: bronze documents to silver tables to gold tables, then checks and a snapshot.

Every step is a function of DataFrames. ``store`` decides whether a table is written and read back
(the normal case: each layer is computed once and later reads are pruned scans) or stays lazy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenamart.operators import checks, dimensions, facts, match_folds, staging
from arenamart.sources.documents import load_folder
from arenamart.sources.sinks import catalog_tables, incremental_sink, snapshot_sink, table_sink, unseen_rows
from arenamart.sources.versions import VersionedTable

Tables = dict[str, DataFrame]
Store = Callable[[str, DataFrame], DataFrame]

# Columns by which the rows of a gold file are sorted, so that scans on them skip row groups.
SORT_BY = {
    "fact_matches": ["match_id"],
    "fact_team_matches": ["match_id"],
    "fact_match_players": ["match_id"],
    "fact_picks_bans": ["match_id"],
    "fact_hero_matchups": ["match_id"],
    "fact_hero_matchups_hero": ["hero_id"],
    "fact_team_h2h": ["team_a_id"],
    "fact_hero_side": ["hero_id", "side"],
    "fact_draft_sequence": ["match_id", "slot"],
    "fact_match_player_minute": ["match_id"],
    "fact_match_player_runes": ["match_id", "player_slot", "rune_key"],
    "fact_match_team_minute": ["match_id", "side", "minute"],
}


def lazily(_: str, df: DataFrame) -> DataFrame:
    return df


def stored_under(folder: str) -> Store:
    """Write every table below a new folder."""

    def store(name: str, df: DataFrame) -> DataFrame:
        keys = [k for k in SORT_BY.get(name, []) if k in df.columns]
        return table_sink(df, f"{folder.rstrip('/')}/{name}", keys)

    return store


def build_silver(nested: DataFrame, bronze: Tables, store: Store = lazily) -> Tables:
    """All silver models. ``nested`` is the parsed match frame, ideally stored as Parquet."""
    constants = bronze["constants"]
    out = {name: store(name, model(nested)) for name, model in staging.MATCH_MODELS.items()}
    name = "stg_match_player_damage_taken_type"
    out[name] = store(name, staging.stg_match_player_damage_taken_type(nested, constants))
    return out | reference_silver(bronze)


def reference_silver(bronze: Tables) -> Tables:
    """Silver models that do not come from match documents."""
    constants, out = bronze["constants"], {}
    out["stg_constants"] = staging.stg_constants(constants)
    out["stg_heroes"] = staging.stg_heroes(constants)
    out["stg_hero_stats"] = staging.stg_hero_stats(bronze["hero_stats"])
    out["stg_leagues"] = staging.stg_leagues(bronze["leagues"])
    out["stg_players"] = staging.stg_players(bronze["players"])
    out["stg_teams"] = staging.stg_teams(bronze["teams"])
    return out


def build_gold(
    s: Tables,
    constants: DataFrame,
    rune_seed: DataFrame | None = None,
    store: Store = lazily,
    nested: DataFrame | None = None,
) -> Tables:
    """All gold models in dependency order.

    With ``nested``, the parsed documents of all matches, the player fact and the draft grid are folded
    inside the documents; without, as after an increment, they are made from silver tables.
    """
    spark = constants.sparkSession
    g: Tables = {}

    def add(name: str, df: DataFrame) -> DataFrame:
        g[name] = store(name, df)
        return g[name]

    matches, players = s["stg_matches"], s["stg_match_players"]
    add("dim_date", dimensions.dim_date(spark))
    seed = rune_seed if rune_seed is not None else dimensions.rune_seed(spark)
    add("dim_rune", dimensions.dim_rune(seed))
    add("dim_game_mode", dimensions.dim_game_mode(constants))
    add("dim_lobby_type", dimensions.dim_lobby_type(constants))
    add("dim_region", dimensions.dim_region(constants))
    add("dim_item", dimensions.dim_item(constants))
    add("dim_league", dimensions.dim_league(s["stg_leagues"]))
    add("dim_patch", dimensions.dim_patch(constants, matches))
    add("fact_picks_bans", facts.fact_picks_bans(s["stg_picks_bans"]))
    add("fact_team_matches", facts.fact_team_matches(matches))
    add("fact_teamfights", facts.fact_teamfights(s["stg_teamfights"]))
    add("dim_team", dimensions.dim_team(s["stg_teams"], matches, g["fact_team_matches"]))
    add("fact_teamfight_players", facts.fact_teamfight_players(g["fact_teamfights"], players))
    add("fact_matches", facts.fact_matches(matches, players, s["stg_heroes"], g["dim_team"]))
    add(
        "fact_teamfight_ability_uses",
        facts.fact_teamfight_ability_uses(g["fact_teamfight_players"]),
    )
    add("fact_phase_momentum", facts.fact_phase_momentum(g["fact_teamfights"], g["fact_matches"]))
    add("fact_team_h2h", facts.fact_team_h2h(g["fact_matches"], g["dim_team"]))
    if nested is not None:
        kinds = staging.inflictor_kinds(constants)
        player_fact = match_folds.fact_match_players(nested, g["dim_item"], kinds)
    else:
        player_fact = facts.fact_match_players(
            players,
            g["dim_item"],
            g["fact_teamfight_ability_uses"],
            g["fact_phase_momentum"],
            g["fact_picks_bans"],
            s["stg_match_player_kills"],
            s["stg_match_player_item_purchases"],
            s["stg_match_player_damage_taken_type"],
        )
    add("fact_match_players", player_fact)
    performance = g["fact_match_players"]
    add(
        "dim_hero",
        dimensions.dim_hero(
            s["stg_heroes"], s["stg_hero_stats"], performance, g["fact_picks_bans"]
        ),
    )
    add("dim_player", dimensions.dim_player(s["stg_players"], players, performance))
    add("fact_hero_side", facts.fact_hero_side(performance))
    heroes, people = g["dim_hero"], g["dim_player"]
    add("dim_hero_role", dimensions.dim_hero_role(heroes))
    if nested is not None:
        folds = store("draft_folds", match_folds.draft_folds(nested))
        add("fact_draft_sequence", match_folds.fact_draft_sequence(folds, heroes))
    else:
        add("fact_draft_sequence", facts.fact_draft_sequence(s["stg_picks_bans"], heroes))
    add("fact_hero_matchups", facts.fact_hero_matchups(performance, g["fact_matches"], heroes))
    for unit, suffix in (("target", "damage"), ("source", "damage_taken")):
        rows = s[f"stg_match_player_{suffix}"]
        add(f"fact_match_player_{suffix}", facts.damage_fact(rows, people, heroes, unit))
    add(
        "fact_match_player_item_purchases",
        facts.fact_match_player_item_purchases(
            s["stg_match_player_item_purchases"], g["dim_item"], people, heroes
        ),
    )
    add(
        "fact_match_player_minute",
        facts.fact_match_player_minute(s["stg_match_player_minute"], constants, people, heroes),
    )
    add(
        "fact_match_player_runes",
        facts.fact_match_player_runes(s["stg_match_player_runes"], g["dim_rune"], people, heroes),
    )
    add(
        "fact_hero_matchup_stats",
        facts.fact_hero_matchup_stats(performance, g["fact_matches"], heroes),
    )
    add("fact_hero_matchups_hero", facts.fact_hero_matchups_hero(g["fact_hero_matchups"], heroes))
    add(
        "fact_match_player_skills",
        facts.fact_match_player_skills(
            s["stg_match_player_skills"], g["fact_match_player_minute"], constants, people, heroes
        ),
    )
    add("fact_match_team_minute", facts.fact_match_team_minute(g["fact_match_player_minute"]))
    return g


def _flattened(spark: SparkSession, folder: str) -> DataFrame | None:
    return VersionedTable(spark, f"{folder}/flattened_matches", ["match_id"]).read()


def extend_silver(nested: DataFrame, constants: DataFrame, folder: str) -> Tables:
    """Append the rows of matches that the stored silver tables do not have yet.

    Which matches were flattened is remembered in a table of its own, written last, so matches
    without any row in a model are not parsed again and a run that broke off is completed.
    """
    spark = nested.sparkSession
    seen = _flattened(spark, folder)
    fresh = unseen_rows(nested, seen, ["match_id"])
    out = {}
    models = dict(staging.MATCH_MODELS)
    models["stg_match_player_damage_taken_type"] = lambda n: (
        staging.stg_match_player_damage_taken_type(n, constants)
    )
    for name, model in models.items():
        grain = staging.GRAINS[name]
        out[name] = incremental_sink(model(fresh), f"{folder}/{name}", grain, grain)
    incremental_sink(fresh.select("match_id"), f"{folder}/flattened_matches", ["match_id"])
    return out


def _unflattened(matches: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Bronze matches that the silver tables do not have yet; nothing of the others is parsed."""
    if seen is None:
        return matches
    known = seen.select(F.col("match_id").cast("bigint").alias("__known"))
    return matches.join(known, F.col("match_id") == F.col("__known"), "left_anti")


def run_layers(
    spark: SparkSession,
    data_dir: str | None,
    folder: str,
    bronze: Tables | None = None,
    rune_seed: DataFrame | None = None,
    *,
    load: bool = True,
    build: bool = True,
    gold: bool = True,
    check: bool = True,
    freshness: bool = True,
    snapshot: str | None = None,
    catalog: str | None = None,
    extend: str | None = None,
    full_refresh: bool = False,
) -> Tables:
    """Load, build, check, tell the age of the data and copy, each with a switch.

    Every run writes below a new folder. ``bronze`` are stored bronze tables to extend (or to build
    from, without loading). With ``extend``, the folder of silver tables that outlive a run, only
    matches not flattened there are parsed and appended; ``full_refresh`` builds all of silver anew
    instead. Without ``gold`` the build ends with silver. With ``catalog``, a database name, the gold tables
    are shown there with statistics of all columns once the build stands. The result holds all tables, ``quarantine`` after a load, the number of failing rows
    of each check as ``check_summary``, and ``freshness``.
    """
    store = stored_under(folder)
    tables: Tables = dict(bronze or {})
    if load:
        loaded = load_folder(spark, data_dir, bronze)
        known = tables.get("matches")
        tables |= {n: store(f"bronze_{n}", df) for n, df in loaded.items()}
        if known is not None:
            tables["matches"] = known.unionByName(tables["matches"])
    if freshness:
        tables["freshness"] = checks.freshness(tables["matches"], F.current_timestamp())
    if not build:
        return tables
    if extend and not full_refresh:
        fresh = _unflattened(tables["matches"], _flattened(spark, extend))
        nested = store("nested_matches", staging.parse_matches(fresh))
        silver = extend_silver(nested, tables["constants"], extend) | reference_silver(tables)
        whole = None
    else:
        nested = store("nested_matches", staging.parse_matches(tables["matches"]))
        silver = build_silver(nested, tables, store)
        whole = nested
    seed = rune_seed if rune_seed is not None else dimensions.rune_seed(spark)
    marts = build_gold(silver, tables["constants"], seed, store, whole) if gold else {}
    tables |= {"nested_matches": nested, "rune_lookup": seed} | silver | marts
    if check:
        tables["check_summary"] = checks.summarize(tables)
    if snapshot:
        snapshot_sink(marts, snapshot)
    if catalog:
        catalog_tables(spark, folder, list(marts), catalog)
    return tables
