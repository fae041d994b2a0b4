"""The models over the driver tables, as lazy frames that feed each other."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from arenamart.operators import dimensions, facts, match_folds, staging
from arenamart.plans.driver_tables import SECTIONS as DRIVER_SECTIONS
from arenamart.plans.driver_tables import DriverTables
from arenamart.session import fresh_path
from arenamart.sources import coverage
from arenamart.sources.sinks import table_sink

# Document sections each silver model reads.
SECTIONS = {
    "stg_matches": (),
    "stg_match_players": ("players", "wards"),
    "stg_picks_bans": ("picks_bans",),
    "stg_teamfights": ("teamfights",),
    "stg_match_player_minute": ("minutes",),
    "stg_match_player_skills": ("upgrades",),
    "stg_match_player_item_purchases": ("logs",),
    "stg_match_player_kills": ("logs",),
    "stg_match_player_runes": ("runes",),
    "stg_match_player_damage": ("damage",),
    "stg_match_player_damage_taken": ("damage_taken",),
    "stg_match_player_damage_taken_type": ("inflictors",),
}


class Star:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.driver = DriverTables(spark, sf_dir)
        self._silver: dict[str, DataFrame] = {}

    def from_documents(self, model: str) -> DataFrame:
        """A silver model the long way: documents as JSON text, parsed and flattened."""
        sections = SECTIONS[model]
        bronze = self.driver.documents(*(sections or ("",)))
        nested = staging.parse_matches(bronze, model)
        return self._flatten(model, nested)

    def _flatten(self, model: str, nested: DataFrame) -> DataFrame:
        if model == "stg_match_player_damage_taken_type":
            lists = self.constants("abilities", "items")
            return staging.stg_match_player_damage_taken_type(nested, lists)
        return staging.MATCH_MODELS[model](nested)

    def silver(self, model: str) -> DataFrame:
        """A silver model from nested rows, for the gold models."""
        if model not in self._silver:
            nested = self.driver.nested(*SECTIONS[model])
            self._silver[model] = self._flatten(model, nested)
        return self._silver[model]

    def coverage_documents(self) -> DataFrame:
        """Match documents with the lists and player fields that coverage looks at."""
        fields = ["hero_id", *coverage.PLAYER_FLAGS.values()]
        wanted = [s for s, own in DRIVER_SECTIONS.items() if set(own) & set(fields)]
        return self.driver.nested(*coverage.MATCH_FLAGS.values(), *wanted, fields=fields)

    def constants(self, *names: str) -> DataFrame:
        return self.driver.constants(*names)

    @cached_property
    def matches(self) -> DataFrame:
        return self.silver("stg_matches")

    @cached_property
    def players(self) -> DataFrame:
        return self.silver("stg_match_players")

    def players_with(self, *columns: str) -> DataFrame:
        """The named columns of all player rows; the documents carry no other player fields."""
        nested = self.driver.nested("players", "wards", fields=staging.player_reads(list(columns)))
        return staging.stg_match_players(nested, list(columns))

    @cached_property
    def drafts(self) -> DataFrame:
        return self.silver("stg_picks_bans")

    @cached_property
    def stg_heroes(self) -> DataFrame:
        return staging.stg_heroes(self.constants("heroes"))

    @cached_property
    def stg_hero_stats(self) -> DataFrame:
        return staging.stg_hero_stats(self.driver.hero_stats)

    @cached_property
    def stg_teams(self) -> DataFrame:
        return staging.stg_teams(self.driver.teams)

    @cached_property
    def stg_players(self) -> DataFrame:
        return staging.stg_players(self.driver.pros)

    @cached_property
    def heroes(self) -> DataFrame:
        """Hero dimension without match statistics."""
        return dimensions.hero_identity(self.stg_heroes, self.stg_hero_stats)

    @cached_property
    def people(self) -> DataFrame:
        """Player dimension without match statistics."""
        return dimensions.player_identity(
            self.stg_players,
            self.players_with("match_id", "player_slot", "account_id", "personaname", "loaded_at"),
        )

    @cached_property
    def teams(self) -> DataFrame:
        """Team dimension without match statistics."""
        return dimensions.team_identity(self.stg_teams, self.matches)

    @cached_property
    def items(self) -> DataFrame:
        return dimensions.dim_item(self.constants("items", "item_ids"))

    @cached_property
    def runes(self) -> DataFrame:
        return dimensions.dim_rune(dimensions.rune_seed(self.spark))

    @cached_property
    def leagues(self) -> DataFrame:
        return dimensions.dim_league(staging.stg_leagues(self.driver.leagues))

    @cached_property
    def fact_matches(self) -> DataFrame:
        return facts.fact_matches(
            self.matches,
            self.players_with("match_id", "player_slot", "hero_id", "team_number"),
            self.stg_heroes,
            self.teams,
        )

    @cached_property
    def team_matches(self) -> DataFrame:
        return facts.fact_team_matches(self.matches)

    @cached_property
    def fights(self) -> DataFrame:
        return facts.fact_teamfights(self.silver("stg_teamfights"))

    @cached_property
    def fight_players(self) -> DataFrame:
        return facts.fact_teamfight_players(
            self.fights, self.players_with("match_id", "player_slot", "hero_id", "account_id")
        )

    @cached_property
    def ability_uses(self) -> DataFrame:
        return facts.fact_teamfight_ability_uses(self.fight_players)

    @cached_property
    def match_minutes(self) -> DataFrame:
        """The match columns that phase momentum reads."""
        return self.matches.withColumn(
            "duration_min", facts.minutes(self.matches["duration_sec"])
        )

    @cached_property
    def momentum(self) -> DataFrame:
        return facts.fact_phase_momentum(self.fights, self.match_minutes)

    @cached_property
    def fact_players(self) -> DataFrame:
        """The player fact folded inside the documents."""
        lists = self.constants("abilities", "items")
        kinds = staging.inflictor_kinds(lists)
        results = self.players_with("hero_id", "team_win")
        return match_folds.fact_match_players(self.player_documents, self.items, kinds, results)

    @cached_property
    def player_documents(self) -> DataFrame:
        return self.driver.nested("players", "wards", "logs", "inflictors", "picks_bans", "teamfights")

    @cached_property
    def draft_sequence(self) -> DataFrame:
        folds = match_folds.draft_folds(self.driver.nested("picks_bans"))
        folds = table_sink(folds, fresh_path(self.spark, "draft_folds"))
        return match_folds.fact_draft_sequence(folds, self.heroes)

    @cached_property
    def sided_players(self) -> DataFrame:
        """Player rows with the side, which is all the hero facts need of the player fact."""
        players = self.players_with("hero_id", "team_number", "team_win")
        return players.withColumn("side", facts.team_side(players["team_number"]))

    @cached_property
    def matchups(self) -> DataFrame:
        return facts.fact_hero_matchups(self.paired_players, self.matches, self.heroes)

    @cached_property
    def paired_players(self) -> DataFrame:
        """What hero pairings read of the player rows."""
        return self.players_with("match_id", "hero_id", "team_number")

    @cached_property
    def minute_fact(self) -> DataFrame:
        return facts.fact_match_player_minute(
            self.silver("stg_match_player_minute"),
            self.constants("xp_level"),
            self.people,
            self.heroes,
        )
