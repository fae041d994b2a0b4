"""Queries read the player fields they need, and build each fight text once."""

import json

import __spark_entry__ as entry
import pytest

from arenamart.operators import staging
from arenamart.plans.catalogue.star import Star
from arenamart.schemas import bronze_schema
from arenamart.session import apply_settings

SF = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_named_columns_equal_those_of_the_whole_rows(spark):
    star = Star(spark, SF)
    for names in (["match_id", "kda", "team_win"], ["sen_placed", "player_slot", "loaded_at", "obs_placed"]):
        some, whole = star.players_with(*names), star.players.select(*names)
        assert some.schema == whole.schema
        assert sorted(map(str, some.collect())) == sorted(map(str, whole.collect()))


def test_every_column_has_a_name():
    assert len(staging.player_columns()) == len(staging.PLAYER_COLUMNS)
    assert staging.player_reads(["kda"]) == ["player_slot", "kills", "deaths", "assists"]


@pytest.mark.parametrize(
    "name",
    ["fact_teamfight_players", "fact_hero_matchups", "fact_match_player_runes", "fact_match_player_skills",
     "item_slot_decode", "dq_relationships", "coverage_flags", "coverage_report"],
)
def test_unread_player_fields_are_not_built(spark, name):
    assert "net_worth" not in optimized(entry.queries()[name](spark, SF))


def test_fight_texts_are_built_once(spark):
    fights = Star(spark, SF).silver("stg_teamfights")
    assert optimized(fights).count("StructsToJsonEvaluator") == 1


PLAYERS = [
    [{"player_slot": 0, "hero_id": "", "kills": 3, "deaths": 0, "obs_log": ["a", "b"]}, None, {"player_slot": 0, "stuns": "1.25"}],
    [],
    None,
    [{"player_slot": None, "level": "", "backpack_0": ""}],
]


def test_player_lists_without_other_fields_stay_whole(spark):
    rows = [(i, json.dumps({"match_id": i, "radiant_win": True, "players": p}), None) for i, p in enumerate(PLAYERS)]
    bronze = spark.createDataFrame(rows, bronze_schema("matches"))
    whole = staging.stg_match_players(staging.parse_matches(bronze, "stg_match_players"))
    listed = staging.stg_match_players(staging.parse_matches(bronze))
    assert "arrays_zip" in optimized(listed) and "arrays_zip" not in optimized(whole)
    assert whole.schema == listed.schema
    assert whole.count() == 4 and sorted(map(str, whole.collect())) == sorted(map(str, listed.collect()))


def test_wide_player_rows_run_in_compiled_methods(spark):
    apply_settings(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
