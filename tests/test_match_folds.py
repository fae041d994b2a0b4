"""Folds inside the document against the grouped forms on silver tables, on awkward documents."""

import json

import pytest

from arenamart.operators import dimensions, facts, staging
from arenamart.operators import match_folds as mf
from arenamart.schemas import bronze_schema


def member(i, uses=None):
    return {"gold_delta": 10 * i - 35, "xp_delta": str(i), "deaths": 0, "ability_uses": uses if uses is not None else {f"a{i % 3}": i, "b": 2}}


def player(slot, hero, team, **more):
    return {"player_slot": slot, "hero_id": hero, "team_number": team, "item_0": "1", "kills": 1, "deaths": 2, "assists": 3} | more


def log(*keys):
    return [{"key": k, "time": t} for t, k in enumerate(keys)]


BUYS = log("ward_observer", "dust", None, "gem", "gem", "boots")
HITS = {"null": 5, "spell": 7, "item": 9, "odd": 3, "zero": 0, "none": None}
DOCS = [
    {
        "match_id": 1, "radiant_win": True,
        "players": [
            player(0, 11, 0, kills_log=log("x", None, "y"), purchase_log=BUYS, damage_inflictor_received=HITS),
            player(1, 5, 0, kills_log=[], purchase_log=log("boots"), damage_inflictor_received={"odd": 4}),
            player(128, 7, 1), player(132, "", 1, purchase_log=[{"key": "gem", "time": None}]), player(None, 8, None, kills_log=log("x")),
        ],
        "picks_bans": [
            {"is_pick": True, "hero_id": 5, "team": 0, "order": 3}, {"is_pick": False, "hero_id": 5, "team": 1, "order": 1},
            {"is_pick": True, "hero_id": 11, "team": 0, "order": 2}, {"is_pick": True, "hero_id": 7, "team": 1, "order": 9},
            {"is_pick": None, "hero_id": 9, "team": 1, "order": 10}, {"is_pick": False, "hero_id": None, "team": None, "order": 11},
            {"is_pick": True, "hero_id": 11, "team": 1, "order": 12}, {"is_pick": True, "hero_id": 8, "team": 0, "order": ""},
        ],
        "teamfights": [
            {"start": -5, "players": [member(i, {"early": 9}) for i in range(3)]}, {"start": 30, "players": [member(i) for i in range(12)]},
            {"start": 1300, "players": [member(i, {}) for i in range(4)]}, {"start": None, "players": [member(7, None), member(8, {"b": None, "c": 4})]},
            {"start": 2500, "players": None}, {"start": 40, "players": []},
        ],
    },
    {  # two players of one slot
        "match_id": 2, "radiant_win": False,
        "players": [
            player(0, 11, 0, kills_log=log("x"), purchase_log=log("gem"), damage_inflictor_received={"spell": 1}),
            player(0, 3, 0, kills_log=log("y", "z"), purchase_log=None, damage_inflictor_received={"spell": 2, "item": 1}), player(2, 11, 1),
        ],
        "picks_bans": [], "teamfights": [],
    },
    {"match_id": 3, "radiant_win": None, "players": [player(129, 11, "1")], "picks_bans": None},
    {"match_id": 4, "radiant_win": True, "players": []},
    {"match_id": 5, "radiant_win": True, "players": None, "picks_bans": [{"is_pick": False, "hero_id": 4, "team": 1, "order": 1}]},
    {"match_id": None, "radiant_win": True, "players": [player(0, 11, 0, kills_log=log("x"))]},
]
CONSTANTS = {
    "items": {"item": {"dname": "Item", "dmg_type": "Pure"}, "spell": {"dmg_type": "Pure"}, "boots": {"dname": "Boots", "dmg_type": None}},
    "abilities": {"spell": {"dmg_type": "Magical"}, "odd": {"dmg_type": "Strange"}},
    "item_ids": {"1": "boots"},
}


@pytest.fixture(scope="module")
def frames(spark):
    rows = [(i, json.dumps(d), None) for i, d in enumerate(DOCS)]
    bronze = spark.createDataFrame(rows, bronze_schema("matches"))
    lists = [(n, json.dumps(d), None) for n, d in CONSTANTS.items()]
    return staging.parse_matches(bronze), spark.createDataFrame(lists, bronze_schema("constants"))


def rows(df):
    return sorted(map(repr, df.collect()))


def test_player_fact(frames):
    nested, constants = frames
    items, kinds = dimensions.dim_item(constants), staging.inflictor_kinds(constants)
    assert kinds == {"spell": "Magical", "item": "Pure", "null": "Physical"}
    players, matches = staging.stg_match_players(nested), staging.stg_matches(nested)
    fights = facts.fact_teamfights(staging.stg_teamfights(nested))
    uses = facts.fact_teamfight_ability_uses(facts.fact_teamfight_players(fights, players))
    minutes = matches.withColumn("duration_min", facts.minutes(matches["duration_sec"]))
    grouped = facts.fact_match_players(
        players,
        items,
        uses,
        facts.fact_phase_momentum(fights, minutes),
        facts.fact_picks_bans(staging.stg_picks_bans(nested)),
        staging.stg_match_player_kills(nested),
        staging.stg_match_player_item_purchases(nested),
        staging.stg_match_player_damage_taken_type(nested, constants),
    )
    folded = mf.fact_match_players(nested, items, kinds)
    assert folded.dtypes == grouped.dtypes
    assert rows(folded) == rows(grouped)
    first = folded.where("match_id = '1' and player_slot = '0'").first()
    assert (first.enemy_heroes_killed, first.gem_bought, first.damage_taken_magical, first.pick_sequence) == (2, 2, 7, 4)


def test_no_player_row_is_shuffled(frames):
    nested, constants = frames
    plan = mf.enriched_players(nested, staging.inflictor_kinds(constants))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_draft_grid(frames, spark):
    nested, _ = frames
    heroes = spark.createDataFrame([("5", "Five", "i5"), ("11", "Eleven", "i11")], "hero_id string, hero_localized_name string, img string")
    grouped = facts.fact_draft_sequence(staging.stg_picks_bans(nested), heroes)
    folded = mf.fact_draft_sequence(mf.draft_folds(nested), heroes)
    assert folded.columns == grouped.columns and rows(folded) == rows(grouped)
    assert "Exchange hashpartitioning" not in mf.draft_folds(nested)._jdf.queryExecution().executedPlan().toString()


def test_scans_read_own_fields_only(frames, tmp_path):
    nested, _ = frames
    nested.write.parquet(str(tmp_path / "n"))
    stored = nested.sparkSession.read.parquet(str(tmp_path / "n"))
    scan = [x for x in stored.inputFiles()]
    plan = staging.stg_match_player_kills(stored)._jdf.queryExecution().executedPlan()
    own = plan.collectLeaves().head().requiredSchema().simpleString()
    assert scan and "kills_log" in own and "purchase_log" not in own and "times" not in own


def test_lookups_carry_a_player_as_one_value(spark):
    from arenamart.plans.catalogue.star import Star

    lines = Star(spark, "/root/testdata/sf0.001").fact_players._jdf.queryExecution().optimizedPlan().toString().splitlines()
    between = [x for x in lines if "Project [__item_" in x]
    assert len(between) >= 6 and all("__player" in x and "net_worth" not in x for x in between)
    # Hero win rates come from player rows without fights, which three steps gather once.
    assert sum("Aggregate [" in x and "flag" in x for x in lines) == 3


def test_given_results_equal_those_of_the_documents(frames):
    nested, constants = frames
    items, kinds = dimensions.dim_item(constants), staging.inflictor_kinds(constants)
    given = mf.fact_match_players(nested, items, kinds, staging.stg_match_players(nested, ["hero_id", "team_win"]))
    assert rows(given) == rows(mf.fact_match_players(nested, items, kinds))
