"""Flattening of documents with the odd shapes that occur in practice."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from arenamart.operators import staging
from arenamart.operators.staging import MATCH_MODELS, parse_matches

AT = datetime(2024, 1, 2)


def flat(spark, model, *docs):
    rows = [(i, d if isinstance(d, str) else json.dumps(d), AT) for i, d in enumerate(docs)]
    bronze = spark.createDataFrame(rows, "match_id long, payload string, loaded_at timestamp")
    return [r.asDict() for r in MATCH_MODELS[model](parse_matches(bronze, model)).collect()]


def player(slot, **fields):
    return {"player_slot": slot, "account_id": 7, "hero_id": 1, **fields}


def test_match_outcomes_and_blanks(spark):
    rows = flat(
        spark,
        "stg_matches",
        {"match_id": 1, "radiant_win": True, "start_time": 86400, "radiant_team_id": 5},
        {"match_id": 2, "radiant_win": False, "duration": "", "radiant_team_id": ""},
        {"match_id": 3, "radiant_win": None, "duration": "61", "timestamp_fetched": "2020-01-01T00:00:00Z"},
        "not json",
    )
    assert [r["winner"] for r in rows] == ["radiant", "dire", "draw", "draw"]
    assert [r["has_radiant_team"] for r in rows] == [True, False, False, False]
    assert [r["duration_sec"] for r in rows] == [None, None, 61, None]
    assert rows[0]["start_time"] == datetime(1970, 1, 2)
    assert [r["loaded_at"] for r in rows[:3]] == [AT, AT, datetime(2020, 1, 1)]
    assert rows[3]["match_id"] is None


def test_player_measures(spark):
    doc = {
        "match_id": 1,
        "radiant_win": False,
        "players": [
            player(0, team_number=0, kills=5, deaths=3, assists=2, obs_log=[1, 2], obs_placed=9),
            player(128, team_number=1, kills=5, deaths=0, assists=2, obs_log={}, obs_placed="4"),
            player(1, team_number=None, kills=None, assists=1, account_id="", stuns="1.5e-1"),
        ],
    }
    a, b, c = flat(spark, "stg_match_players", doc)
    assert [float(a["kda"]), float(b["kda"]), c["kda"]] == [2.33, 7.0, None]
    assert [a["team_win"], b["team_win"], c["team_win"]] == [False, True, None]
    assert [a["obs_placed"], b["obs_placed"], c["obs_placed"]] == [2, 4, 0]
    assert c["account_id"] is None and float(c["stuns"]) == 0.15


def test_dirty_number_is_an_error(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        flat(spark, "stg_match_players", {"match_id": 1, "players": [player(0, kills="many")]})


def test_missing_and_null_lists(spark):
    docs = [{"match_id": 1, "picks_bans": None}, {"match_id": 2}, {"match_id": 3, "picks_bans": []}]
    assert flat(spark, "stg_picks_bans", *docs) == []
    assert flat(spark, "stg_match_players", {"match_id": 1, "players": None}) == []


def test_draft_sides(spark):
    picks = [{"is_pick": i == 0, "hero_id": i, "team": t, "order": i} for i, t in enumerate([0, 1, None])]
    rows = flat(spark, "stg_picks_bans", {"match_id": 1, "picks_bans": picks})
    assert [(r["order_no"], r["active_team"], r["is_pick"]) for r in rows] == [
        ("0", "Radiant", True), ("1", "Dire", False), ("2", None, False),
    ]


def test_fight_players_stay_text(spark):
    fight = {"start": -5, "end": 10, "deaths": 1, "players": [{"ability_uses": {"a": 1}}]}
    (row,) = flat(spark, "stg_teamfights", {"match_id": 1, "teamfights": [fight]})
    assert row["teamfight_id"] == "1" and row["duration_sec"] == 15
    assert json.loads(row["players"]) == fight["players"]


def test_minutes_follow_times(spark):
    series = {"times": [0, 60, 120], "gold_t": [1, 2], "xp_t": [1, 2, 3, 4], "lh_t": [0, 0, 0], "dn_t": [0, 0, 0]}
    incomplete = {k: v for k, v in series.items() if k != "dn_t"}
    doc = {"match_id": 1, "players": [player(0, **series), player(1, **incomplete), player(2, **{**series, "xp_t": 5})]}
    rows = flat(spark, "stg_match_player_minute", doc)
    assert [(r["player_slot"], r["minute"], r["gold"], r["xp"]) for r in rows] == [
        ("0", 0, 1, 1), ("0", 1, 2, 2), ("0", 2, None, 3),
    ]


def test_log_positions_count_incomplete_entries(spark):
    log = [{"key": "a"}, {"key": "b", "time": -89}, {"time": 5}, {"key": "c", "time": 125}]
    rows = flat(spark, "stg_match_player_item_purchases", {"match_id": 1, "players": [player(130, purchase_log=log)]})
    assert [(r["purchase_index"], r["item_internal_name"], r["minute"], r["side"]) for r in rows] == [
        (1, "b", 0, "Dire"), (3, "c", 2, "Dire"),
    ]


def test_maps_drop_zero_and_wrong_kinds(spark):
    doc = {"match_id": 1, "players": [player(0, runes={"1": 2, "5": 0}), player(1, runes=[1]), player(2)]}
    rows = flat(spark, "stg_match_player_runes", doc)
    assert [(r["player_slot"], r["rune_key"], r["rune_count"]) for r in rows] == [("0", 1, 2)]


def test_damage_types(spark):
    lists = {
        "abilities": {"zap": {"dmg_type": "Magical"}, "list": {"dmg_type": ["Pure"]}},
        "items": {"zap": {"dmg_type": "Pure"}, "blade": {"dmg_type": "Pure"}},
    }
    constants = spark.createDataFrame(
        [(k, json.dumps(v)) for k, v in lists.items()], "resource string, payload string"
    )
    hits = {"null": 1, "zap": 2, "blade": 3, "list": 4, "other": 5}
    doc = json.dumps({"match_id": 1, "players": [player(0, damage_inflictor_received=hits)]})
    bronze = spark.createDataFrame([(doc, AT)], "payload string, loaded_at timestamp")
    model = "stg_match_player_damage_taken_type"
    rows = staging.stg_match_player_damage_taken_type(parse_matches(bronze, model), constants)
    got = {r.inflictor_key: r.damage_type for r in rows.collect()}
    assert got == {"null": "Physical", "zap": "Magical", "blade": "Pure", "list": "Other", "other": "Other"}


def test_one_parse_per_document(spark):
    bronze = spark.createDataFrame([("{}", AT)], "payload string, loaded_at timestamp")
    plan = parse_matches(bronze.withColumn("payload", F.concat("payload", F.lit(""))), "stg_matches")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
