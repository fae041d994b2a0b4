import json

from arenamart.operators import checks, dimensions, facts


def test_talent_names(spark):
    cases = {
        "1": ("special_bonus_a", "+{s:value}% Gain Speed", "Gain Speed"),
        "2": ("special_bonus_b", "+{s:value} Damage", ""),
        "3": ("special_bonus_c", "-{s:value}s Cooldown", "Cooldown"),
        "4": ("attribute_bonus", None, "Attribute Bonus"),
        "5": ("hero_spell", "Big Spell", "Big Spell"),
        "6": ("", None, "6"),
        "7": ("un_named", None, "un_named"),
    }
    docs = [
        ("ability_ids", {k: v[0] for k, v in cases.items()}),
        ("abilities", {v[0].replace("_", "__"): {"dname": v[1], "img": "/i"} for v in cases.values() if v[0]}),
    ]
    constants = spark.createDataFrame([(n, json.dumps(d)) for n, d in docs], "resource string, payload string")
    upgrades = spark.createDataFrame(
        [("m", "0", "a", "h", "Radiant", i, k) for i, k in enumerate([*cases, "99"])],
        "match_id string, player_slot string, account_id string, hero_id string, side string,"
        " upgrade_index long, ability_id string",
    )
    samples = spark.createDataFrame(
        [("m", "0", 1, 0), ("m", "0", 2, 4), ("m", "0", 2, 3), ("m", "0", 4, 9)],
        "match_id string, player_slot string, level int, minute int",
    )
    people = spark.createDataFrame([("a", "Ann")], "account_id string, player_name string")
    heroes = spark.createDataFrame([("h", "Hero")], "hero_id string, hero_localized_name string")
    rows = facts.fact_match_player_skills(upgrades, samples, constants, people, heroes)
    got = {r.ability_id: r for r in rows.collect()}
    assert {k: got[k].ability_name for k in cases} == {k: v[2] for k, v in cases.items()}
    assert got["99"].ability_name == "99" and got["99"].is_talent is False
    assert got["4"].is_talent and not got["5"].is_talent
    # first minute of levels 1, 2 and 4; missing levels take the last level's minute
    assert [got[k].minute for k in cases] == [0, 3, 9, 9, 9, 9, 9]


def test_matchups_keep_every_pair_and_mirror_heroes(spark):
    players = spark.createDataFrame(
        [("m", "0", "1"), ("m", "0", "1"), ("m", "1", "1"), ("m", "1", "2"), ("m", "1", "0"), ("d", "0", "1"), ("d", "1", "2")],
        "match_id string, team_number string, hero_id string",
    )
    matches = spark.createDataFrame([("m", True), ("d", None)], "match_id string, radiant_win boolean")
    heroes = spark.createDataFrame([("1", "A"), ("2", "B")], "hero_id string, hero_localized_name string")
    pairs = facts.fact_hero_matchups(players, matches, heroes)
    assert sorted((r.radiant_hero_id, r.dire_hero_id, r.matchup_label) for r in pairs.collect()) == [
        ("1", "1", "A vs A"), ("1", "1", "A vs A"), ("1", "2", "A vs B"), ("1", "2", "A vs B"),
    ]
    both = facts.fact_hero_matchups_hero(pairs, heroes).collect()
    assert sorted((r.hero_name, r.opponent_name, r.hero_win) for r in both) == [
        ("A", "B", True), ("A", "B", True), ("B", "A", False), ("B", "A", False),
    ]
    stats = facts.fact_hero_matchup_stats(players, matches, heroes).collect()
    assert sorted((r.matchup_label, r.matchup_games, r.radiant_wins, r.dire_wins) for r in stats) == [
        ("A vs A", 2, 2, 0), ("A vs B", 2, 2, 0),
    ]


def test_draft_grid_follows_longest_draft(spark):
    rows = [("m", i, "Dire", False, str(i)) for i in range(7)] + [("m", 7, "Radiant", True, "1"), ("n", 0, None, True, "2")]
    drafts = spark.createDataFrame(
        [(m, str(o), o, t, p, h) for m, o, t, p, h in rows],
        "match_id string, order_no string, order_no_int int, active_team string, is_pick boolean, hero_id string",
    )
    heroes = spark.createDataFrame([(str(i), f"H{i}", f"i{i}") for i in range(7)], "hero_id string, hero_localized_name string, img string")
    grid = facts.fact_draft_sequence(drafts, heroes)
    got = {(r.match_id, r.slot): r for r in grid.collect()}
    assert len(got) == 14
    assert [got["m", s].dire_ban_hero for s in range(1, 8)] == [f"H{i}" for i in range(7)]
    assert got["m", 1].radiant_pick_seq == 1 and got["n", 1].dire_pick_hero is None
    assert checks.slot_coverage(grid, drafts).count() == 0
    assert checks.slot_coverage(grid.where("slot < 6"), drafts).count() == 1


def test_fall_through_labels(spark):
    df = spark.sql("select stack(5, -1, 0, 1200, 2400, cast(null as int)) as s")
    got = [r[0] for r in df.select(facts.fight_phase(df.s)).collect()]
    assert got == ["pre-game", "early (0-20m)", "mid (20-40m)", "late (40m+)", "late (40m+)"]
    units = "npc_dota_badguys_tower1 xtrax good_rax ancient npc_dota_creep_x npc_dota_neutral_y obs_ward boo"
    df = spark.createDataFrame([(u,) for u in units.split()], "u string")
    none = df.u.isNull()
    got = [r[0] for r in df.select(facts.unit_category(df.u, none)).collect()]
    assert got == ["Building", "Building", "Building", "Building", "Creep", "Neutral", "Ward", "Other"]


def test_unknown_team_and_name_fallbacks(spark):
    teams = spark.createDataFrame(
        [("1", "abc", None), ("2", "", "tg"), ("3", None, ""), ("3", None, "")],
        "team_id string, team_name string, team_tag string",
    ).selectExpr("*", "cast(1 as decimal(18,8)) as rating", "1 as wins", "2 as losses", "'l' as logo_url")
    matches = spark.createDataFrame(
        [("9", "1"), ("9", None), (None, "8")], "radiant_team_id string, dire_team_id string"
    )
    got = {r.team_id: r.team_name for r in dimensions.team_identity(teams, matches).collect()}
    assert got == {"1": "ABC", "2": "TG", "3": "TEAM 3", "8": "UNKNOWN", "9": "UNKNOWN"}
    assert dimensions.team_identity(teams, matches).count() == 5


def test_level_from_experience(spark):
    df = spark.sql("select array(0bd, 240bd, 640bd) as steps, stack(4, 0, 300, 700, cast(null as int)) as xp")
    got = [r[0] for r in df.select(facts.level_for_xp(df.steps, df.xp)).collect()]
    assert got == [1, 2, 3, 0]


def test_calendar(spark):
    days = {str(r.date): r for r in dimensions.dim_date(spark).where("date in ('2000-01-01', '2024-02-29', '2100-01-01')").collect()}
    assert set(days) == {"2000-01-01", "2024-02-29"}
    d = days["2000-01-01"]
    assert (d.day_of_week, d.iso_day_of_week, d.week_of_year, str(d.week_start_date)) == (6, 6, 52, "1999-12-27")
    assert d.day_of_week_name == "Saturday" and d.is_leap_year
    assert dimensions.dim_date(spark).count() == 18628
