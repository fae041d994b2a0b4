"""The whole build, its checks, and incremental runs."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from arenamart.functions import metrics
from arenamart.operators import checks, staging
from arenamart.plans import pipeline
from arenamart.plans.driver_tables import DriverTables
from arenamart.session import fresh_path
from arenamart.sources.sinks import table_sink
from arenamart.streaming import micro_batch


@pytest.fixture(scope="module")
def built(spark):
    root = fresh_path(spark, "build")
    bronze = {n: table_sink(df, f"{root}/raw_{n}") for n, df in DriverTables(spark, SF).bronze().items()}
    tables = pipeline.run_layers(spark, None, root, bronze, load=False, snapshot=f"{root}/copies", catalog="built_marts")
    return tables


def test_all_models_are_built(built):
    names = [n for n in built if n.startswith(("stg_", "dim_", "fact_"))]
    assert sum(n.startswith("stg_") for n in names) == 18
    assert sum(n.startswith("dim_") for n in names) == 12
    assert sum(n.startswith("fact_") for n in names) == 21


def test_gold_tables_are_listed_with_statistics(spark, built):
    names = {n for n in built if n.startswith(("dim_", "fact_"))}
    assert names <= {t.name for t in spark.catalog.listTables("built_marts")}
    stats = spark.sql("describe extended built_marts.fact_match_players").where("col_name = 'Statistics'").first()
    assert f"{built['fact_match_players'].count()} rows" in stats.data_type


def test_declared_checks(built):
    kinds = [c.kind for c in checks.DECLARED_CHECKS]
    assert {k: kinds.count(k) for k in kinds} == {
        "not_null": 177, "unique": 21, "relationships": 46, "accepted_values": 12, "seq_in_range": 4,
        "unique_combination": 1, "slot_coverage": 1,
    }
    summary = {r.check: r.failing for r in built["check_summary"].collect()}
    assert len(summary) == len(checks.DECLARED_CHECKS)
    assert summary["unique:fact_matches.match_id"] == 0
    assert summary["relationships:fact_match_players.match_id"] == 0
    # heroes 128-130, leagues 25 and 26 and some items are left out of the dimensions on purpose
    assert summary["relationships:fact_match_players.hero_id"] > 0
    assert summary["relationships:fact_matches.leagueid"] > 0
    # undecided teams have no composition
    assert summary["not_null:fact_match_players.comp_sig"] > 0


def test_slices_agree_with_joins(built):
    agile = built["dim_hero"].where("primary_attr = 'Agility'")
    out = metrics.slice_star(built, {"dim_hero": agile})
    ids = {r.match_id for r in built["fact_match_players"].join(agile.select("hero_id"), "hero_id").collect()}
    assert {r.match_id for r in out["fact_matches"].select("match_id").collect()} == ids
    assert {r.match_id for r in out["fact_team_matches"].select("match_id").distinct().collect()} <= ids
    role = built["dim_hero_role"].select("role").first().role
    sliced = metrics.slice_star(built, {"dim_hero_role": built["dim_hero_role"].where(F.col("role") == role)})
    heroes = {r.hero_id for r in built["dim_hero_role"].where(F.col("role") == role).collect()}
    assert {r.hero_id for r in sliced["fact_match_players"].select("hero_id").distinct().collect()} <= heroes


def test_two_increments_equal_one_build(spark, built):
    root = fresh_path(spark, "silver")
    nested, constants = built["nested_matches"], built["constants"]
    pipeline.extend_silver(nested.where("match_id % 2 = 0"), constants, root)
    pipeline.extend_silver(nested, constants, root)
    again = pipeline.extend_silver(nested, constants, root)
    assert len(again) == 12
    for name, df in again.items():
        full = built[name].select(*df.columns)
        assert df.exceptAll(full).count() == 0 and full.exceptAll(df).count() == 0, name


def test_an_extending_run_parses_only_new_matches(spark, built):
    root, silver = fresh_path(spark, "build"), fresh_path(spark, "silver")
    bronze = {n: built[n] for n in ("matches", "leagues", "players", "teams", "hero_stats", "constants")}
    part = bronze | {"matches": bronze["matches"].where("match_id % 2 = 0")}
    pipeline.run_layers(spark, None, f"{root}/a", part, load=False, check=False, extend=silver)
    tables = pipeline.run_layers(spark, None, f"{root}/b", bronze, load=False, check=False, extend=silver)
    assert tables["nested_matches"].where("match_id % 2 = 0").count() == 0
    assert tables["freshness"].count() == 1
    for name in ("stg_match_player_kills", "fact_match_players", "fact_draft_sequence"):
        got, want = tables[name], built[name].select(*tables[name].columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, name


def test_a_match_that_comes_again_is_skipped_whole(spark, built):
    bronze, target, progress = (fresh_path(spark, n) for n in ("bronze", "target", "progress"))
    for kills in (["a", "b", "c"], ["x"]):
        log = ", ".join(f'{{"key": "npc_dota_hero_{k}", "time": "{i}"}}' for i, k in enumerate(kills))
        doc = f'{{"match_id": 1, "players": [{{"player_slot": 0, "hero_id": 1, "kills_log": [{log}]}}]}}'
        row = spark.createDataFrame([(1, doc)], "match_id bigint, payload string").withColumn("loaded_at", F.current_timestamp())
        row.write.mode("append").parquet(bronze)
        micro_batch.stream_silver(spark, bronze, target, progress, "stg_match_player_kills").awaitTermination()
    assert sorted(r.victim_hero_name[-1] for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]
    typed = fresh_path(spark, "typed")
    docs = fresh_path(spark, "bronze")
    built["matches"].write.parquet(docs)
    name = "stg_match_player_damage_taken_type"
    micro_batch.stream_silver(spark, docs, typed, fresh_path(spark, "progress"), name, built["constants"]).awaitTermination()
    assert spark.read.parquet(typed).count() == built[name].count()


def test_streams_are_idempotent(spark, built):
    bronze, target = fresh_path(spark, "bronze"), fresh_path(spark, "target")
    docs = built["matches"]
    docs.where("match_id % 3 = 0").write.parquet(f"{bronze}/a")
    progress = fresh_path(spark, "progress")
    model = "stg_match_player_kills"
    micro_batch.stream_silver(spark, bronze, target, progress, model).awaitTermination()
    # the second batch repeats a third of the documents
    docs.write.parquet(f"{bronze}/b")
    micro_batch.stream_silver(spark, bronze, target, progress, model).awaitTermination()
    got, want = spark.read.parquet(target).drop("batch"), built[model]
    assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0


def test_json_path_equals_nested_path(spark):
    driver = DriverTables(spark, SF)
    sections = ("players", "picks_bans", "teamfights", "logs", "minutes", "wards")
    text = staging.parse_matches(driver.documents(*sections))
    direct = driver.nested(*sections)
    for name in ("stg_match_players", "stg_picks_bans", "stg_teamfights", "stg_match_player_minute"):
        a, b = (staging.MATCH_MODELS[name](n) for n in (text, direct))
        assert a.dtypes == b.dtypes
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_freshness_levels(spark):
    df = spark.sql("select timestamp'2024-01-01' as loaded_at")
    for now, want in (("2024-01-05", "pass"), ("2024-01-09", "warn"), ("2024-02-09", "error")):
        assert checks.freshness(df, F.lit(now).cast("timestamp")).first().status == want
    assert checks.freshness(df.where("false"), F.current_timestamp()).first().status == "error"
