"""Tables that change in one step, and streams that break off."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from arenamart import schemas
from arenamart.operators import staging
from arenamart.plans.driver_tables import DriverTables
from arenamart.session import fresh_path
from arenamart.sources import sinks
from arenamart.sources.versions import BUCKET, VersionedTable, bucket_of
from arenamart.streaming import micro_batch

from conftest import SF


def rows(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, *values):
    return spark.createDataFrame(list(values), "k bigint, v string")


def failing(df):
    return df.withColumn("v", F.when(F.col("k") >= 0, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))


def test_a_broken_refresh_leaves_the_old_table(spark):
    path = fresh_path(spark, "kept")
    sinks.incremental_sink(frame(spark, (1, "a"), (2, "b")), path, ["k"])
    with pytest.raises(Exception, match="broken"):
        sinks.incremental_sink(failing(frame(spark, (3, "c"))), path, ["k"], full_refresh=True)
    table = VersionedTable(spark, path, ["k"])
    assert rows(table.read()) == [(1, "a"), (2, "b")]
    assert rows(sinks.incremental_sink(frame(spark, (3, "c")), path, ["k"], full_refresh=True)) == [(3, "c")]


def test_a_broken_append_is_not_seen(spark, monkeypatch):
    path = fresh_path(spark, "kept")
    sinks.incremental_sink(frame(spark, (1, "a")), path, ["k"])
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            sinks.incremental_sink(frame(spark, (2, "b")), path, ["k"])
    assert rows(VersionedTable(spark, path, ["k"]).read()) == [(1, "a")]
    assert rows(sinks.incremental_sink(frame(spark, (1, "x"), (2, "b"), (None, "n")), path, ["k"])) == [(1, "a"), (2, "b")]


def test_only_touched_buckets_are_read(spark):
    path = fresh_path(spark, "kept")
    many = spark.range(2000).selectExpr("id as k", "cast(id as string) as v")
    sinks.incremental_sink(many, path, ["k"])
    table = VersionedTable(spark, path, ["k"])
    few = frame(spark, (5, "x"), (99_999, "y"))
    touched = table.buckets_of(few)
    assert touched == sorted({r[0] for r in few.select(bucket_of(["k"])).collect()})
    files = table.read(touched).inputFiles()
    assert files and {int(f.split(f"{BUCKET}=")[1].split("/")[0]) for f in files} <= set(touched)
    assert table.read().count() == 2000


def test_one_changed_key_rewrites_one_bucket(spark):
    path = fresh_path(spark, "kept")
    table = VersionedTable(spark, path, ["k"])
    many = spark.range(500).selectExpr("id as k", "cast(id as string) as v")
    assert sinks.upsert_sink(many, path, "k").count() == 500
    before = set(table.read().inputFiles())
    got = sinks.upsert_sink(frame(spark, (7, "new")), path, "k")
    assert got.count() == 500 and got.where("k = 7").first().v == "new"
    gone, came = before - set(got.inputFiles()), set(got.inputFiles()) - before
    assert {f.split(f"{BUCKET}=")[1].split("/")[0] for f in gone | came} == {str(table.buckets_of(frame(spark, (7, "")))[0])}
    again = sinks.upsert_sink(frame(spark, (None, "null"), (1000, "more")), path, "k")
    assert again.count() == 502
    assert sinks.upsert_sink(frame(spark, (None, "other")).where("k is null"), path, "k").count() == 502
    assert sinks.upsert_sink(many.limit(0), path, "k").count() == 502


def test_an_empty_table_has_a_schema(spark):
    path = fresh_path(spark, "kept")
    assert VersionedTable(spark, path, ["k"]).read() is None
    empty = sinks.incremental_sink(frame(spark, (1, "a")).limit(0), path, ["k"])
    assert empty.columns == ["k", "v"] and empty.count() == 0
    assert rows(sinks.incremental_sink(frame(spark, (1, "a")), path, ["k"])) == [(1, "a")]


def test_a_batch_that_broke_off_is_in_no_table(spark, monkeypatch):
    driver = DriverTables(spark, SF)
    bronze, target, progress = (fresh_path(spark, n) for n in ("bronze", "target", "progress"))
    columns = [f.name for f in schemas.bronze_schema("matches").fields]
    docs = sinks.table_sink(driver.documents("players", "logs").select(*columns).where("match_id % 5 < 2"), fresh_path(spark, "docs"))
    constants = driver.constants("abilities", "items")
    run = lambda: micro_batch.stream_silver_tables(spark, bronze, target, progress, constants).awaitTermination()
    docs.where("match_id % 5 = 0").write.parquet(f"{bronze}/a")
    run()
    first = {n: df.count() for n, df in micro_batch.silver_tables(spark, target).items()}
    docs.write.parquet(f"{bronze}/b")
    with monkeypatch.context() as m:
        m.setitem(micro_batch.MATCH_MODELS, "stg_match_player_kills", lambda n: n.select(F.raise_error(F.lit("killed")).alias("x")))
        with pytest.raises(StreamingQueryException):
            run()
    assert {n: df.count() for n, df in micro_batch.silver_tables(spark, target).items()} == first
    run()
    nested = staging.parse_matches(docs)
    for name in ("stg_matches", "stg_match_players", "stg_match_player_kills", "stg_match_player_item_purchases"):
        got, want = micro_batch.silver_tables(spark, target)[name], staging.MATCH_MODELS[name](nested)
        assert got.count() == want.count() and got.exceptAll(want.select(*got.columns)).count() == 0, name


def test_stateful_bronze(spark, tmp_path):
    folder, target, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    folder.mkdir()
    load = lambda at: micro_batch.stream_bronze(spark, str(folder), target, at, "teams").awaitTermination()
    (folder / "1.json").write_text('{"team_id": 1, "name": "a"}')
    (folder / "x.json").write_text('{"team_id": 1,')
    load(progress)
    (folder / "2.json").write_text('{"team_id": 1, "name": "changed"}')
    (folder / "3.json").write_text('{"name": "by file"}')
    load(progress)
    load(progress)
    want = [(1, '{"team_id": 1, "name": "a"}'), (3, '{"name": "by file"}')]
    got = lambda: rows(spark.read.parquet(target).select("team_id", "payload"))
    assert got() == want
    for _ in range(2):  # a new checkpoint over the old table
        load(f"{progress}2")
        assert got() == want
    assert spark.conf.get(micro_batch.PROVIDER) != micro_batch.ROCKSDB
