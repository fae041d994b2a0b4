import json

import pytest
from pyspark.sql import functions as F

from arenamart.session import fresh_path
from arenamart.sources import documents, sinks, worklists

STAMP = "2026-01-01T00:00:00Z"


def write(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(value), encoding="utf-8")


@pytest.fixture
def folder(tmp_path):
    for mid in (1, 2):
        write(tmp_path / f"proMatches/{mid}.json", {"match_id": mid, "timestamp_fetched": STAMP, "players": []})
    write(tmp_path / "proMatches/3.json", {"players": []})
    leagues = [{"leagueid": 1, "timestamp_fetched": "x"}, {"leagueid": 2}, 5, {"name": "no key"}, {"leagueid": 2, "name": "later"}]
    write(tmp_path / "leagues/leagues.json", leagues)
    write(tmp_path / "proPlayers/proPlayers.json", {"account_id": 7, "name": "Ann"})
    write(tmp_path / "teams/teams.json", [])
    write(tmp_path / "heroStats/heroStats.json", [{"id": 1}])
    write(tmp_path / "constants/region.json", {"1": "EU"})
    write(tmp_path / "constants/xp_level.json", [0, 240])
    return str(tmp_path)


def payloads(df, key):
    return {r[key]: json.loads(r.payload) for r in df.collect()}


def test_load_folder(spark, folder):
    tables = documents.load_folder(spark, folder)
    assert payloads(tables["matches"], "match_id") == {
        1: {"match_id": 1, "players": []}, 2: {"match_id": 2, "players": []}, 3: {"players": []},
    }
    assert payloads(tables["leagues"], "leagueid") == {1: {"leagueid": 1}, 2: {"leagueid": 2, "name": "later"}}
    assert payloads(tables["players"], "account_id") == {7: {"account_id": 7, "name": "Ann"}}
    assert tables["teams"].count() == 0
    assert payloads(tables["constants"], "resource") == {"region": {"1": "EU"}, "xp_level": [0, 240]}


def test_second_load_skips_matches_and_replaces_the_rest(spark, folder, tmp_path):
    first = {n: sinks.table_sink(df, str(tmp_path / "stored" / n)) for n, df in documents.load_folder(spark, folder).items()}
    write(tmp_path / "proMatches/2.json", {"match_id": 2, "changed": True})
    write(tmp_path / "proMatches/4.json", {"match_id": 4})
    write(tmp_path / "leagues/leagues.json", [{"leagueid": 2, "name": "newest"}, {"leagueid": 9}])
    second = documents.load_folder(spark, folder, first)
    assert payloads(second["matches"], "match_id") == {4: {"match_id": 4}}
    assert payloads(second["leagues"], "leagueid") == {1: {"leagueid": 1}, 2: {"leagueid": 2, "name": "newest"}, 9: {"leagueid": 9}}


def test_known_files_are_not_opened_and_broken_ones_set_aside(spark, folder, tmp_path):
    (tmp_path / "proMatches/5.json").write_text('{"match_id": 5,')
    tables = documents.load_folder(spark, folder)
    assert [(r.table, r.value) for r in tables["quarantine"].collect()] == [("matches", '{"match_id": 5,')]
    assert sorted(payloads(tables["matches"], "match_id")) == [1, 2, 3]
    known = spark.createDataFrame([(i,) for i in (1, 2, 3)], "match_id bigint")
    again = documents.read_files(spark, f"{folder}/proMatches/*.json", known=known)
    assert [f.rsplit("/", 1)[1] for f in again.inputFiles()] == ["5.json"]


def test_strip_keeps_nested_values(spark):
    doc = '{"a": {"timestamp_fetched": 1, "b": [1, null]}, "timestamp_fetched": "x", "n": null}'
    df = spark.createDataFrame([(doc,), ("[1]",), ('{"a": 1}',), ("broken timestamp_fetched",)], "d string")
    got = [r[0] for r in df.select(documents.strip_payload_field(F.col("d"))).collect()]
    assert json.loads(got[0]) == {"a": {"timestamp_fetched": 1, "b": [1, None]}, "n": None}
    assert got[1:] == ["[1]", '{"a": 1}', "broken timestamp_fetched"]
    assert [r[0] for r in df.select(documents.is_readable(F.col("d"))).collect()] == [True, True, True, False]


def test_append_new_keys(spark):
    stored = spark.createDataFrame([(1, "A")], "leagueid int, name string")
    incoming = spark.createDataFrame([(1, "A", 0), (2, "B", 1), (2, "C", 2), (None, "D", 3)], "leagueid int, name string, at int")
    rows = worklists.append_new_keys(stored, incoming, "leagueid", F.lit(STAMP), ["at"]).collect()
    assert [(r.leagueid, r.name, r.timestamp_fetched) for r in rows] == [(2, "B", STAMP)]


def test_first_useful_key(spark):
    stored = spark.createDataFrame([("a", 1)], "name string, id int")
    incoming = spark.createDataFrame([("a", 1, 0), ("a", 2, 1)], "name string, id int, at int")
    rows = worklists.append_by_first_useful_key(stored, incoming, F.lit(STAMP), ["at"]).collect()
    assert [(r.name, r.id) for r in rows] == [("a", 2)]
    more = incoming.union(spark.createDataFrame([("b", 3, 2)], incoming.schema))
    rows = worklists.append_by_first_useful_key(stored, more, F.lit(STAMP), ["at"]).collect()
    assert [(r.name, r.id) for r in rows] == [("b", 3)]


def test_append_new_members(spark):
    stored = spark.createDataFrame([("a", "1")], "name string, value string")
    incoming = spark.createDataFrame([("a", "2"), ("b", '{"x": [1, 2]}'), ("c", '"text"')], "name string, value string")
    got = {r.name: json.loads(r.value) for r in worklists.append_new_members(stored, incoming, F.lit(STAMP)).collect()}
    assert got == {"b": {"x": [1, 2], "timestamp_fetched": STAMP}, "c": "text"}


def test_missing_worklist(spark):
    ids = lambda *v: spark.createDataFrame([(x, "L") for x in v], "id int, league string")
    found, present, skipped = ids(1, 2, 3, 4), ids(2), ids(3)
    assert sorted(r.id for r in worklists.missing_worklist(found, present.select("id"), skipped.select("id"), "id").collect()) == [1, 4]
    counts = worklists.worklist_counts(found, present.select("id"), skipped.select("id"), "id", "league").first()
    assert (counts.to_fetch, counts.already_present) == (2, 2)


def test_priority_worklist(spark):
    rows = [
        (5, "Pro Cup", "professional"), (1, "The International 2019", "premium"), (2, "The International 2012", "professional"),
        (16899, "The International", "excluded"), (11625, "The International 10", None), (7, "Big", "premium"), (8, "Fun", "amateur"),
    ]
    leagues = spark.createDataFrame([(i, n, t, at) for at, (i, n, t) in enumerate(rows)], "leagueid int, name string, tier string, at int")
    assert [r.leagueid for r in worklists.priority_worklist(leagues).collect()] == [2, 1, 16899, 11625, 7, 5]


def test_csv_seed(spark, tmp_path):
    path = tmp_path / "runes.csv"
    path.write_text("rune_key,rune_name\n0,Double Damage\n1,Haste\n")
    rows = documents.read_csv_seed(spark, str(path), "rune_key int, rune_name string").collect()
    assert [tuple(r) for r in rows] == [(0, "Double Damage"), (1, "Haste")]


def test_save_table_and_view(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    for _ in range(2):
        assert sinks.save_table(df, "kept_rows", ["k"]).count() == 2
    sinks.analyze_tables(spark, ["kept_rows"])
    assert sinks.view_sink(df, "seen_rows").count() == 2
    spark.sql("drop table kept_rows")


def test_catalog_tables_follow_the_last_build_and_carry_statistics(spark):
    database = "catalog_" + fresh_path(spark, "x")[-32:]
    for rows in (10, 40):
        folder = fresh_path(spark, "build")
        sinks.table_sink(spark.range(rows).selectExpr("id", "id % 4 as kind"), f"{folder}/fact")
        sinks.table_sink(spark.range(4).selectExpr("id as kind"), f"{folder}/dim")
        sinks.catalog_tables(spark, folder, ["fact", "dim"], database)
        stats = spark.sql(f"describe extended {database}.fact").where("col_name = 'Statistics'").first()
        assert f"{rows} rows" in stats.data_type
        kinds = spark.sql(f"describe extended {database}.fact kind").where("info_name = 'distinct_count'").first()
        assert kinds.info_value == "4"
    # With the cost model on, the planner knows the rows of a filter on a listed column.
    spark.conf.set("spark.sql.cbo.enabled", "true")
    try:
        plan = spark.table(f"{database}.fact").where("kind = 1")._jdf.queryExecution().stringWithStats()
        assert "rowCount=10" in plan
    finally:
        spark.conf.unset("spark.sql.cbo.enabled")
