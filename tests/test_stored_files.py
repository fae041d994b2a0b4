"""Files, stored tables and digests of large builds: what they cost, and that they stay the same."""

import duckdb
import pytest
from pyspark.errors import AnalysisException

from arenamart.plans.catalogue import digests, loading
from arenamart.sources import documents, sinks


def test_files_of_a_pattern_come_from_one_listing(spark, tmp_path):
    for name in ("a.json", "b.json", "c.txt"):
        (tmp_path / name).write_text(name)
    rows = documents.read_files(spark, f"{tmp_path}/*.json")
    assert sorted((r.name, r.value) for r in rows.collect()) == [("a", "a.json"), ("b", "b.json")]
    assert f"[file:{tmp_path}]" in rows._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(AnalysisException):
        documents.read_files(spark, f"{tmp_path}/*.csv")


def test_document_files_carry_their_names(spark):
    rows = [(7, "x"), (8, None), (9, "same"), (9, "same"), (None, "none")]
    path = loading.written_files(spark, spark.createDataFrame(rows, "name long, value string"))
    got = {r.name: r.value for r in documents.read_files(spark, path, loading.FILE_NAME).collect()}
    assert got == {"7": "x\n", "8": "\n", "9": "same\nsame\n", loading.NO_NAME: "none\n"}


def test_stored_tables_are_compressed(spark, tmp_path):
    sinks.table_sink(spark.range(3), f"{tmp_path}/t")
    sinks.batch_sink(spark.range(3), f"{tmp_path}/b", 1)
    sinks.incremental_sink(spark.range(3), f"{tmp_path}/i", ["id"])
    assert [any(tmp_path.glob(f"{d}/**/*.zstd.parquet")) for d in "tbi"] == [True] * 3


def test_digests_read_no_number_back_from_text(spark):
    rows = [(1, 2.5, True, "1.50"), (10**16, 0.0, None, "x"), (-3, -0.0, False, None)]
    got = digests.table_digests({"t": spark.createDataFrame(rows, "a long, b double, c boolean, d string")})
    assert got._jdf.queryExecution().analyzed().toString().count("RLIKE") == 1
    con = duckdb.connect()
    values = "(1::bigint, 2.5::double, true, '1.50'), (10000000000000000, 0, null, 'x'), (-3, 0, false, null)"
    con.execute(f"create table t as select * from (values {values}) v(a, b, c, d)")
    sql = digests.digests_sql({"t": "SELECT * FROM t"}).replace(digests.PRELUDE.rstrip().rstrip(",") + ",", "WITH", 1)
    assert [tuple(r) for r in got.collect()] == con.execute(sql).fetchall()
