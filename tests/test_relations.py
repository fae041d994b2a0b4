import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from arenamart.functions import columns as C
from arenamart.functions import relations as R


@pytest.mark.parametrize(
    "listed, want",
    [([1], [2]), ([1, None], []), ([], [1, 2, None]), ([None], []), ([9], [1, 2])],
)
def test_not_in_matches_sql(spark, listed, want):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(v,) for v in listed], "v int")
    left.createOrReplaceTempView("l")
    other.createOrReplaceTempView("o")
    sql = [r.k for r in spark.sql("select k from l where k not in (select v from o)").collect()]
    got = [r.k for r in R.null_aware_not_in(left, "k", other, "v").collect()]
    assert sorted(got, key=str) == sorted(want, key=str) == sorted(sql, key=str)


def test_rank_rows_is_row_number(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7).alias("g"),
        F.expr("nullif(id * 37 % 11, 4)").alias("a"),
        F.expr("nullif(id * 53 % 13, 5)").alias("b"),
        "id",
    )
    order = [F.col("a").desc_nulls_first(), F.col("b").asc_nulls_last(), F.col("id").asc()]
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    got = R.rank_rows(df, ["g"], [("a", True), ("b", False)], [F.col("id").asc()], "n")
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_latest_per_key_puts_missing_times_last(spark):
    df = spark.createDataFrame(
        [("a", None, "z", "old"), ("a", 1, "b", "new"), ("a", 1, "a", "tie"), ("b", None, "q", None)],
        "k string, at int, tie string, name string",
    )
    got = {r.k: r.name for r in R.latest_per_key(df, ["k"], ["at", "tie"], ["name"]).collect()}
    assert got == {"a": "new", "b": None}


def test_exact_numbers(spark):
    df = spark.createDataFrame([(1, 8), (1, 16), (3, 0), (None, 3)], "a int, b int")
    got = [
        [None if v is None else float(v) for v in r]
        for r in df.select(C.rate(F.col("a"), F.col("b"), 2), C.minutes(F.col("b") - 9)).collect()
    ]
    assert got == [[0.13, -0.02], [0.06, 0.12], [None, -0.15], [None, -0.1]]
    mean = df.agg(C.exact_avg(F.col("b"), 1), C.exact_avg(F.col("a"), 1)).first()
    assert [float(v) for v in mean] == [6.8, 1.7]


def test_json_kind(spark):
    texts = ['{"a":1}', " [1]", '"s"', "true", "false", "null", "-1.5", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(C.json_kind(F.col("t"))).collect()]
    assert got == ["object", "array", "string", "boolean", "boolean", "null", "number", None]
