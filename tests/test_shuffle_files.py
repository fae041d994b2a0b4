"""Shuffle files do not outlive their query."""

import __spark_entry__ as entry

from arenamart import session

SF = "/root/testdata/sf0.001"


def shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return str(files.mkString(" ")).count(".data")


def test_shuffle_files_go_when_a_query_ends(spark):
    df = entry.queries()["agg_group"](spark, SF)
    before = shuffle_files(spark)
    rows = sorted(map(str, df.repartition(3).collect()))
    assert rows and shuffle_files(spark) <= before
    again = df.repartition(3)
    assert sorted(map(str, again.collect())) == sorted(map(str, again.collect())) == rows
    session.apply_settings(spark)
    assert spark.conf.get(session.CLEANUP) == "false"
