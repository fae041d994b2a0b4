"""Table sinks: rebuilt tables, views, incremental appends, snapshots and statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arenamart.sources.versions import CODEC, VersionedTable, stored

def table_sink(
    df: DataFrame, path: str, sort_by: list[str] = (), partition_by: list[str] = ()
) -> DataFrame:
    """Write a table to a folder of its own and return it as read back.

    Sorting inside each file stands in for an index: row groups with narrow key ranges let a scan
    skip most of a file.
    """
    rows = df.sortWithinPartitions(*sort_by) if sort_by else df
    writer = rows.write.mode("errorifexists").option("compression", CODEC)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def save_table(df: DataFrame, name: str, sort_by: list[str] = ()) -> DataFrame:
    """Replace a catalog table."""
    rows = df.sortWithinPartitions(*sort_by) if sort_by else df
    rows.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def view_sink(df: DataFrame, name: str) -> DataFrame:
    """Register a view that is computed on each read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def unseen_rows(df: DataFrame, target: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the target yet; rows without a key are left out."""
    df = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    if target is None:
        return df
    return df.join(target.select(*keys).distinct(), keys, "left_anti")


def one_per_grain(df: DataFrame, grain: list[str]) -> DataFrame:
    """One row of each grain; of several, the one whose other values hash highest.

    An aggregate that combines before the shuffle; reruns pick the same row.
    """
    rest = [c for c in df.columns if c not in grain]
    if not rest:
        return df.distinct()
    picked = F.max_by(F.struct(*rest), F.xxhash64(*rest)).alias("__row")
    return df.groupBy(*grain).agg(picked).select(*[F.col(c) if c in grain else F.col(f"__row.`{c}`") for c in df.columns])


def incremental_sink(
    df: DataFrame,
    path: str,
    keys: list[str],
    unique_key: list[str] | None = None,
    *,
    full_refresh: bool = False,
) -> DataFrame:
    """Append the rows with unseen keys and return the table.

    Running it twice, or again after a failed run, adds nothing twice. The table is versioned, its rows
    lie in buckets of the key's hash, and known keys are read from the buckets that the new keys fall
    into, key columns only. With ``unique_key`` one row of each grain is kept. ``full_refresh`` replaces
    what is stored, in one step at its end.
    """
    spark = df.sparkSession
    table = VersionedTable(spark, path, keys)
    fresh = df if full_refresh else df.where(" and ".join(f"`{k}` is not null" for k in keys))
    if not full_refresh and table.read() is not None:
        fresh = unseen_rows(fresh, table.read(table.buckets_of(fresh)), keys)
    if unique_key:
        fresh = one_per_grain(fresh, unique_key)
    if full_refresh:
        table.replace(fresh)
    else:
        table.append(fresh)
    return table.read()


def upsert_sink(df: DataFrame, path: str, key: str) -> DataFrame:
    """Store rows by key, replacing those that come again, and return the table."""
    table = VersionedTable(df.sparkSession, path, [key])
    table.upsert(df)
    return table.read()


def batch_sink(df: DataFrame, path: str, batch: int) -> None:
    """Write the rows of one micro-batch to a folder of its own; a replay replaces it."""
    df.write.mode("overwrite").option("compression", CODEC).parquet(f"{path}/batch={batch}")


def before_batch(spark: SparkSession, path: str, batch: int) -> DataFrame | None:
    """What earlier batches wrote below ``path``; a replayed batch does not see itself."""
    found = stored(spark, path)
    return found.where(F.col("batch") < batch).drop("batch") if found is not None else None


def snapshot_sink(
    tables: dict[str, DataFrame], folder: str, prefix: str = "gold", at: datetime | None = None
) -> str:
    """Copy tables to a folder that carries the time of the copy."""
    root = f"{folder.rstrip('/')}/{prefix}_{(at or datetime.now()).strftime('%Y%m%d_%H%M%S')}"
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{root}/{name}")
    return root


def analyze_tables(spark: SparkSession, names: list[str]) -> None:
    """Collect table and column statistics for the optimizer."""
    for name in names:
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def catalog_tables(spark: SparkSession, folder: str, names: list[str], database: str) -> None:
    """Show stored tables under their names in a database, with statistics for the optimizer.

    A name that is already there is pointed at the new folder; the data of the old one is left alone, as
    the catalog only refers to it. Nothing but the statistics is computed.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        spark.catalog.createTable(f"{database}.{name}", f"{folder.rstrip('/')}/{name}", "parquet")
    analyze_tables(spark, [f"`{database}`.`{name}`" for name in names])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
