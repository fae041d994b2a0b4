"""Helpers for the query catalogue: one value form for both engines, and exact SQL rounding."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenamart.session import apply_match_settings

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    """A query and the SQL that must give the same rows; without SQL only rows are checked."""

    run: Query
    sql: str | None = None


def publish(df: DataFrame) -> DataFrame:
    """Integers as bigint, decimals as double, dates and times as text, so engines compare equal."""

    def shape(f: T.StructField):
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.IntegralType):
            return col.cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return col.cast("double").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return F.date_format(col, "yyyy-MM-dd").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(f.name)
        return col

    return df.select(*[shape(f) for f in df.schema.fields])


def published(run: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return publish(run(apply_match_settings(spark), sf_dir))

    return query


def rounded(num: str, den: str, digits: int) -> str:
    """SQL for num/den rounded half away from zero, in integers, null when den is 0 or null."""
    p = 10**digits
    value = f"sign({num}) * ((2 * abs({num}) * {p} + ({den})) // (2 * ({den})))"
    return f"CASE WHEN ({den}) > 0 THEN CAST({value} AS DOUBLE) / CAST({p} AS DOUBLE) END"
