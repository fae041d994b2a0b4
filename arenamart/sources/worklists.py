"""Key logic of data collection: what is new, what is missing, and in which order to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenamart import fixed_values as fv
from arenamart.functions.columns import json_kind


def append_new_keys(
    stored: DataFrame, incoming: DataFrame, key: str, stamp: Column, order: list[str]
) -> DataFrame:
    """Incoming records with a key not stored yet, the first by ``order`` per key, stamped.

    Records without a key are left out. Keys compare as text. Picking the first per key is an
    aggregate, so a key repeated very often is reduced before the shuffle.
    """
    values = [c for c in incoming.columns if c != key]
    text_key = F.col(key).cast("string")
    known = stored.select(F.col(key).cast("string").alias("__known"))
    unseen = (
        incoming.where(F.col(key).isNotNull())
        .withColumn("__text", text_key)
        .join(known, F.col("__text") == F.col("__known"), "left_anti")
    )
    first = F.min_by(F.struct(key, *values), F.struct(*order)).alias("__first")
    return (
        unseen.groupBy("__text")
        .agg(first)
        .select("__first.*")
        .withColumn(fv.FETCH_STAMP, stamp)
        .select(*incoming.columns, fv.FETCH_STAMP)
    )


def append_new_members(stored: DataFrame, incoming: DataFrame, stamp: Column) -> DataFrame:
    """Members (name, value as JSON text) of an object resource whose name is not stored yet.

    Object values get the fetch stamp as a field, other values stay as they are.
    """
    known = stored.select(F.col("name").alias("__known"))
    unseen = incoming.join(known, F.col("name") == F.col("__known"), "left_anti")
    fields = F.from_json("value", T.MapType(T.StringType(), T.VariantType()))
    others = F.map_filter(fields, lambda k, _: k != fv.FETCH_STAMP)
    quoted = F.parse_json(F.concat(F.lit('"'), stamp, F.lit('"')))
    stamped = F.to_json(F.map_concat(others, F.create_map(F.lit(fv.FETCH_STAMP), quoted)))
    is_object = json_kind(F.col("value")) == "object"
    return unseen.withColumn("value", F.when(is_object, stamped).otherwise(F.col("value")))


def append_by_first_useful_key(
    stored: DataFrame,
    incoming: DataFrame,
    stamp: Column,
    order: list[str],
    candidates: list[str] = fv.CANDIDATE_KEYS,
) -> DataFrame:
    """``append_new_keys`` under the first candidate key that adds any record.

    The choice is part of the plan: every row counts under the candidates that find it new, and
    only rows of the first candidate with a positive count remain. ``candidates`` is a short list.
    """
    usable = [k for k in candidates if k in incoming.columns and k in stored.columns]
    added = None
    for rank, key in enumerate(usable):
        rows = append_new_keys(stored, incoming, key, stamp, order).withColumn(
            "__rank", F.lit(rank)
        )
        added = rows if added is None else added.unionByName(rows)
    first = added.agg(F.min("__rank")).scalar()
    return added.where(F.col("__rank") == first).drop("__rank")


def missing_worklist(discovered: DataFrame, present: DataFrame, skipped: DataFrame, key: str):
    """Discovered ids that are neither present nor permanently skipped."""
    done = present.select(F.col(key).alias("__done")).union(skipped.select(key))
    return discovered.join(done, F.col(key) == F.col("__done"), "left_anti")


def worklist_counts(
    discovered: DataFrame, present: DataFrame, skipped: DataFrame, key: str, by: str
) -> DataFrame:
    """Per group: ids left to fetch and ids that need no fetch."""
    done = present.select(F.col(key).alias("__done")).union(skipped.select(key)).distinct()
    marked = discovered.join(done, F.col(key) == F.col("__done"), "left")
    return marked.groupBy(by).agg(
        F.count_if(F.col("__done").isNull()).alias("to_fetch"),
        F.count_if(F.col("__done").isNotNull()).alias("already_present"),
    )


def priority_worklist(
    leagues: DataFrame,
    pinned: list[str] = fv.PINNED_LEAGUE_IDS,
    name_pattern: str = fv.YEARLY_FINAL_NAME,
    tiers: list[str] = fv.WORKLIST_TIERS,
) -> DataFrame:
    """Leagues in fetch order: yearly finals by year, pinned ids, then the listed tiers.

    ``leagues`` has leagueid, name, tier and ``at``, the position in the source list. A league that
    is listed again keeps its first position and takes its last name and tier. Other leagues
    are dropped. ``place`` is a sort key, not a dense number: ordering rows takes one distributed
    sort, numbering them would take a single task.
    """
    leagues = leagues.groupBy("leagueid").agg(
        F.max_by("name", "at").alias("name"), F.max_by("tier", "at").alias("tier"), F.min("at").alias("at")
    )
    year = F.regexp_extract("name", name_pattern, 1)
    is_final = year != ""

    def position(values: list[str], col: Column) -> Column:
        found = F.array_position(F.array(*[F.lit(v) for v in values]), col)
        return F.nullif(found, F.lit(0))

    pin = position(pinned, F.col("leagueid").cast("string"))
    tier = position(tiers, F.coalesce("tier", F.lit("")))
    group = F.when(is_final, 0).when(pin.isNotNull(), 1).when(tier.isNotNull(), 1 + tier)
    within = F.when(is_final, year.try_cast("bigint")).when(pin.isNotNull(), pin).otherwise(F.lit(0))
    listed = leagues.select(
        "leagueid", "name", "tier", F.struct(group.alias("group"), within.alias("within"), "at").alias("place")
    )
    return listed.where("place.group is not null").orderBy("place")
