"""Sharding by longest-processing-time scheduling; equal texts stay together.

A document's size is the UTF-8 bytes of its text plus one (null: one). Groups of equal texts fall into
classes by the power of two of their total size, and into at most ``BUNDLES`` bundles per class, so that
the schedule has a bounded number of items whatever the corpus. A group above one part in ``ALONE`` of a
shard's share of all bytes is an item of its own; there are fewer of them than shards * ``ALONE``. The items, sorted by size, go to the least-loaded shard through a heap.

The law is ``bytes``: shard sizes are near equal, as far as indivisible groups allow.

Defined results: a null text counts as empty and shares the group of empty texts; equal rows take
neighbouring slots; an empty table has no shards to fill; extra columns are dropped by ``assign`` and
kept by ``write_shards``.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arenamart.llm.common import read, stored

SHARDS = 16
#: Bundles per size class; with at most 63 classes that bounds the heap's input.
BUNDLES = 512
#: Groups above this part of a shard's share are not bundled.
ALONE = 64
#: Parts of a bundle that are numbered on their own, as one group may hold a third of all rows.
PARTS = 256


def schedule(items: list[tuple[int, int, int]], shards: int) -> dict[tuple[int, int], int]:
    """(class, bundle, bytes) by falling size to the least-loaded shard; ties to the lower number."""
    heap = [(0, s) for s in range(shards)]
    placed = {}
    for group_class, bundle, size in sorted(items, key=lambda x: (-x[2], x[0], x[1])):
        load, shard = heapq.heappop(heap)
        placed[group_class, bundle] = shard
        heapq.heappush(heap, (load + size, shard))
    return placed


def _keyed(docs: DataFrame) -> DataFrame:
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        "doc_id",
        F.sha2(data, 256).alias("_group"),
        (F.octet_length(data) + 1).cast("bigint").alias("size"),
        F.crc32(data).alias("text_crc32"),
    )


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document row."""
    spark = docs.sparkSession
    rows = stored(_keyed(docs), "shard-rows")
    groups = rows.groupBy("_group").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    groups = groups.withColumns(
        {"_class": (F.length(F.bin("_bytes")) - 1).cast("int"), "_bundle": F.pmod(F.xxhash64("_group"), F.lit(BUNDLES)).cast("int")}
    )
    groups = stored(groups, "shard-groups")
    total = groups.agg(F.sum("_bytes")).first()[0] or 0
    alone = groups.where(F.col("_bytes") > total // (shards * ALONE)).select("_group").collect()  # below shards * ALONE rows
    alone = [(g, BUNDLES + k) for k, g in enumerate(sorted(r["_group"] for r in alone))]
    alone = F.broadcast(spark.createDataFrame(alone, "_group string, _own int"))
    groups = groups.join(alone, "_group", "left").withColumn("_bundle", F.coalesce("_own", "_bundle")).drop("_own")
    bundles = groups.groupBy("_class", "_bundle").agg(F.sum("_bytes").alias("b"), F.sum("_rows").alias("n"))
    items = bundles.collect()  # below 63 * BUNDLES + shards * ALONE rows
    placed = schedule([(r["_class"], r["_bundle"], r["b"]) for r in items], shards)
    filled, plan = [0] * shards, []
    for r in sorted(items, key=lambda r: (r["_class"], r["_bundle"])):
        shard = placed[r["_class"], r["_bundle"]]
        plan.append((r["_class"], r["_bundle"], shard, filled[shard]))
        filled[shard] += r["n"]
    plan = spark.createDataFrame(plan, "_class int, _bundle int, shard int, _first bigint")
    placed_groups = groups.join(F.broadcast(plan), ["_class", "_bundle"])  # bounded as the items are
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int")
    joined = stored(rows.join(placed_groups.drop("_bytes", "_rows"), "_group").withColumn("_part", part), "shard-placed")
    cell = ["_class", "_bundle", "_part"]
    before = Window.partitionBy("_class", "_bundle").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = joined.groupBy(*cell).agg(F.count("*").alias("_n"))
    starts = starts.select(*cell, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*cell).orderBy("_group", F.col("doc_id").asc_nulls_first())) - 1
    slots = joined.withColumn("_place", place).join(starts, cell)
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("_first") + F.col("_start") + F.col("_place")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Writes ``docs`` with columns shard and slot below ``path``, one folder per shard."""
    slots = assign(docs, shards).select(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc"), "shard", "slot")
    own = F.crc32(F.coalesce(docs["text"], F.lit("")).cast("binary"))
    n = Window.partitionBy("_id", "_crc")
    slots = slots.withColumn("_nth", F.row_number().over(n.orderBy("shard", "slot")))
    named = docs.drop("shard", "slot").withColumns({"_id": F.col("doc_id"), "_crc": own})
    named = named.withColumn("_nth", F.row_number().over(n.orderBy("text")))
    same = named["_id"].eqNullSafe(slots["_id"]) & (named["_crc"] == slots["_crc"]) & (named["_nth"] == slots["_nth"])
    out = named.join(slots, same).drop("_id", "_crc", "_nth")
    out.repartition("shard", F.pmod("slot", F.lit(PARTS))).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)


def op9_shard(spark, sf_dir: str) -> DataFrame:
    return assign(read(spark, sf_dir, "documents"))
