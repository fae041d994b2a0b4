"""Mixing sources to target weights by systematic sampling.

Within a source the documents are ordered by size, then by a digest of the id, then by id. Each has
the expected number of copies target / source size. The running sum of that, plus one random offset
per source, gives a document one copy for every integer boundary that it crosses. Ordering by size
makes the words taken follow the target closely: the error is about one of the largest documents.

Targets: the sources by code point (null last) have the weights 5, 2, 1, repeating, and share all
words; a target stops at ``CAP`` times the words of its source, and the excess is shared by weight
among the others until none is above.

No window is over a whole source: documents are numbered inside (source, size, digest part), and the
numbers before each such cell come from pre-aggregated counts.

Defined results: a null text has size 0; a null source is a source of its own; a source without words
has target 0 and takes nothing; equal rows are interchangeable; an empty table gives no rows; the
offset depends on the seed and the source only, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arenamart.llm.common import count_words, read, stored

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix"


def _digest_part(doc_id: Column) -> Column:
    """One of 4096 cells, so that equal sizes of a large source are numbered in parallel."""
    return F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 3)


def _offset(source: Column, seed: str) -> Column:
    """A multiple of 2^-16 in [0, 1): sums with whole numbers of copies stay exact."""
    hexes = F.substring(F.sha2(F.concat(F.lit(seed + "|"), F.coalesce(source, F.lit("|"))), 256), 1, 4)
    return F.conv(hexes, 16, 10).cast("double") / 65536


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """From (source, source_size): adds target. One row per source, so its windows are small."""
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(order, F.lit(len(weights))))
    whole = F.sum(F.col("source_size").cast("decimal(38,0)")).over(Window.partitionBy())
    step = totals.withColumns({"_w": weight.cast("decimal(38,0)"), "_all": whole})
    # Filled in the order in which sources meet their cap as the common share per weight rises.
    filling = Window.orderBy(F.col("source_size") / F.col("_w"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    step = step.withColumns(
        {
            "_rest": F.col("_all") - cap * F.coalesce(F.sum(F.col("source_size").cast("decimal(30,0)")).over(before), F.lit(0)),
            "_ws": F.sum(F.col("_w").cast("decimal(20,0)")).over(after),
            "_n": F.row_number().over(filling),
        }
    )
    share = F.when(F.col("_rest") * F.col("_w") <= cap * F.col("source_size") * F.col("_ws"), F.struct("_n", "_rest", "_ws"))
    step = step.withColumn("_share", F.min(share).over(Window.partitionBy()))
    filled = (F.col("_share._rest") * F.col("_w")).cast("double") / F.col("_share._ws").cast("double")
    capped = (cap * F.col("source_size")).cast("double")
    return step.select("source", "source_size", F.when(F.col("_n") >= F.col("_share._n"), filled).otherwise(capped).alias("target"))


def with_copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """``docs`` (doc_id, source, _size, and others) with source_size, target and _copies."""
    kept = docs.columns
    cell = ["_source", "_size", "_part"]
    docs = docs.withColumns(
        {"_source": F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name")), "_part": _digest_part(F.col("doc_id"))}
    )
    cells = stored(docs.groupBy("source", *cell).agg(F.count("*").alias("_n")), "mix-cells")
    sizes = cells.groupBy("source", "_source", "_size").agg(F.sum("_n").alias("_n"))
    earlier = Window.partitionBy("_source").orderBy("_size").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_source", "_size", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_smaller"))
    totals = cells.groupBy("source", "_source").agg(F.sum(F.col("_size") * F.col("_n")).alias("source_size"))
    targets = source_targets(totals.select("source", "source_size"), weights, cap)
    key = F.struct(F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))
    targets = targets.select(key.alias("_source"), "source_size", "target", _offset(F.col("source"), seed).alias("_u"))
    before = Window.partitionBy("_source", "_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(*cell, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    starts = starts.join(sizes, ["_source", "_size"]).join(targets, "_source")
    starts = starts.select(*cell, (F.col("_before") + F.col("_smaller")).alias("_start"), "source_size", "target", "_u")
    place = F.row_number().over(Window.partitionBy(*cell).orderBy(F.col("doc_id").asc_nulls_first())) - 1
    numbered = docs.withColumn("_place", place).join(starts, cell)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("_place") + F.col("_start")
    copies = F.floor(F.col("_u") + (at + 1) * rate) - F.floor(F.col("_u") + at * rate)
    return numbered.select(*kept, "source_size", "target", copies.cast("bigint").alias("_copies"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with its own columns."""
    rows = docs.select("doc_id", "source", count_words(F.col("text")).alias("_size"), F.struct("*").alias("_row"))
    taken = with_copies(rows, weights, cap, seed).where(F.col("_copies") > 0)
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")


def op7_mix(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", count_words(F.col("text")).alias("_size"))
    taken = with_copies(stored(docs, "mix-sizes"))
    return taken.select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_copies") * F.col("_size")).alias("taken")
    )


OP7_SQL = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
  CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM d GROUP BY source),
f AS (SELECT *, row_number() OVER o AS n, (SELECT sum(source_size) FROM s)
    - {CAP} * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
  sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws
  FROM s WINDOW o AS (ORDER BY CAST(source_size AS DOUBLE) / w, source NULLS LAST)),
k AS (SELECT n AS first_n, rest AS r0, ws AS w0 FROM f WHERE rest * w <= {CAP} * source_size * ws ORDER BY n LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN n >= first_n THEN CAST(r0 * w AS DOUBLE) / CAST(w0 AS DOUBLE)
    ELSE CAST({CAP} * source_size AS DOUBLE) END AS target,
  CAST(CAST('0x' || substr(sha256('{SEED}|' || coalesce(source, '|')), 1, 4) AS BIGINT) AS DOUBLE) / 65536 AS u FROM f, k),
p AS (SELECT d.doc_id, size, source_size, target, u, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
  row_number() OVER (PARTITION BY d.source ORDER BY size, substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 3), d.doc_id NULLS FIRST) - 1 AS i
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST(size * (floor(u + (i + 1) * rate) - floor(u + i * rate)) AS BIGINT) AS taken FROM p
"""
