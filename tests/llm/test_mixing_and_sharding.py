"""Mixing targets and copies, and shard schedules."""

import heapq
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import pytest
from conftest import SF
from edge_rows import edge, nothing  # noqa: F401
from pyspark.sql import functions as F

from arenamart.llm import mixing, sharding


def filled(sizes):
    """Targets by resharing round after round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_ones, out = Fraction(sum(sizes.values())), set(order), {}
    while open_ones:
        w = sum(weight[s] for s in open_ones)
        above = {s for s in open_ones if left * weight[s] / w > 3 * sizes[s]}
        if not above:
            return out | {s: float(left * weight[s] / w) for s in open_ones}
        out |= {s: float(3 * sizes[s]) for s in above}
        left -= sum(3 * sizes[s] for s in above)
        open_ones -= above
    return out


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, "c": 5, None: 7}, {"a": 0, "b": 10}, {"x": 3}, {"a": 10, "B": 20, "é": 30, "": 5, None: 50},
    {f"s{i}": (i * 37) % 101 for i in range(20)}, {"a": 0},
])
def test_targets(spark, sizes):
    totals = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.source_targets(totals).collect()}
    assert got == pytest.approx(filled(sizes))


def test_sql_agrees_and_words_meet_targets(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    found = con.execute(mixing.OP7_SQL)
    got = mixing.op7_mix(spark, SF)
    assert [x[0] for x in found.description] == got.columns
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows) == sorted(found.fetchall())
    assert sorted(tuple(r) for r in mixing.op7_mix(spark, SF).collect()) == sorted(rows)
    assert all(r[4] <= 3 * r[1] for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r[2], r[3]].append(r)
    for (_, target), own in by.items():
        assert abs(sum(r[4] for r in own) - target) <= 2 * max(r[1] for r in own)


def test_mix_edges(edge, nothing):  # noqa: F811
    out = mixing.mix(edge)
    assert out.columns == edge.columns
    sizes = Counter()
    for r in edge.collect():
        sizes[r.source] += len((r.text or "").split())
    assert {r.source for r in out.collect()} <= set(sizes)
    before = Counter((r.doc_id, r.text) for r in edge.collect())
    after = Counter((r.doc_id, r.text) for r in out.collect())
    assert all(n <= 3 * before[k] for k, n in after.items())
    assert mixing.mix(nothing).count() == 0


def test_a_hot_cell_is_numbered_once(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "'one' as source", "cast(4 as bigint) as _size")
    docs = docs.union(spark.range(10).selectExpr("id", "'two'", "cast(300 as bigint)"))
    got = mixing.with_copies(docs)
    totals = {r.source: r for r in got.groupBy("source").agg(F.sum(F.col("_copies") * F.col("_size")).alias("w"), F.first("target").alias("t")).collect()}
    assert all(abs(r.w - r.t) <= 300 for r in totals.values()), totals


def test_schedule():
    items = [(0, i, s) for i, s in enumerate([7, 7, 6, 5, 4, 3, 9, 1])]
    placed = sharding.schedule(items, 3)
    heap, want = [(0, s) for s in range(3)], {}
    for _, i, s in sorted(items, key=lambda x: -x[2]):
        load, shard = heapq.heappop(heap)
        want[0, i] = shard
        heapq.heappush(heap, (load + s, shard))
    assert placed == want


@pytest.mark.parametrize("bundles", [2, 512])
def test_shards(spark, edge, nothing, monkeypatch, bundles):  # noqa: F811
    monkeypatch.setattr(sharding, "BUNDLES", bundles)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (docs, edge):
        texts, rows = {}, sharding.assign(df).collect()
        slots, sizes = defaultdict(list), Counter()
        want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in df.collect())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
        for r in rows:
            slots[r.shard].append(r.slot)
            sizes[r.shard] += r.size
            assert texts.setdefault((r.size, r.text_crc32), r.shard) == r.shard
            assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < 16
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        if df is docs and bundles == 512:
            assert max(sizes.values()) <= 1.02 * sum(sizes.values()) / 16
    assert sharding.assign(nothing).count() == 0


def test_written_shards(spark, edge, tmp_path):  # noqa: F811
    out = sharding.write_shards(edge, str(tmp_path / "shards"), 4)
    assert out.count() == edge.count()
    assert Counter((r.doc_id, r.text) for r in out.collect()) == Counter((r.doc_id, r.text) for r in edge.collect())


def test_large_groups_are_items_of_their_own(spark):
    texts = [f"{i:08d}" * 8 for i in range(4000)]
    bundle = F.pmod(F.xxhash64(F.sha2(F.col("text").cast("binary"), 256)), F.lit(sharding.BUNDLES)).alias("b")
    placed = spark.createDataFrame([(x,) for x in texts], "text string").select("text", bundle).collect()
    same = defaultdict(list)
    for r in placed:
        same[r.b].append(r.text)
    pair = next(x for x in same.values() if len(x) > 1)[:2]
    share = len(texts) // (sharding.SHARDS - 2)
    rows = list(enumerate(texts + [x for x in pair for _ in range(share)]))
    got = sharding.assign(spark.createDataFrame(rows, "doc_id bigint, text string"))
    sizes = {r.shard: r.b for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()}
    of = {zlib.crc32(x.encode()): x for x in pair}
    found = {of[r.text_crc32]: r.shard for r in got.select("text_crc32", "shard").distinct().collect() if r.text_crc32 in of}
    assert found[pair[0]] != found[pair[1]] and max(sizes.values()) < 1.05 * sum(sizes.values()) / sharding.SHARDS
