"""Benchmark hits against a plain scan, and the removers."""

import hashlib
import re

import duckdb
import pytest
from conftest import SF
from edge_rows import edge, nothing  # noqa: F401

from arenamart.llm import decontaminate as d

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(n, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[s : s + k]), set()).add(item)
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for s in range(len(w) - k + 1):
                if (x := tuple(w[s : s + k])) in windows:
                    hit |= set(range(s, s + k))
                    found |= windows[x] - {None}
        ids = ",".join(sorted(map(str, found)))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_sql_agrees(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    got = d.op4_decontaminate(spark, SF)
    found = con.execute(d.OP4_SQL)
    assert [x[0] for x in found.description] == got.columns
    assert rows(got) == sorted(found.fetchall(), key=str)


ITEMS = [
    (1, "W0 w4, w10 w18 w28 w40 w54 w70 w88 w108 w130"),
    (2, "two TWO"),
    (3, "ÉTÉ à"),
    (None, "w0 w4 w10 w18 w28 w40 w54 w70 w88 w108"),
    (4, None),
    (5, " .. "),
    (6, "Été À"),
    (6, "two two"),
]


def test_edges(spark, edge, nothing):  # noqa: F811
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    more = [(20, "a W0 w4 w10 w18 w28 w40 w54 w70 w88 w108 w130 b"), (21, "w0 w4 w10 w18 w28 w40 w54 w70 w88"), (22, "Été À, été à")]
    docs = edge.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id bigint, text string"))
    plain = [tuple(r) for r in docs.collect()]
    assert rows(d.contamination(docs, items)) == brute(plain, ITEMS)
    assert rows(d.contamination(docs, items.limit(0))) == brute(plain, [])
    assert d.contamination(nothing, items).count() == 0


@pytest.mark.parametrize("bound", [3, 500_000])
def test_a_benchmark_beyond_the_bound_goes_in_parts(spark, monkeypatch, bound):
    monkeypatch.setattr(d, "WINDOWS_PER_BROADCAST", bound)
    items = [(i, " ".join(f"w{i * 3 + k}" for k in range(14))) for i in range(6)]
    docs = [(i, " ".join(f"w{i + k}" for k in range(12))) for i in range(20)]
    got = d.contamination(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert rows(got) == brute(docs, items)


def test_removers(spark, edge):  # noqa: F811
    items = spark.createDataFrame([(1, "two two")], "item_id bigint, text string")
    left = d.remove_documents(edge, items)
    assert left.columns == edge.columns and left.count() == edge.count() - 1
    assert left.where("doc_id = 10").count() == 0
    cut = d.remove_spans(edge, items)
    assert cut.columns == edge.columns and cut.count() == edge.count()
    assert {r.doc_id: r.text for r in cut.collect()}[10] == "One.\nOne.\n\n"
    assert cut.exceptAll(edge).count() == 1
