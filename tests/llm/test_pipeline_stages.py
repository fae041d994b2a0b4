"""The corpus pipeline stage by stage, and the registration."""

from collections import Counter

import pytest
from conftest import SF
from edge_rows import edge, nothing  # noqa: F401
from test_decontaminate import brute as contaminated
from test_near_dup import brute as grouped
from test_tokens import expected

import __spark_entry__ as entry
import corpus_pipeline


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    known = corpus_pipeline.language(spark, docs, SF)
    assert known.columns == columns and known.exceptAll(docs).count() == 0
    single = corpus_pipeline.near_duplicates(spark, docs, SF).cache()
    groups = grouped([(r.doc_id, r.text) for r in docs.collect()], 5, 80)
    assert {r.doc_id for r in single.collect()} == {d for d, _, c in groups if d == c} and single.columns == columns
    clean = corpus_pipeline.decontamination(spark, docs, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = contaminated([(r.doc_id, r.text) for r in docs.collect()], items)
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in hit if not r[5]} and clean.columns == columns
    mixed = corpus_pipeline.mixture(spark, docs, SF)
    assert mixed.columns == columns and max(Counter(r.doc_id for r in mixed.collect()).values()) <= 3


def test_run_is_its_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    docs = docs.orderBy("doc_id").collect()
    want = sorted(r[2:] for r in expected([(r.doc_id, r.text) for r in docs]))
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.n_tokens, r.ids_crc32) for r in rows) == want
    assert sorted(r.doc_id for r in rows) == [r.doc_id for r in docs]


@pytest.mark.parametrize("k", range(5))
def test_stage_edges(spark, edge, nothing, k):  # noqa: F811
    name, stage = corpus_pipeline.STAGES[k]
    for df in (edge, nothing):
        out = stage(spark, df, SF)
        assert name == "tokens" or out.columns == edge.columns
        out.collect()


def test_registered():
    known = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in known) for k in range(1, 11)] == [1] * 10
    assert "pipeline" in known and set(entry.oracle_sql()) <= set(known)
