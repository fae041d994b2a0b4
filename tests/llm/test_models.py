"""Language identification and quality scores: held-out accuracy, and the parts."""

import numpy as np
from conftest import SF
from edge_rows import edge, nothing  # noqa: F401
from pyspark.sql import functions as F

from arenamart.llm import language, quality_model
from arenamart.llm.common import read


def test_language_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = language.op1_language(spark, SF).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r.held_out]
    assert 20 < len(held) < 80
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark, edge, nothing):  # noqa: F811
    model = language.learn(read(spark, SF, "documents"))
    rows = {r.doc_id: r for r in language.predict(edge, model).collect() if r.doc_id is not None}
    for i in (4, 5, 6, 7):
        assert (rows[i].lang_pred, rows[i].score, rows[i].rejected) == ("und", 0.0, True)
    assert rows[11].lang_pred in model.languages
    kept = language.keep_known(edge, model)
    assert kept.columns == edge.columns and kept.schema == edge.schema
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {4, 5, 6, 7}
    assert language.predict(nothing, model).count() == 0
    assert language.learn(nothing) is None
    assert {r.lang_pred for r in language.predict(edge, None).collect()} == {"und"}
    assert language.keep_known(edge, None).count() == 0


def test_clean_documents_are_not_rejected(spark):
    docs = read(spark, SF, "documents")
    assert language.keep_known(docs, language.learn(docs)).count() == docs.where(F.col("text").rlike(r"\p{L}")).count()


def test_subwords_do_not_depend_on_blocks(monkeypatch):
    text = ("Ein Satz, und noch einer; ÄÖÜ. " * 40).encode()
    whole = language.bucket_counts(text)
    assert whole.sum() == 4 * len(text) - 6
    monkeypatch.setattr(language, "BLOCK", 17)
    assert (language.bucket_counts(text) == whole).all()


def test_scores_equal_embeddings_times_weights():
    rows = [(x, np.array([i % 2, 5]), np.array([0.7, 0.3]), i) for i, x in enumerate("ab" * 20)]
    model = language.train(rows)
    p = model.probabilities(np.array([0.7 * model.scores[i] + 0.3 * model.scores[5] for i in (0, 1)]))
    assert [model.languages[i] for i in p.argmax(axis=1)] == ["a", "b"]


def test_quality_of_held_out_documents(spark):
    # the smallest tables have 19 held-out labels, too few for a share
    tables = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{tables}/labels.parquet").collect()}
    rows = quality_model.op6_quality(spark, tables).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    again = quality_model.op6_quality(spark, tables).collect()
    assert sorted(again) == sorted(rows)


def test_quality_edges(spark, edge, nothing):  # noqa: F811
    model = quality_model.learn(read(spark, SF, "documents"), read(spark, SF, "labels"))
    rows = quality_model.score(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.score <= 1 for r in rows)
    same = [r.score for r in rows if r.doc_id == 2]
    assert same[0] == same[1]
    assert quality_model.score(nothing, model).count() == 0
    labels = edge.selectExpr("doc_id", "1 as quality")
    assert quality_model.learn(edge, labels) is None
    assert {r.score for r in quality_model.score(edge, None).collect()} == {0.5}


def test_ranker_orders_pairs():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    truth = x @ np.array([2.0, -1, 0, 0, 0.5])
    label = (truth + rng.normal(0, 0.2, 600) > -1).astype(int)
    model = quality_model.rank(x, label)
    score = model.score(x)
    order = np.argsort(truth)
    assert np.corrcoef(np.argsort(order), np.argsort(np.argsort(score)))[0, 1] > 0.97
    # the share below the threshold is the share labelled 0
    assert abs((score < 0.3).mean() - (label == 0).mean()) < 0.01
    assert np.allclose(np.log(score / (1 - score)) - model.strength(x), np.log(0.3 / 0.7) - model.threshold)


def test_quality_learns_from_every_labelled_row(spark):
    kinds = ["Some plain words in a sentence, number {}.", "{} !! ## buy buy buy {}"]
    rows = [(i, kinds[i % 3 == 0].format(i * i, i) + "x" * (i % 7)) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = docs.selectExpr("doc_id", "int(doc_id % 3 != 0) as quality")
    known = docs.where(quality_model.trainable(F.col("doc_id"))).collect()
    assert len(known) > 4000
    x = np.array([quality_model.describe(r.text.encode()) for r in known])
    model = quality_model.learn(docs, labels)
    assert np.allclose(model.mean, x.mean(axis=0), rtol=1e-9, atol=1e-9)
    strength = np.sort([model.strength(v) for v in x])
    bad = sum(r.doc_id % 3 == 0 for r in known)
    assert (strength < model.threshold).sum() == bad and strength[bad - 1] <= model.threshold <= strength[bad]
    whole = quality_model.rank(x, np.array([int(r.doc_id % 3 != 0) for r in known]))
    assert np.corrcoef(whole.weights, model.weights)[0, 1] > 0.95
    assert quality_model.learn(docs.repartition(3), labels).weights.tolist() == model.weights.tolist()
