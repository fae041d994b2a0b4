"""Whitening against Python integers and numpy on small tables, and its bounds."""

from fractions import Fraction
from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from conftest import SF

from arenamart.llm import whitening as w

SCHEMA = "vec_id bigint, embedding array<double>, n string, deviation string, _at string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)


def brute(rows):
    """Rows that stay, their x, S and covariance in exact arithmetic."""
    kept = [(i, v) for i, v in rows if v and all(c is not None and isfinite(c) for c in v)]
    lengths = [len(v) for _, v in kept]
    length = max(set(lengths), key=lambda k: (lengths.count(k), k))
    kept = [(i, [floor(1024 * Fraction(c)) + 100_000 for c in v]) for i, v in kept if len(v) == length]
    n, sums = len(kept), [sum(c) for c in zip(*(x for _, x in kept), strict=True)]
    cov = [[Fraction(sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for _, x in kept), n**3) for b in range(length)] for a in range(length)]
    return kept, sums, cov


def compare(spark, rows):
    df = frame(spark, rows).repartition(3)
    kept, sums, cov = brute(rows)
    model = w.fit(df)
    n = len(kept)
    assert (model.n, model.sums) == (n, sums)
    exact = np.array([[float(c) for c in line] for line in cov])
    assert (model.covariance == exact).all()
    got = sorted(w.whiten(df, model).collect(), key=repr)
    want = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True))) for i, x in kept]
    want = sorted(((i, v if v < 10**38 else None) for i, v in want), key=repr)
    assert sorted(((r.vec_id, None if r.deviation is None else int(r.deviation)) for r in got), key=repr) == want
    return model, got


def random_rows(count, size, seed=0, scale=0.3):
    rng = np.random.default_rng(seed)
    mix = rng.normal(0, scale, (size, size))
    return [(i, [float(c) for c in rng.normal(0, 1, size) @ mix]) for i in range(count)]


def test_random_vectors(spark):
    rows = random_rows(60, 11)
    model, got = compare(spark, rows)
    kept, sums, cov = brute(rows)
    exact = np.array([[float(c) for c in line] for line in cov])
    assert np.allclose(exact @ model.axes, model.axes * model.values, atol=1e-9 * model.values[0])
    assert np.allclose(model.axes.T @ model.axes, np.eye(11), atol=1e-12)
    x = {i: np.array([float(Fraction(c) - Fraction(s, len(kept))) for c, s in zip(v, sums, strict=True)]) for i, v in kept}
    for r in got:
        assert np.allclose(r.whitened, x[r.vec_id] @ model.axes[:, :8] / np.sqrt(model.values[:8]), atol=1e-9)


def test_edges(spark):
    rows = random_rows(20, 5, 1) + [
        (30, None), (31, []), (32, [1.0, None, 1.0, 1.0, 1.0]), (33, [nan, 0.0, 0.0, 0.0, 0.0]), (34, [inf] * 5), (35, [-inf] * 5),
        (36, [1.0, 2.0]), (3, [0.5, 0.5, 0.5, 0.5, 0.5]), (3, [0.5, 0.5, 0.5, 0.5, 0.5]), (37, [-0.0] * 5),
    ]
    _, got = compare(spark, rows)
    assert len(got) == 23 and all(len(r.whitened) == 5 for r in got)


@pytest.mark.parametrize("large", [3e5, 1e9, 4e12, 8e15])
def test_large_entries_stay_exact(spark, large):
    compare(spark, random_rows(7, 4, 2) + [(50, [large, -large, 1.0, 0.0]), (51, [large / 3, 0.1, -large, 2.0])])


def test_beyond_long_stops_at_its_end(spark):
    df = frame(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.5])])
    got = {r.vec_id: r for r in w.whiten(df, w.fit(df)).collect()}
    assert len(got) == 3 and got[1].deviation is None and got[3].deviation is not None


def test_no_variance_and_no_rows(spark):
    same = frame(spark, [(i, [0.25, 0.5]) for i in range(4)])
    model = w.fit(same)
    got = w.whiten(same, model).collect()
    assert [(int(r.deviation), r.whitened) for r in got] == [(0, [None, None])] * 4
    assert w.identity_error(w.whiten(same, model), model) == 0.0
    nothing = same.limit(0)
    assert w.fit(nothing) is None and w.whiten(nothing, None).count() == 0


def test_query(spark):
    rows = w.op11_whitening(spark, SF)
    assert rows.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = rows.collect()
    plain = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    kept, sums, _ = brute(plain)
    n = len(kept)
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    deviation = {i: sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for i, x in kept}
    assert all(r.deviation == deviation[r.vec_id] for r in got)
    assert {r.identity_error for r in got}.pop() < 1e-8
    matrix = np.zeros((n, 8))
    place = {i: k for k, (i, _) in enumerate(kept)}
    for r in got:
        matrix[place[r.vec_id], r.component - 1] = r.whitened
    assert np.allclose(matrix.T @ matrix / n, np.eye(8), atol=1e-8)
    x = np.array([x for _, x in kept], float)
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    share = {r.component: r.explained for r in got}
    assert np.allclose([share[k + 1] for k in range(8)], values[:8] / values.sum(), rtol=1e-8)
