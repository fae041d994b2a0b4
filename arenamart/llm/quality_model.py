"""Quality scores by Bradley-Terry ranking of labelled documents.

A document is described by shares of its characters, words and lines. From preference pairs (a document
labelled 1 over one labelled 0) logistic loss on the feature differences learns the weights; the score
of a document is the weighted sum, so that the difference of two scores is the log odds of preference.
The threshold is the quantile of the scores at the share of documents labelled 0. Reported scores are
squashed to 0..1 with ``CUT`` at the threshold.

Every labelled document outside the held-out fold is learned from, whole texts. Spark deals them into blocks
by the hash of their id, of about ``BLOCK_ROWS`` rows and with ``RARER_ROWS`` of the rarer label on average; the
pairs are all those within a block. A Newton step adds the sums of all blocks, as decimals, so that reruns
agree; mean, scale and threshold are those of all labelled rows.

Defined results: null and empty texts have all features 0 and still get a score; a null id is never held
out and never learned from; without labels of both kinds every score is 0.5; equal rows get equal
results; an empty table gives no rows; extra columns are dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arenamart.llm.common import held_out, read, stored, trainable

BLOCK_ROWS, RARER_ROWS = 512, 16
#: Rows of each label that are paired in one matrix.
CHUNK = 256
STEPS = 15
PENALTY = 1e-3
CUT = 0.3

_GROUPS = [
    range(48, 58),  # digits
    range(65, 91),  # capitals
    range(97, 123),
    [32],
    [10],
    [9, 11, 12, 13],
    range(128, 256),
    *([c] for c in range(33, 127) if not chr(c).isalnum()),
]
_GROUP = np.zeros((256, len(_GROUPS)))
for _at, _codes in enumerate(_GROUPS):
    _GROUP[list(_codes), _at] = 1


def describe(text: bytes) -> np.ndarray:
    """Roots of character shares; then word length, variety, repetition, lines and size."""
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _GROUP / max(1, len(text))
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    rest = [
        len(text) / n / 10,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(len(words)) / 10,
        np.log1p(n / max(1, len(lines))) / 10,
        sum(a == b for a, b in zip(words, words[1:])) / n,
    ]
    return np.concatenate([np.sqrt(shares), rest])


@dataclass(frozen=True)
class Ranker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0..1, increasing with strength, ``CUT`` at the threshold."""
        z = np.clip(self.strength(x) - self.threshold + np.log(CUT / (1 - CUT)), -500, 30)
        return 1 / (1 + np.exp(-z))


def pair_sums(good: np.ndarray, bad: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Loss, gradient and upper half of the Hessian over all pairs of two groups, as mean times rows."""
    size = len(weights)
    loss, gradient, curve = 0.0, np.zeros(size), np.zeros((size, size))
    for i in range(0, len(good), CHUNK):
        for j in range(0, len(bad), CHUNK):
            a, b = good[i : i + CHUNK], bad[j : j + CHUNK]
            ahead = (a @ weights)[:, None] - (b @ weights)[None, :]
            lost = 1 / (1 + np.exp(np.clip(ahead, -500, 500)))
            loss += np.logaddexp(0, -ahead).sum()
            gradient += lost.sum(axis=0) @ b - lost.sum(axis=1) @ a
            share = lost * (1 - lost)
            cross = a.T @ share @ b
            curve += (a.T * share.sum(axis=1)) @ a + (b.T * share.sum(axis=0)) @ b - cross - cross.T
    found = np.concatenate([[loss], gradient, curve[np.triu_indices(size)]])
    return found * ((len(good) + len(bad)) / max(1, len(good) * len(bad)))


def _weights(sums: Callable[[np.ndarray], np.ndarray], size: int, rows: int) -> np.ndarray:
    """Minimum of mean loss and penalty by Newton steps, halved where the loss would rise."""
    best, weights, least = np.zeros(size), np.zeros(size), np.inf
    for _ in range(STEPS):
        found = sums(weights) / rows
        loss = found[0] + PENALTY / 2 * weights @ weights
        if loss > least:
            weights = (best + weights) / 2
            continue
        best, least = weights, loss
        gradient = found[1 : size + 1] + PENALTY * weights
        curve = np.zeros((size, size))
        curve[np.triu_indices(size)] = found[size + 1 :]
        curve = curve + np.triu(curve, 1).T + PENALTY * np.eye(size)
        step = np.linalg.solve(curve, gradient)
        if gradient @ step < 1e-6:
            break
        weights = weights - step
    return best


def _cut(strength_at: Callable[[int], float], bad: int, rows: int) -> float:
    """The share of documents labelled 0 lies below; halfway between the neighbours."""
    k = min(max(bad, 1), rows - 1)
    return (strength_at(k - 1) + strength_at(k)) / 2


def _scale(mean: np.ndarray, square: np.ndarray) -> np.ndarray:
    scale = np.sqrt(np.maximum(square - mean**2, 0))
    scale[scale < 1e-6] = 1
    return scale


def rank(x: np.ndarray, label: np.ndarray) -> Ranker | None:
    """Learns from the pairs of a 1 and a 0; None where either is missing."""
    good, bad = label == 1, label == 0
    if not good.any() or not bad.any():
        return None
    mean = x.mean(axis=0)
    scale = _scale(mean, (x**2).mean(axis=0))
    z = (x - mean) / scale
    weights = _weights(lambda w: pair_sums(z[good], z[bad], w), x.shape[1], len(x))
    strength = np.sort(z @ weights)
    return Ranker(mean, scale, weights, _cut(lambda k: float(strength[k]), int(bad.sum()), len(x)))


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [describe((t or "").encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "x"])


def described(docs: DataFrame) -> DataFrame:
    """doc_id and features of every document row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_described, f"doc_id {kind}, x array<double>")


def _matrix(data: bytes) -> np.ndarray:
    return np.frombuffer(data).reshape(-1, len(describe(b"")))


def _block(key: tuple, group: pa.Table) -> pa.Table:
    """The features of a block's rows of each label, in an order of their own."""
    data, quality = [np.array(v).tobytes() for v in group.column("x").to_pylist()], group.column("quality").to_pylist()
    sides = [b"".join(sorted(v for v, q in zip(data, quality, strict=True) if q == kind)) for kind in (1, 0)]
    return pa.table([pa.array([s], pa.binary()) for s in sides], ["good", "bad"])


def _over_blocks(blocks: DataFrame, found: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Exact sum of an array that is computed for each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for good, bad in zip(*(batch.column(c).to_pylist() for c in ("good", "bad")), strict=True):
                values = found(_matrix(good), _matrix(bad))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], ["at", "v"])

    rows = blocks.mapInArrow(run, "at int, v double")
    sums = rows.groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,12)")).cast("double").alias("v")).collect()
    return np.array([r["v"] for r in sorted(sums)])


def _kth(values: DataFrame, k: int) -> float:
    """The number ``s`` with ``k`` smaller ones before it, by counts in ever smaller steps."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    while low < high and (high - low) / 1024 > 0:
        step = F.least(F.floor((F.col("s") - low) / ((high - low) / 1024)), F.lit(1023))
        inside = values.where(F.col("s").between(low, high)).groupBy(step.alias("step"))
        for found in sorted(inside.agg(F.count("*").alias("n"), F.min("s"), F.max("s")).collect()):
            if k < found["n"]:
                low, high = found[2], found[3]
                break
            k -= found["n"]
    return low


def learn(docs: DataFrame, labels: DataFrame) -> Ranker | None:
    return learn_described(described(docs), labels)


def learn_described(features: DataFrame, labels: DataFrame) -> Ranker | None:
    """The model of all labelled rows; the driver only sees sums over them."""
    known = labels.where(trainable(F.col("doc_id")) & F.col("quality").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    rows = stored(features.join(known, "doc_id"), "quality-rows")
    total, good = rows.agg(F.count("*"), F.coalesce(F.sum("quality"), F.lit(0))).first()
    if not 0 < good < total:
        return None
    parts = max(1, min(-(-total // BLOCK_ROWS), min(good, total - good) // RARER_ROWS))
    dealt = rows.groupBy(F.pmod(F.xxhash64("doc_id"), F.lit(parts)).alias("block"))
    blocks = stored(dealt.applyInArrow(_block, "good binary, bad binary"), "quality-blocks")
    size = len(describe(b""))
    moments = _over_blocks(blocks, lambda a, b: np.concatenate([a.sum(0) + b.sum(0), (a**2).sum(0) + (b**2).sum(0)])) / total
    mean, scale = moments[:size], _scale(moments[:size], moments[size:])

    def sums(weights: np.ndarray) -> np.ndarray:
        return _over_blocks(blocks, lambda a, b: pair_sums((a - mean) / scale, (b - mean) / scale, weights))

    model = Ranker(mean, scale, _weights(sums, size, total), 0.0)

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for side in batch.columns:
                for data in side.to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array([model.strength(x) for x in _matrix(data)], pa.float64())], ["s"])

    values = stored(blocks.mapInArrow(strengths, "s double"), "quality-strengths")
    return Ranker(mean, scale, model.weights, _cut(lambda k: _kth(values, k), total - good, total))


def _scorer(model: Ranker | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                scores = np.full(batch.num_rows, 0.5)
            else:
                x = pc.list_flatten(batch.column("x")).to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                scores = np.array([model.score(row) for row in x])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Ranker | None) -> DataFrame:
    """doc_id, held_out, score, predicted for every document row."""
    return score_described(described(docs), model)


def score_described(features: DataFrame, model: Ranker | None) -> DataFrame:
    kind = features.schema["doc_id"].dataType.simpleString()
    scored = features.mapInArrow(_scorer(model), f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    features = stored(described(read(spark, sf_dir, "documents")), "quality-features")  # texts are read once
    return score_described(features, learn_described(features, read(spark, sf_dir, "labels")))
