"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is its UTF-8 bytes with A-Z lower-cased and every other ASCII byte that is no letter turned into
a space. Its subwords are all runs of 1 to 4 bytes; each is hashed into one of ``BUCKETS`` rows of an
embedding table. The embeddings of a whole text are averaged and a linear softmax gives the languages.
Table and softmax are trained together in numpy by stochastic gradient descent. As average and softmax
are linear, scoring uses their product: one row of language scores per bucket.

Training sees every chosen text whole and ``FRAGMENTS`` short pieces of it, so that short texts are known
too. A temperature, fitted on texts that training left out, calibrates the probabilities. The rejection
threshold is the ``REJECT_SHARE`` quantile of the probabilities of rightly predicted ones among them, and
``MOST_ASKED`` at most.

Training takes at most ``PER_LANGUAGE`` labelled documents of each language (those with the smallest hash
of their id), whole texts, outside the held-out fold.

Defined results: a null text, or one without a letter, is ``und`` with score 0 and rejected; a null id is
never held out and never trained on; equal rows get equal results; without labelled rows every text is
``und``; extra columns are kept by ``keep_known`` and dropped by ``predict``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenamart.llm.common import held_out, read, trainable

PER_LANGUAGE = 400
CELLS = 64
BUCKETS = 1 << 14
WIDTH = 16
EPOCHS = 12
#: Bytes of the short pieces of a training text, about.
FRAGMENTS = (18, 30, 45, 70)
RATE = 0.5
REJECT_SHARE = 0.001
#: The threshold asks for no more than this probability.
MOST_ASKED = 0.4
#: Bytes that are worked on at once, in training and scoring.
BLOCK = 1 << 20
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 32
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def subwords(data: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket of the run of 1, 2, 3 and 4 bytes that starts at each byte."""
    folded = _FOLD[data].astype(np.uint32)
    code = np.zeros_like(folded)
    for length in range(1, 5):
        part = folded[length - 1 :]
        code = code[: len(part)] * np.uint32(257) + part
        mixed = (code ^ np.uint32(length * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)
        yield ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0xC2B2AE35)) >> np.uint32(18)


def bucket_counts(data: bytes) -> np.ndarray:
    """How often each bucket occurs in a text; subwords that cross a block edge are included."""
    raw, counts = np.frombuffer(data, np.uint8), np.zeros(BUCKETS, np.int64)
    for start in range(0, len(raw), BLOCK):
        for length, found in enumerate(subwords(raw[start : start + BLOCK + 3]), 1):
            counts += np.bincount(found[: max(0, min(BLOCK, len(raw) - start - length + 1))], minlength=BUCKETS)
    return counts


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # bucket x language: embedding times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, averages: np.ndarray) -> np.ndarray:
        return softmax((averages + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray, int]], seed: int = 7) -> Model:
    """From (language, buckets, shares, number of the text) per whole text or piece of one.

    Every fifth text is left out, with its pieces, and calibrates.
    """
    languages = sorted({r[0] for r in rows})
    at = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (BUCKETS, WIDTH))
    weights, bias = rng.normal(0, 0.1, (WIDTH, len(languages))), np.zeros(len(languages))
    fit = [i for i, r in enumerate(rows) if r[3] % 5] or list(range(len(rows)))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for i in rng.permutation(fit):
            language, buckets, shares, _ = rows[i]
            average = shares @ table[buckets]
            error = softmax((average @ weights + bias)[None])[0]
            error[at[language]] -= 1
            back = weights @ error
            weights -= rate * np.outer(average, error)
            bias -= rate * error
            # The share is each bucket's part of the gradient; scaled up, as shares are small.
            table[buckets] -= rate * 20 * np.outer(shares, back)
    scores = table @ weights
    left_out = [r for r in rows if not r[3] % 5]
    logits = np.array([shares @ scores[buckets] for _, buckets, shares, _ in left_out]).reshape(-1, len(languages)) + bias
    truth = np.array([at[r[0]] for r in left_out], dtype=int)

    def loss(t: float) -> float:
        p = softmax(logits / t)[np.arange(len(truth)), truth]
        return -np.log(np.maximum(p, 1e-12)).mean()

    temperature = min(np.geomspace(0.1, 10, 60), key=loss) if len(truth) else 1.0
    p = softmax(logits / temperature) if len(truth) else np.zeros((0, 1))
    right = p.max(axis=1)[p.argmax(axis=1) == truth] if len(truth) else np.zeros(0)
    threshold = min(MOST_ASKED, float(np.quantile(right, REJECT_SHARE, method="lower"))) if len(right) else 0.0
    return Model(languages, scores.astype(np.float32), bias, float(temperature), threshold)


def pieces(text: bytes) -> list[bytes]:
    """The whole text, and pieces of it that start behind a space; none of a short text."""
    found = [text]
    for k, size in enumerate(FRAGMENTS):
        start = text.find(b" ", len(text) * k // len(FRAGMENTS)) + 1
        if len(text) > 2 * sum(FRAGMENTS) and start:
            found.append(text[start : start + size].rpartition(b" ")[0] or text[start : start + size])
    return found


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets and their counts, as packed numbers, of every piece of every text."""
    for batch in batches:
        row, buckets, counts = [], [], []
        for i, text in enumerate(batch.column("text")):
            for piece in pieces((text.as_py() or "").encode()):
                dense = bucket_counts(piece)
                places = np.flatnonzero(dense)
                row.append(i)
                buckets.append(places.astype(">u2").tobytes())
                counts.append(dense[places].astype("<u4").tobytes())
        same = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(same),
                batch.column("lang").take(same),
                pa.array(buckets, pa.binary()),
                pa.array(counts, pa.binary()),
            ],
            ["doc_id", "lang", "buckets", "counts"],
        )


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """Trains on a bounded sample of labelled rows; None where no row has a label."""
    known = docs.where(trainable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    ids = known.select("doc_id", "lang")
    # Cells of a language are limited first, so that no task sorts all ids of one.
    ids = ids.withColumns({"_hash": F.xxhash64("doc_id"), "_cell": F.crc32(F.col("doc_id").cast("string").cast("binary")) % CELLS})
    for keys in (["lang", "_cell"], ["lang"]):
        nth = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash", "doc_id"))
        ids = ids.withColumn("_n", nth).where(F.col("_n") <= per_language).drop("_n")
    chosen = ids.select("doc_id").distinct()
    texts = known.select("doc_id", "lang", "text").join(F.broadcast(chosen), "doc_id")
    # An id may have any number of rows; one text of each language is learned from.
    texts = texts.groupBy("doc_id", "lang").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    found = texts.mapInArrow(_features, "doc_id bigint, lang string, buckets binary, counts binary").toArrow()
    if not found.num_rows:
        return None
    ids, langs, buckets, counts = (found.column(c).to_pylist() for c in ("doc_id", "lang", "buckets", "counts"))
    del found
    rows, number = [], {}
    # Big-endian bytes sort like the numbers in them.
    for i in sorted(range(len(ids)), key=lambda i: (ids[i], langs[i], buckets[i])):
        own = np.frombuffer(counts[i], "<u4").astype(np.float64)
        place = number.setdefault(ids[i], len(number))
        rows.append((langs[i], np.frombuffer(buckets[i], ">u2").astype(np.int64), own / own.sum(), place))
        buckets[i] = counts[i] = None
    return train(rows)


def score_batch(model: Model, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language and its probability, for each text of an Arrow array."""
    data = texts.cast(pa.large_binary()) if pa.types.is_string(texts.type) else texts.cast(pa.large_binary())
    values = [v.as_buffer() if v.is_valid else b"" for v in data]
    sums = np.zeros((len(values), len(model.languages)))
    for i, value in enumerate(values):
        raw = np.frombuffer(value, np.uint8) if len(value) else np.zeros(0, np.uint8)
        total = 0
        for start in range(0, len(raw), BLOCK):
            for length, found in enumerate(subwords(raw[start : start + BLOCK + 3]), 1):
                found = found[: max(0, min(BLOCK, len(raw) - start - length + 1))]
                total += len(found)
                sums[i] += model.scores[found].sum(axis=0, dtype=np.float64)
        sums[i] /= max(1, total)
    p = model.probabilities(sums)
    return p.argmax(axis=1), p.max(axis=1)


def _scorer(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, p = score_batch(model, batch.column("row").field("text"))
            names = pa.array([model.languages[i] for i in best], pa.string())
            columns = [batch.column("row"), batch.column("_letters"), names, pa.array(p, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "_letters", "_lang", "_score"])

    return run


def with_language(docs: DataFrame, model: Model | None) -> DataFrame:
    """Every document as the struct ``row``, with lang_pred, score and rejected."""
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.struct("*").alias("row"), letters.alias("_letters"))
    if model is None:
        return rows.select("row", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    kind = rows.schema["row"].dataType
    schema = T.StructType().add("row", kind).add("_letters", "boolean").add("_lang", "string").add("_score", "double")
    scored = rows.mapInArrow(_scorer(model), schema)
    return scored.select(
        "row",
        F.when(F.col("_letters"), F.col("_lang")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("_letters"), F.col("_score")).otherwise(0.0).alias("score"),
        (~F.col("_letters") | (F.col("_score") < model.threshold)).alias("rejected"),
    )


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every document row."""
    out = with_language(docs.select("doc_id", "text"), model)
    doc_id = F.col("row.doc_id")
    return out.select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "lang_pred", "score", "rejected")


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """Documents whose language is not rejected, with their own columns."""
    return with_language(docs, model).where(~F.col("rejected")).select("row.*")


def op1_language(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return predict(docs, learn(docs))
