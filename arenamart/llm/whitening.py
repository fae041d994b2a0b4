"""Embedding whitening by polarisation covariance.

Entries become integers x = floor(1024 c) + 100000. One pass sums them per dimension; the next sums exact
squares of the centred values of every dimension and of every sum of two dimensions. The variance of a
sum holds twice the covariance of its parts, so that differences of these variances give the whole
covariance, exact until its last division. ``eigh`` of that matrix gives the components.

Squares are taken of x - m with the whole number m at or below a dimension's mean; the rest of the mean is
taken off the finished sum, which makes it the sum of squares about the mean itself. All sums are exact at
any size: tasks add 64-bit integers while they must fit and hand on partial sums, Spark adds those
as decimals.

Defined results: rows whose vector is null or holds a null or non-finite entry go; of vectors of several
lengths those of the commonest length stay (the longer one of a tie), since others lack dimensions;
empty vectors go. x stops at the ends of a long. Rows with a null or repeated vec_id count like any
other. A component without variance (equal vectors, fewer rows than dimensions) has whitened null and
takes no part in identity_error; ``deviation`` beyond 38 digits is null. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenamart.llm.common import read, stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Rows that one numpy step takes; bounds its memory to about rows x dimensions x 24 bytes.
STEP = 4096
_LOW = 62
_EDGE = float(2**63 - 2**20)
SUMS = "length int, i int, j int, hi decimal(38,0), lo bigint, n bigint"


def vectors(batch: pa.RecordBatch, length: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and x of the rows that take part, for each length in the batch (or for one length)."""
    column = batch.column("embedding")
    lengths = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    flat = column.flatten().cast(pa.float64())
    values = flat.to_numpy(zero_copy_only=False)
    if flat.null_count:
        values = np.where(np.asarray(flat.is_null()), np.nan, values)
    ends = np.cumsum(lengths)
    for own in [length] if length else np.unique(lengths[lengths > 0]):
        places = np.flatnonzero(lengths == own)
        for start in range(0, len(places), STEP):
            part = places[start : start + STEP]
            matrix = values[(ends[part] - own)[:, None] + np.arange(own)]
            fine = np.isfinite(matrix).all(axis=1)
            if fine.any():
                with np.errstate(over="ignore"):
                    scaled = np.floor(matrix[fine] * SCALE)
                yield part[fine], np.clip(scaled, -_EDGE, _EDGE).astype(np.int64) + SHIFT


def _fits(x: np.ndarray, most: int, power: int) -> np.ndarray:
    """x as 64-bit integers where sums of ``most`` powers of it fit, else as Python integers."""
    largest = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
    return x if most * largest**power < 1 << 62 else x.astype(object)


class _Sums:
    """Running sums that never overflow: full ones are handed on as rows."""

    def __init__(self, length: int, size: int):
        self.length, self.size, self.bound, self.n = length, size, 0, 0
        self.total = np.zeros(size, np.int64)

    def add(self, values: np.ndarray, n: int) -> Iterator[list]:
        if values.dtype == object:
            yield self._rows(values, n)
            return
        most = int(np.abs(values).max())
        if self.bound + most >= 1 << _LOW:
            yield from self.rest()
        self.total, self.bound, self.n = self.total + values, self.bound + most, self.n + n

    def rest(self) -> Iterator[list]:
        if self.n:
            yield self._rows(self.total, self.n)
        self.total, self.bound, self.n = np.zeros(self.size, np.int64), 0, 0

    def _rows(self, values: np.ndarray, n: int) -> list:
        hi = [int(v) >> _LOW for v in values]
        lo = [int(v) & ((1 << _LOW) - 1) for v in values]
        return [self.length, hi, lo, n]


def _batch(rows: list, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    length, hi, lo, n = rows
    size = len(lo)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(size, length, np.int32)),
            pa.array(i.astype(np.int32)),
            pa.array(j.astype(np.int32)),
            pa.array(hi, pa.decimal128(38, 0)),
            pa.array(lo, pa.int64()),
            pa.array(np.full(size, n, np.int64)),
        ],
        ["length", "i", "j", "hi", "lo", "n"],
    )


def _first_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum of x per length and dimension i."""
    held: dict[int, _Sums] = {}
    for batch in batches:
        for _, x in vectors(batch):
            sums = held.setdefault(x.shape[1], _Sums(x.shape[1], x.shape[1]))
            for rows in sums.add(_fits(x, len(x), 1).sum(axis=0), len(x)):
                yield _batch(rows, np.arange(sums.size), np.arange(sums.size))
    for sums in held.values():
        for rows in sums.rest():
            yield _batch(rows, np.arange(sums.size), np.arange(sums.size))


def _square_sums(length: int, middle: np.ndarray):
    """Sum of squares of u_i (as i, i) and of u_i + u_j (i < j), u being x less ``middle``."""
    i, j = np.triu_indices(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(length, len(i))
        for batch in batches:
            for _, x in vectors(batch, length):
                u = _centred(x, middle)
                u = _fits(u, 4 * len(u), 2)
                parts = []
                for d in range(length):
                    both = u[:, d : d + 1] + u[:, d:]
                    both[:, 0] = u[:, d]
                    parts.append((both * both).sum(axis=0))
                for rows in sums.add(np.concatenate(parts), len(u)):
                    yield _batch(rows, i, j)
        for rows in sums.rest():
            yield _batch(rows, i, j)

    return run


def _centred(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """x - middle, exact."""
    ends = [int(x.min()), int(x.max()), int(middle.min()), int(middle.max())]
    if max(ends[1] - ends[2], ends[3] - ends[0]) < 1 << 62:
        return x - middle.astype(np.int64)
    return x.astype(object) - middle


def _summed(df: DataFrame) -> DataFrame:
    """Partial sums of all tasks; the two parts of each are added apart."""
    wide = "decimal(38,0)"
    total = [F.sum("hi").alias("hi"), F.sum(F.col("lo").cast(wide)).alias("lo"), F.sum("n").alias("n")]
    return df.groupBy("length", "i", "j").agg(*total)


def _whole(row) -> int:
    return (int(row["hi"]) << _LOW) + int(row["lo"])


@dataclass(frozen=True)
class Whitening:
    """What the fit found; every array is bounded by dimensions squared."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray  # eigenvalues, falling
    axes: np.ndarray  # dimension x component

    @property
    def length(self) -> int:
        return len(self.sums)

    @property
    def middle(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], dtype=object)

    def alive(self) -> np.ndarray:
        """Components with a variance above rounding error."""
        return self.values > max(0.0, float(self.values[0])) * self.length * 2.0**-48

    def explained(self) -> np.ndarray:
        trace = float(np.trace(self.covariance))
        return self.values / trace if trace > 0 else np.zeros(self.length)

    def projection(self, components: int) -> np.ndarray:
        """Dimension x component, scaled to unit variance; zeros for a component without variance."""
        alive = self.alive()[:components]
        scale = np.where(alive, np.sqrt(np.where(alive, self.values[:components], 1.0)), np.inf)
        return self.axes[:, :components] / scale

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """x - S/n as doubles, and the exact sum over dimensions of (n x - S)^2."""
        middle = self.middle
        u = _centred(x, middle)
        rest = [s - self.n * int(m) for s, m in zip(self.sums, middle, strict=True)]
        from_mean = u.astype(np.float64) - np.array([r / self.n for r in rest])
        largest = max(abs(int(u.min())), abs(int(u.max()))) + 1
        whole = u if u.shape[1] * (self.n * largest) ** 2 < 1 << 62 else u.astype(object)
        deviation = whole * self.n - np.array(rest, dtype=whole.dtype)
        return from_mean, (deviation * deviation).sum(axis=1)


def fit(df: DataFrame) -> Whitening | None:
    """Exact covariance of all rows that take part; None where there are none."""
    spark = df.sparkSession
    found = stored(_summed(df.select("embedding").mapInArrow(_first_sums, SUMS)), "vector-sums")
    first = found.where("i = 0").orderBy(F.desc("n"), F.desc("length")).limit(1).collect()
    if not first:
        return None
    length, n = first[0]["length"], first[0]["n"]
    by_place = {r["i"]: _whole(r) for r in found.where(F.col("length") == length).collect()}  # one row a dimension
    sums = [by_place[i] for i in range(length)]
    middle = np.array([s // n for s in sums], dtype=object)
    rest = [s - n * int(m) for s, m in zip(sums, middle, strict=True)]
    squares = _summed(df.select("embedding").mapInArrow(_square_sums(length, middle), SUMS))
    table = squares.select("i", "j", "hi", "lo").toArrow()  # one row a pair of dimensions
    about = {}
    for i, j, hi, lo in zip(*(table.column(c).to_pylist() for c in ("i", "j", "hi", "lo")), strict=True):
        shift = rest[i] + (rest[j] if i != j else 0)
        # n times the sum of squares about the mean; the sum of u itself is ``rest``.
        about[i, j] = n * ((int(hi) << _LOW) + int(lo)) - shift * shift
    covariance = np.empty((length, length))
    for (i, j), both in about.items():
        shared = 2 * both if i == j else both - about[i, i] - about[j, j]
        covariance[i, j] = covariance[j, i] = float(Fraction(shared, 2 * n * n))
    values, axes = np.linalg.eigh(covariance)
    return Whitening(n, sums, covariance, values[::-1].copy(), axes[:, ::-1].copy())


def whiten(df: DataFrame, model: Whitening | None, components: int = COMPONENTS) -> DataFrame:
    """vec_id, deviation (exact), whitened (array of doubles) of every row that takes part."""
    kind = df.schema["vec_id"].dataType
    schema = T.StructType().add("vec_id", kind).add("deviation", T.DecimalType(38, 0)).add("whitened", T.ArrayType(T.DoubleType()))
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    count = min(components, model.length)
    project, alive = model.projection(count), model.alive()[:count]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, x in vectors(batch, model.length):
                from_mean, deviation = model.centred(x)
                white = pa.array((from_mean @ project).ravel(), mask=np.tile(~alive, len(x)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * count, pa.int32()), white)
                if deviation.dtype == object:
                    deviation = [v if v < 10**38 else None for v in deviation]
                exact = pa.array(deviation).cast(pa.decimal128(38, 0)) if not isinstance(deviation, list) else pa.array(deviation, pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(places)), exact, lists], ["vec_id", "deviation", "whitened"])

    return df.select("vec_id", "embedding").mapInArrow(run, schema)


def identity_error(white: DataFrame, model: Whitening | None, components: int = COMPONENTS) -> float:
    """Largest absolute entry of the covariance of the whitened values minus the identity, over all rows."""
    if model is None:
        return 0.0
    alive = np.flatnonzero(model.alive()[: min(components, model.length)])
    at = [F.get("whitened", F.lit(int(k))) for k in alive]
    means = white.agg(F.count("*"), *[F.avg(c) for c in at]).first()[1:]
    off = [c - F.lit(float(m)) for c, m in zip(at, means, strict=True)]
    pairs = [(a, b) for a in range(len(at)) for b in range(a, len(at))]
    found = white.agg(F.count("*"), *[F.avg(off[a] * off[b]) for a, b in pairs]).first()[1:]
    return max((abs(c - (a == b)) for (a, b), c in zip(pairs, found, strict=True)), default=0.0)


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    model = fit(rows)
    white = stored(whiten(rows, model), "whitened")
    error = identity_error(white, model)
    share = F.lit(",".join(map(repr, model.explained()[:COMPONENTS].tolist())) if model else "")
    values = white.select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return values.select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("bigint").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened",
        F.get(F.split(share, ","), F.col("_at")).cast("double").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
