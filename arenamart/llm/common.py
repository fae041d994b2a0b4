"""Helpers shared by the text operators: tables, stored stages, word patterns, fold of a document."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arenamart.session import apply_settings, fresh_path

#: Words of a text: runs without the six white-space characters of ASCII.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
HELD_OUT_OF = 5


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers look for this package where the driver found it; on a cluster it is shipped.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return apply_settings(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to a new path in the shared folder and read it again: lineage ends here."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def split_words(text: Column) -> Column:
    """All words of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text is divisible by five; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == 0, F.lit(False))


def trainable(doc_id: Column) -> Column:
    """Rows a model may learn from: not held out, and with an id."""
    return doc_id.isNotNull() & ~held_out(doc_id)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is used where the text has no other capital letter."""
    upper = "".join(map(chr, range(65, 91)))
    other = text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]")
    return F.when(other, F.translate(text, upper, upper.lower())).otherwise(F.lower(text))


def broadcast_slices(df: DataFrame, key: str, rows: int) -> list[DataFrame]:
    """``df`` in parts of about ``rows`` rows each, so that every part may be broadcast.

    The count is one small job. A larger table only gives more parts; none of its rows is left out.
    """
    parts = max(1, -(-df.count() // rows))
    if parts == 1:
        return [df]
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    return [df.where(part == i) for i in range(parts)]


def contiguous(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[pa.RecordBatch]]:
    """Slices of equal key, for rows that arrive sorted by it; a run may cross batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        values = list(zip(*[batch.column(k).to_pylist() for k in keys], strict=True))
        start = 0
        for i in range(1, len(values) + 1):
            if i == len(values) or values[i] != values[start]:
                if held and values[start] != last:
                    yield held
                    held = []
                held.append(batch.slice(start, i - start))
                last, start = values[i - 1], i
    if held:
        yield held
