"""Tables that change in one step: data folders that nothing rewrites, and a list of those that count.

A table is a folder with data folders, each partitioned by a bucket of the key's hash, and a list
``versions/n=<number>`` that names, for every bucket, the data folders to read. A change writes new data
folders first and the next list last, as one small file; readers take the newest list. What a change that
broke off has written is named nowhere and never seen. Reads that know their keys read the folders of
those buckets only. A table has one writer at a time.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

BUCKETS = 64
BUCKET = "__bucket"
#: Compression of stored tables; JSON text and lists take far less room than with Spark's default.
CODEC = "zstd"
LIST = "bucket int, folder string, schema string"


def bucket_of(keys: list[str], buckets: int = BUCKETS) -> Column:
    """Bucket of a key by its text, so that an id given as text and as number agree."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table under a path, or nothing if it was never written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class VersionedTable:
    """The table below one folder; every method reads the newest list anew."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), keys, buckets

    def _listed(self) -> tuple[int, list]:
        """Number and rows of the newest list: at most buckets x data folders rows."""
        numbers = _numbers(stored(self.spark, f"{self.path}/versions"), "n")
        if not numbers:
            return 0, []
        newest = self.spark.read.schema(LIST).parquet(f"{self.path}/versions/n={max(numbers)}")
        return max(numbers), newest.collect()

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The table, or those buckets of it; nothing if there is no version yet."""
        _, rows = self._listed()
        if not rows:
            return None
        schema = rows[0]["schema"]
        paths = [
            f"{r['folder']}/{BUCKET}={r['bucket']}"
            for r in rows
            if r["bucket"] >= 0 and (buckets is None or r["bucket"] in buckets)
        ]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _write(self, df: DataFrame) -> tuple[str, list[int]]:
        """A new data folder with the rows, and the buckets it has."""
        folder = f"{self.path}/data-{uuid.uuid4().hex}"
        # Rebalanced, so that a bucket gets few files and a large one still several tasks.
        rows = df.withColumn(BUCKET, bucket_of(self.keys, self.buckets)).hint("rebalance", BUCKET)
        rows.write.partitionBy(BUCKET).option("compression", CODEC).parquet(folder)
        return folder, sorted(_numbers(stored(self.spark, folder), BUCKET))

    def _commit(self, number: int, rows: list[tuple[int, str]], schema: str) -> None:
        # A table without rows is listed too, so that its schema is known.
        listed = [(b, f, schema) for b, f in rows] or [(-1, "", schema)]
        out = self.spark.createDataFrame(listed, LIST).coalesce(1)
        out.write.mode("errorifexists").parquet(f"{self.path}/versions/n={number}")

    def buckets_of(self, df: DataFrame) -> list[int]:
        """Buckets that the keys of ``df`` fall into; at most ``buckets`` numbers."""
        return sorted(r[0] for r in df.select(bucket_of(self.keys, self.buckets).alias("b")).distinct().collect())

    def replace(self, df: DataFrame) -> None:
        """All rows anew. Until the new list stands, readers see the old table."""
        number, _ = self._listed()
        folder, found = self._write(df)
        self._commit(number + 1, [(b, folder) for b in found], _ddl(df))

    def append(self, df: DataFrame) -> None:
        number, rows = self._listed()
        folder, found = self._write(df)
        kept = [(r["bucket"], r["folder"]) for r in rows if r["bucket"] >= 0]
        self._commit(number + 1, kept + [(b, folder) for b in found], _ddl(df))

    def upsert(self, df: DataFrame) -> None:
        """Replace the rows of equal key and add the others; only their buckets are rewritten.

        ``df`` has one row per key; it is stored first, as it is read twice.
        """
        number, rows = self._listed()
        folder, touched = self._write(df)
        if not touched:
            return self._commit(number + 1, [(r["bucket"], r["folder"]) for r in rows if r["bucket"] >= 0], _ddl(df))
        schema = _ddl(df)
        fresh = self.spark.read.schema(schema).parquet(folder).select(*df.columns)
        old = self.read(touched)
        if old is not None:
            known = fresh.select(*[F.col(k).alias(f"__new_{k}") for k in self.keys])
            same = [F.col(k).eqNullSafe(F.col(f"__new_{k}")) for k in self.keys]
            fresh = old.join(known, same, "left_anti").unionByName(fresh)
            folder, touched_now = self._write(fresh)
        else:
            touched_now = touched
        kept = [(r["bucket"], r["folder"]) for r in rows if r["bucket"] >= 0 and r["bucket"] not in touched]
        self._commit(number + 1, kept + [(b, folder) for b in touched_now], schema)


def _numbers(df: DataFrame | None, column: str) -> set[int]:
    """Values of a partition column, from the names of the files."""
    found = (re.search(rf"/{column}=(\d+)/", f) for f in (df.inputFiles() if df is not None else []))
    return {int(m[1]) for m in found if m}


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
