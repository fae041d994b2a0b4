"""Document sources: JSON files to bronze rows (key, payload, loaded_at).

Reading yields one row per file (``name``, ``value``); the functions behind it are plain column
work, so they also serve documents that already sit in a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenamart import fixed_values as fv
from arenamart import schemas
from arenamart.functions.columns import json_kind
from arenamart.functions.relations import latest_per_key, without_keys
from arenamart.session import fresh_path

# The document name is the file name without its extension.
FILE_STEM = r"([^/]+?)(\.[^./]*)?$"

# Bronze tables and their place below a data folder: (table, glob, one row per file).
LAYOUT = [
    ("matches", "proMatches/*.json", True),
    ("leagues", "leagues/leagues.json", False),
    ("players", "proPlayers/proPlayers.json", False),
    ("teams", "teams/teams.json", False),
    ("hero_stats", "heroStats/heroStats.json", False),
    ("constants", "constants/*.json", True),
]


def read_files(
    spark: SparkSession, path: str, name_pattern: str = FILE_STEM, known: DataFrame | None = None
) -> DataFrame:
    """One row per file: ``name``, ``path`` and the whole text as ``value``.

    Spark packs many small files into one task. With ``known`` (names in its first column) the files
    are listed first, and only those with another name are opened.
    """
    if known is not None:
        listed = spark.read.format("binaryFile").load(path).select("path")
        names = listed.select(F.regexp_extract("path", name_pattern, 1).alias("name"), "path")
        # Spark's file index holds all paths of a scan on the driver anyway.
        fresh = [r["path"] for r in skip_existing(names, known).select("path").collect()]
        if not fresh:
            return spark.createDataFrame([], "name string, path string, value string")
        path = fresh
    return _whole_texts(spark, path).select(
        F.regexp_extract(F.col("_metadata.file_path"), name_pattern, 1).alias("name"),
        F.col("_metadata.file_path").alias("path"),
        "value",
    )


def _whole_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The files of a path. Those of a folder that fit a pattern are picked from one listing of the folder,
    as Spark would look up each of them as a path of its own."""
    if isinstance(path, str):
        folder, _, pattern = path.rpartition("/")
        if set("*?[{") & set(pattern):
            found = spark.read.option("pathGlobFilter", pattern).text(folder, wholetext=True)
            if not found.isEmpty():
                return found
    return spark.read.text(path, wholetext=True)


def skip_existing(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files whose name is not the key of a loaded document."""
    return without_keys(files, F.col("name"), known.select(F.col(known.columns[0]).cast("string")))


def strip_payload_field(payload: Column, field: str = fv.FETCH_STAMP) -> Column:
    """JSON object text without one top-level field; other kinds pass unchanged.

    Values are carried as JSON text and re-encoded only at the top level. A document that does not
    hold the field name at all, the usual case, is not parsed.
    """
    entries = F.from_json(payload, T.MapType(T.StringType(), T.VariantType()))
    kept = F.to_json(F.map_filter(entries, lambda k, _: k != field), {"ignoreNullFields": "false"})
    present = payload.contains(f'"{field}"') & (json_kind(payload) == "object")
    return F.when(present, F.coalesce(kept, payload)).otherwise(payload)


def _field(payload: Column, key: str) -> Column:
    return F.get_json_object(payload, f"$.{key}")


def documents_by_key(
    files: DataFrame, key: str, key_type: str = "string", loaded_at: Column | None = None
) -> DataFrame:
    """One bronze row per file. The key is the document's own field, else the file name.

    File path and position are kept, for ``last_per_key`` to tell which of several comes last.
    """
    value = F.col("value")
    own = F.when(json_kind(value) == "object", _field(value, key))
    return files.select(
        F.coalesce(own, F.col("name")).cast(key_type).alias(key),
        F.when(own.isNotNull(), strip_payload_field(value)).otherwise(value).alias("payload"),
        (loaded_at if loaded_at is not None else F.current_timestamp()).alias("loaded_at"),
        *[c for c in ("path",) if c in files.columns],
        F.lit(0).alias("at"),
    )


def array_records(files: DataFrame) -> DataFrame:
    """One row per element of an array document, as JSON text; a lone object counts as one."""
    value = F.col("value")
    listed = F.when(json_kind(value) == "array", F.from_json(value, "array<string>")).otherwise(
        F.array(value)
    )
    return files.select(
        *[c for c in files.columns if c != "value"], F.posexplode(listed).alias("at", "record")
    )


def elements_by_key(
    files: DataFrame, key: str, key_type: str = "string", loaded_at: Column | None = None
) -> DataFrame:
    """One bronze row per array element that is an object with the key.

    File path and position are kept, for ``last_per_key`` to tell which of several comes last.
    """
    record = F.col("record")
    return (
        array_records(files)
        .where(json_kind(record) == "object")
        .select(
            _field(record, key).cast(key_type).alias(key),
            strip_payload_field(record).alias("payload"),
            (loaded_at if loaded_at is not None else F.current_timestamp()).alias("loaded_at"),
            *[c for c in ("path",) if c in files.columns],
            "at",
        )
        .where(F.col(key).isNotNull())
    )


def resource_documents(files: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """One bronze row per constants file, keyed by its name."""
    return documents_by_key(files, "resource", "string", loaded_at)


def is_readable(payload: Column) -> Column:
    """Whether a payload is valid JSON, to set broken documents aside before parsing."""
    return F.try_parse_json(payload).isNotNull()


def last_per_key(rows: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """One row per key, the last by ``order``.

    Documents are large and keys rarely repeat. Only rows whose key does repeat are aggregated; the
    others pass by an anti join with the few repeated keys.
    """
    repeated = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)
    single = without_keys(rows, F.col(key), repeated).select(key, *values)
    several = rows.join(repeated, key, "left_semi")
    return single.unionByName(latest_per_key(several, [key], order, values))


def load_folder(
    spark: SparkSession,
    data_dir: str,
    existing: dict[str, DataFrame] | None = None,
    layout: list[tuple[str, str, bool]] = LAYOUT,
) -> dict[str, DataFrame]:
    """Bronze tables of a data folder, merged into existing ones.

    Matches never change, so files of loaded matches are not opened, and the table ``matches`` of the
    result then holds the new ones only, to be appended; all other records replace the stored ones of
    the same key. The files are read once, into a stored table that the winner per key is picked from.
    Documents that are no valid JSON are set aside in the table ``quarantine`` (table, path, value).
    """
    existing = existing or {}
    out, broken = {}, []
    for table, glob, per_file in layout:
        key, kind = schemas.BRONZE_KEYS[table]
        old = existing.get(table)
        known = old.select(key) if old is not None and table == "matches" else None
        files = read_files(spark, f"{data_dir.rstrip('/')}/{glob}", known=known)
        staged = f"{fresh_path(spark, 'load')}/{table}"
        files.withColumn("readable", is_readable(F.col("value"))).write.partitionBy("readable").parquet(staged)
        files = spark.read.schema("name string, path string, value string, readable boolean").parquet(staged)
        broken.append(files.where("not readable").select(F.lit(table).alias("table"), "path", "value"))
        make = documents_by_key if per_file else elements_by_key
        new = make(files.where("readable").drop("readable"), key, kind)
        new = last_per_key(new, key, ["path", "at"], ["payload", "loaded_at"])
        out[table] = new if old is None or table == "matches" else upsert_by_key(old, new, key)
    out["quarantine"] = reduce(DataFrame.unionByName, broken)
    return out


def upsert_by_key(stored: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Stored rows, with those replaced that come again. ``incoming`` has one row per key."""
    columns = stored.columns
    fresh = incoming.select(*columns)
    replaced = fresh.select(F.col(key).alias("__new"))
    untouched = stored.join(replaced, F.col(key) == F.col("__new"), "left_anti")
    return untouched.unionByName(fresh)


def read_csv_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)
