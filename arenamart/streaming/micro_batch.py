"""Incremental loading as streams.

Bronze keeps the keys it has loaded as state of the stream, in the RocksDB state store, so that a batch
costs what its own documents cost, however many were loaded before. Silver parses a batch once, writes the
tables of all models and then one row that makes the batch visible in all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.utils import AnalysisException

from arenamart import schemas
from arenamart.operators.staging import (
    GRAINS,
    MATCH_MODELS,
    parse_matches,
    stg_match_player_damage_taken_type,
)
from arenamart.sources.documents import FILE_STEM, documents_by_key, is_readable, last_per_key
from arenamart.sources.sinks import batch_sink, before_batch, one_per_grain, unseen_rows
from arenamart.sources.versions import stored


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Where a stream finds its state store; the setting is read when the stream starts.
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def stream_bronze(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    table: str = "matches",
    name_pattern: str = FILE_STEM,
    files_per_batch: int = 10000,
) -> StreamingQuery:
    """Load new document files of a folder into a bronze table; known keys stay as they are.

    A file is opened once. A document whose key came before is dropped by the keyed state that belongs to
    ``checkpoint``; the file sink's own log makes a replayed batch a no-op. A new checkpoint over an old
    table starts from the keys of that table. Of documents of one key in one batch any one is taken.
    """
    key, kind = schemas.BRONZE_KEYS[table]
    files = (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select(
            F.regexp_extract(F.col("_metadata.file_path"), name_pattern, 1).alias("name"), "value"
        )
    )
    rows = documents_by_key(files.where(is_readable(F.col("value"))), key, kind)
    rows = rows.where(F.col(key).isNotNull()).select(key, "payload", "loaded_at")
    earlier = _keys_before(spark, target, checkpoint, key)
    if earlier is not None:
        rows = rows.join(earlier, key, "left_anti")
    return _started(
        spark, rows.dropDuplicates([key]).writeStream.format("parquet").option("path", target), checkpoint
    )


def _started(spark: SparkSession, stream: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Start a stream over what is there now, with its state in RocksDB."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before)


def _keys_before(spark: SparkSession, target: str, checkpoint: str, key: str) -> DataFrame | None:
    """Keys of a table that is older than the checkpoint, noted beside it when it is first used."""
    noted = f"{checkpoint.rstrip('/')}-earlier"
    if not _exists(spark, f"{checkpoint}/metadata") and stored(spark, noted) is None:
        table = stored(spark, target)
        if table is not None:
            table.select(key).write.parquet(noted)
    return stored(spark, noted)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def stream_silver(
    spark: SparkSession,
    bronze: str,
    target: str,
    checkpoint: str,
    model: str,
    constants: DataFrame | None = None,
) -> StreamingQuery:
    """Flatten matches that arrive in a bronze Parquet table into one silver table.

    A match is flattened once: which ones were is remembered beside the table, one folder per batch,
    so a match that is sent again is skipped whole and a replayed batch replaces its own folders.
    ``constants`` is needed by the model of typed damage.
    """
    flattened = dict(MATCH_MODELS)
    flattened["stg_match_player_damage_taken_type"] = lambda nested: stg_match_player_damage_taken_type(nested, constants)
    documents = (
        spark.readStream.schema(schemas.bronze_schema("matches"))
        .option("recursiveFileLookup", "true")
        .parquet(bronze)
    )

    def flatten(batch: DataFrame, number: int) -> None:
        once = last_per_key(batch, "match_id", ["loaded_at", "payload"], ["payload", "loaded_at"])
        known = before_batch(spark, f"{target}_matches", number)
        fresh = unseen_rows(once, known, ["match_id"])
        batch_sink(one_per_grain(flattened[model](parse_matches(fresh, model)), GRAINS[model]), target, number)
        batch_sink(fresh.select("match_id"), f"{target}_matches", number)

    return (
        documents.writeStream.foreachBatch(flatten)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: The table whose batches are the visible ones; it is written last.
VISIBLE = "flattened_matches"


def stream_silver_tables(
    spark: SparkSession, bronze: str, target: str, checkpoint: str, constants: DataFrame
) -> StreamingQuery:
    """Flatten matches that arrive in a bronze Parquet table into the tables of all match models.

    A batch is parsed once, into a stored nested table; the twelve silver tables are written from that,
    and the list of its matches last. ``silver_tables`` shows a batch only when that list stands, so a
    match is seen in all tables or in none. A match that comes again is dropped by the stream's state.
    """
    kinds = {
        **MATCH_MODELS,
        "stg_match_player_damage_taken_type": lambda n: stg_match_player_damage_taken_type(n, constants),
    }
    documents = (
        spark.readStream.schema(schemas.bronze_schema("matches"))
        .option("recursiveFileLookup", "true")
        .parquet(bronze)
    )

    def flatten(batch: DataFrame, number: int) -> None:
        parsed = f"{target}/nested_matches"
        batch_sink(parse_matches(batch), parsed, number)
        nested = spark.read.parquet(f"{parsed}/batch={number}")
        for name, model in kinds.items():
            batch_sink(one_per_grain(model(nested), GRAINS[name]), f"{target}/{name}", number)
        batch_sink(nested.select("match_id"), f"{target}/{VISIBLE}", number)

    once = documents.where("match_id is not null").dropDuplicates(["match_id"])
    return _started(spark, once.writeStream.foreachBatch(flatten), checkpoint)


def silver_tables(spark: SparkSession, target: str) -> dict[str, DataFrame]:
    """The silver tables of a stream, as far as their batches are complete."""
    visible = stored(spark, f"{target}/{VISIBLE}")
    if visible is None:
        return {}
    batches = visible.select("batch").distinct()
    found = {name: spark.read.parquet(f"{target}/{name}") for name in GRAINS}
    return {name: df.join(batches, "batch", "left_semi").drop("batch") for name, df in found.items()}
