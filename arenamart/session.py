"""Session settings the library is written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Shuffle files of a query go when it ends. Otherwise they stay until the driver collects garbage, and a
#: build of many tables holds those of all of them at once.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM only interprets methods above 8,000 bytes. A stage with such a method (dozens of typed player
    # fields in one row) runs as single operators instead, whose code comes in methods that it compiles.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    CLEANUP: "false",  # see apply_match_settings
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime options above on an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def apply_match_settings(spark: SparkSession) -> SparkSession:
    """The settings of the match part, whose frames are executed once each."""
    spark = apply_settings(spark)
    spark.conf.set(CLEANUP, "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, for tables that cut lineage.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset, as in tests on one
    machine, a local folder is chosen and recorded in the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        folder = tempfile.mkdtemp(prefix="arenamart-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; nothing is ever overwritten."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
