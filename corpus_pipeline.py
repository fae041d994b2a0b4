"""A corpus pipeline over documents: language, near copies, benchmark passages, mixture, token ids.

Every stage takes (spark, docs, sf_dir) and returns documents with the columns that it got; ``run``
writes each result as Parquet below the shared folder and reads it again for the next one. The last
stage returns one row per document of its token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arenamart.llm.common import read, stored
from arenamart.llm.decontaminate import remove_documents
from arenamart.llm.language import keep_known, learn
from arenamart.llm.mixing import mix
from arenamart.llm.near_dup import drop_near_duplicates
from arenamart.llm.token_output import token_files
from arenamart.session import apply_settings


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows; it is learned from their labels."""
    apply_settings(spark)
    return keep_known(docs, learn(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with 0.8 of its five-word shingles in common."""
    apply_settings(spark)
    return drop_near_duplicates(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ten words of the benchmark."""
    return remove_documents(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    apply_settings(spark)
    return mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the token files."""
    apply_settings(spark)
    # Behind four other stages an executor has less memory to spare than for the operator alone.
    return token_files(docs, pieces=1_000_000)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("tokens", tokens),
]
#: Learned languages and token files have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
