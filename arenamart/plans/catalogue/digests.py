"""Digests of whole tables, and of declared checks, that Spark and SQL compute alike.

A cell is the hash of its column's name and its value as text, a row the sum of its cells, a table the
number of its rows and the sum of their squares. The square ties the cells of a row together, while the
order of rows and columns plays no part. Texts that look like numbers are hashed by their value to six digits.
Rows go to the hash in Arrow batches, where a value that comes again in a column is written and hashed once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenamart.operators.checks import DECLARED_CHECKS, Check
from arenamart.plans.catalogue.oracle_tables import PRELUDE
from arenamart.plans.catalogue.support import publish

NUMBER = r"^-?[0-9]{1,15}([.][0-9]+)?([eE][-+]?[0-9]{1,2})?$"


def _exact(field: T.StructField) -> Column:
    """A value as text, numbers to six digits; a number is not read back from its own text.

    Integers stay as they are until they are hashed.
    """
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.LongType):
        return value
    text = value.cast("string")
    if isinstance(field.dataType, T.BooleanType):
        return text
    if isinstance(field.dataType, T.DoubleType):
        plain = (value == 0) | F.abs(value).between(1e-99, 9.999999999999999e99)
        return F.when(plain, value.cast("decimal(30,6)").cast("string")).otherwise(text)
    number = F.when(text.rlike(NUMBER), text.cast("double").cast("decimal(30,6)").cast("string"))
    return F.coalesce(number, text)


def _written(values: pa.Array) -> list[str]:
    """Texts of distinct values without null; integers of up to 15 digits like other numbers."""
    if not pa.types.is_integer(values.type):
        return values.to_pylist()
    return [f"{v}.000000" if -(10**15) < v < 10**15 else str(v) for v in values.to_pylist()]


def _cells(name: str, column: pa.Array) -> np.ndarray:
    """The first 28 bits of the MD5 sum of ``name=value`` for every value, 0 for null."""
    coded = column.dictionary_encode()
    sums = [hashlib.md5(f"{name}={text}".encode(), usedforsecurity=False).digest()[:4] for text in _written(coded.dictionary)]
    found = np.append(np.frombuffer(b"".join(sums), ">u4").astype(np.int64) >> 4, 0)
    return found[coded.indices.fill_null(len(sums)).to_numpy(zero_copy_only=False)]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of rows and exact sum of their squares, for each batch."""
    for batch in batches:
        row = np.zeros(batch.num_rows, np.int64)
        for name, column in zip(batch.schema.names, batch.columns):
            row += _cells(name, column)
        high, low = row >> 18, row & (2**18 - 1)  # no sum of their products leaves 64 bits
        squares = (int(high @ high) << 36) + (int(high @ low) << 19) + int(low @ low)
        yield pa.record_batch(
            [pa.array([batch.num_rows], pa.int64()), pa.array([Decimal(squares)], pa.decimal128(38, 0))], ["n", "squares"]
        )


def table_digests(tables: dict[str, DataFrame]) -> DataFrame:
    """table, rows, digest of each table; one scan each."""
    parts = []
    for name, df in tables.items():
        rows = publish(df)
        typed = rows.select(*[_exact(f).alias(f.name) for f in rows.schema.fields])
        found = typed.mapInArrow(_sums, "n bigint, squares decimal(38,0)").agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("squares"), F.lit(0)).cast("string").alias("digest"),
        )
        parts.append(found.select(F.lit(name).alias("table"), "rows", "digest"))
    return reduce(DataFrame.unionByName, parts)


def digests_sql(tables: dict[str, str]) -> str:
    """The same from the SQL of each table."""
    exact = f"CASE WHEN regexp_matches(x, '{NUMBER}') THEN CAST(CAST(CAST(x AS DOUBLE) AS DECIMAL(30,6)) AS VARCHAR) ELSE x END"
    cell = f"CAST('0x' || substr(md5(c || '=' || ({exact})), 1, 7) AS HUGEINT)"
    parts = [
        f"""SELECT '{name}' AS "table", (SELECT count(*) FROM t_{name}) AS "rows", CAST(coalesce(sum(v * v), 0) AS VARCHAR) AS digest
  FROM (SELECT sum({cell}) AS v FROM (UNPIVOT t_{name} ON COLUMNS(* EXCLUDE (r_o_w)) INTO NAME c VALUE x) GROUP BY r_o_w)"""
        for name in tables
    ]
    frames = [
        f"t_{name} AS (SELECT row_number() OVER () AS r_o_w, CAST(COLUMNS('(.*)') AS VARCHAR) AS '\\1' FROM ({sql}))" for name, sql in tables.items()
    ]
    return PRELUDE.rstrip().rstrip(",") + ",\n" + ",\n".join(frames) + "\n" + "\nUNION ALL ".join(parts)


def _check_sql(check: Check) -> str:
    t, c = f"k_{check.table}", f'"{check.column}"'
    if check.kind == "not_null":
        failing = f"SELECT 1 FROM {t} WHERE {c} IS NULL"
    elif check.kind == "unique":
        failing = f"SELECT 1 FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    elif check.kind == "unique_combination":
        failing = f"SELECT 1 FROM {t} GROUP BY {', '.join(check.values)} HAVING count(*) > 1"
    elif check.kind == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in check.values)
        failing = f"SELECT 1 FROM {t} WHERE {c} NOT IN ({listed})"
    elif check.kind == "relationships":
        parent, key = check.parent
        failing = f"SELECT 1 FROM {t} WHERE {c} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM k_{parent} p WHERE p.\"{key}\" = {t}.{c})"
    elif check.kind == "seq_in_range":
        failing = f"SELECT 1 FROM {t} WHERE {c} < 1"
    else:
        failing = (
            f"SELECT 1 WHERE (SELECT max(slot) FROM {t}) < (SELECT max(n) FROM"
            f" (SELECT count(*) AS n FROM k_{check.parent[0]} GROUP BY match_id, active_team, is_pick))"
        )
    return f"SELECT '{check.name}' AS \"check\", count(*) AS failing FROM ({failing})"


def checks_sql(tables: dict[str, str]) -> str:
    """Number of failing rows (or values, or keys) of every declared check on these tables."""
    usable = [c for c in DECLARED_CHECKS if c.table in tables and (not c.parent[0] or c.parent[0] in tables)]
    frames = [f"k_{name} AS MATERIALIZED ({sql})" for name, sql in tables.items()]
    return PRELUDE.rstrip().rstrip(",") + ",\n" + ",\n".join(frames) + "\n" + "\nUNION ALL ".join(map(_check_sql, usable))
