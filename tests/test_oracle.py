"""Every registered query against its SQL, run by DuckDB on the same tables."""

import re

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
KINDS = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}
#: The text operators have tests of their own.
QUERIES = {k: q for k, q in entry.queries().items() if not re.match(r"op\d+_|pipeline$", k)}
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def in_order(rows):
    def key(row):
        return [(v is None, "" if v is None else v if isinstance(v, str) else repr(float(v))) for v in row]

    return sorted(rows, key=key)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = in_order([tuple(row[c] for c in columns) for row in df.collect()])
    if name not in SQL:
        assert got
        return
    result = duck.execute(SQL[name])
    at = {d[0]: i for i, d in enumerate(result.description)}
    assert sorted(at) == columns
    assert {d[0]: KINDS[str(d[1])] for d in result.description} == dict(df.dtypes)
    want = in_order([tuple(row[at[c]] for c in columns) for row in result.fetchall()])
    assert got == want


def test_flagship(spark):
    assert entry.entry(spark).count() > 100


def test_every_query_has_sql():
    assert not set(QUERIES) - set(SQL)
