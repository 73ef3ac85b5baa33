"""Every registered query against its SQL counterpart."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def normalise(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_matches_sql(spark, oracle, name):
    frame = entry_module.queries()[name](spark, DATA)
    cursor = oracle.execute(entry_module.oracle_sql()[name])
    expected = normalise([d[0] for d in cursor.description], cursor.fetchall())
    actual = normalise(frame.columns, [tuple(r) for r in frame.collect()])
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    assert actual[1] == expected[1]


def test_every_query_has_sql():
    own = {n for n in entry_module.queries() if n != "pipeline" and not n.startswith("op")}
    assert own <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
