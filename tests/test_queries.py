"""Every registered query against its SQL twin in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    rows = df.collect()
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows and len(set(df.columns)) == len(df.columns)
        return
    found = duck.execute(sql)
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in found.fetchall()), key=repr)
    mine = sorted((tuple(plain(r[c]) for c in order) for r in rows), key=repr)
    assert mine == theirs


def test_entry(spark):
    assert entry.entry(spark).columns == ["part", "n_pos", "n_neg", "auc"]


def test_every_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
