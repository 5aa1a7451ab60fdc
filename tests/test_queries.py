"""Every registered query against its oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from queries import all_oracles, all_queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return bytes(value).hex() if isinstance(value, (bytes, bytearray)) else value


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, "" if v is None else v) for v in r))


def test_every_query_of_the_catalog_has_an_oracle():
    assert set(all_oracles()) == set(all_queries())
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, tables, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    cursor = tables.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = [tuple(plain(r[i]) for i in at) for r in cursor.fetchall()]
    assert ordered(got) == ordered(want)


def test_entry(spark):
    assert driver.entry(spark).columns == ["node", "process", "total", "batches", "first_index"]
