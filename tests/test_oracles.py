"""Every registered query against its SQL twin at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, name):
    frame = driver.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    found = sorted(repr([r[c] for c in columns]) for r in frame.collect())
    assert found
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    expected = sorted(repr([row[names.index(c)] for c in columns]) for row in result.fetchall())
    assert found == expected
