"""Every registered query against its SQL, on the test tables."""

import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_keys_agree():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    result = driver.queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    got = Counter(tuple(row) for row in result.select(*columns).collect())
    relation = duck.sql(driver.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    listed = ", ".join(f'"{column}"' for column in columns)
    want = Counter(duck.sql(f"SELECT {listed} FROM ({driver.oracle_sql()[name]})").fetchall())
    assert sum(want.values()) > 0
    assert got == want


def test_entry(spark):
    assert driver.entry(spark).count() == 4
