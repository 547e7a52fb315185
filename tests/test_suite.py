"""The driver contract, and every registered query against its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

import __spark_entry__ as contract
import check

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_names():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert check.compare(df, duck.execute(ORACLES[name])).startswith("ok")
    else:
        assert df.count() >= 0
