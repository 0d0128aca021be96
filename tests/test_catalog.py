"""All batch queries against their SQL on the small tables."""

import duckdb
import pytest

import __spark_entry__ as registry
import check
from logweave.catalog import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM "
                           f"read_parquet('{FOLDER}/{t}.parquet')")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(registry.queries())
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).columns == ["key", "value", "seq"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    verdict, _ = check.compare(spark, duck, name, FOLDER)
    assert verdict.startswith("ok"), verdict
