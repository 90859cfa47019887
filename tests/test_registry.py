"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from workload import oracle
from workload.check import TABLES, compare
from workload.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert REGISTRY.keys() == oracle.oracle_sql().keys()
    assert REGISTRY.keys() <= driver.queries().keys()
    assert REGISTRY.keys() <= driver.oracle_sql().keys()


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns[0] == "series_id" and result.count() == 2


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, SF_DIR).startswith("ok")
