"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from check import difference, normal, type_difference
from checks.registered import QUERIES, TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    result = contract.queries()[name](spark, FOLDER)
    rows = result.toPandas()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    assert difference(normal(rows), normal(db.execute(sql).fetchdf())) is None
    assert type_difference(db, sql, result) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 100
