"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.catalog import QUERIES
from tools.check import TABLES, rows_of

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    result = entry.queries()[name](spark, SF)
    got = [tuple(row) for row in result.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    expected = db.execute(sql)
    columns = [column[0] for column in expected.description]
    assert sorted(columns) == sorted(result.columns)
    assert rows_of(result.columns, got) == rows_of(columns, expected.fetchall())


def test_entry_has_a_stable_schema(spark):
    assert entry.entry(spark).columns == entry.queries()["daily_sales_summary"](spark, SF).columns


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
