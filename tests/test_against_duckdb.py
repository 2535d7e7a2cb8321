"""Every registered query against its DuckDB query on the smallest data set, value by value."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from oracles import suite as checks
from tillhouse.plans import suite

from .conftest import DATA

QUERIES = suite.all_queries()
SQL = checks.all_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    assert not isinstance(value, decimal.Decimal), "decimals must reach the reader as doubles"
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    return float(value)


def ordered(rows, columns, wanted):
    positions = [columns.index(c) for c in wanted]
    return sorted(([plain(row[i]) for i in positions] for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(name, spark, duck):
    result = QUERIES[name](spark, DATA)
    assert len(set(result.columns)) == len(result.columns)
    found = duck.execute(SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(result.columns)
    wanted = sorted(columns)
    expected = ordered(found.fetchall(), columns, wanted)
    actual = ordered([tuple(r) for r in result.collect()], result.columns, wanted)
    assert actual == expected


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.count() > 0
    assert "total_revenue" in result.columns
