"""The operators that SQL can express, on whole tables of the smallest data set."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from tests.conftest import DATA
from tests.test_against_duckdb import ordered
from tillhouse.llm import oracles, queries

SQL = oracles.all_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", list(SQL))
def test_same_rows(name, spark, duck):
    result = queries.all_queries()[name](spark, DATA)
    found = duck.execute(SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(result.columns)
    wanted = sorted(columns)
    assert ordered([tuple(r) for r in result.collect()], result.columns, wanted) == ordered(found.fetchall(), columns, wanted)
