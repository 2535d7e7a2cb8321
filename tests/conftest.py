from __future__ import annotations

from datetime import date

import pytest

from tillhouse.plans.registry import MODELS, Params
from tillhouse.plans.warehouse import Warehouse
from tillhouse.session import local_session
from tillhouse.sources.raw_tables import RAW_TABLES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def params():
    return Params(as_of=date(2001, 8, 2))


@pytest.fixture
def raw(spark):
    """Raw tables from a few hand-written rows: `raw({"raw_pos.products": [dict, ...]})`; the rest are empty text tables."""

    def build(rows: dict[str, list[dict]]):
        def table(name: str):
            entry = RAW_TABLES[name]
            extra = sorted({k for row in rows.get(name, []) for k in row} - set(entry.columns))
            columns = [*entry.columns, *extra, "_sdc_extracted_at"]
            schema = ", ".join(f"`{c}` string" for c in columns)
            data = [tuple(None if row.get(c) is None else str(row[c]) for c in columns) for row in rows.get(name, [])]
            return spark.createDataFrame(data, schema)

        return table

    return build


@pytest.fixture
def warehouse(raw, params):
    def build(rows: dict[str, list[dict]] | None = None, using: Params | None = None) -> Warehouse:
        return Warehouse(raw(rows or {}), using or params)

    return build


@pytest.fixture
def frame(spark):
    """A DataFrame from a schema string and rows."""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)


def model(name: str):
    return MODELS[name].build
