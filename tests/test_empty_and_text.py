"""Empty tables keep their schema, and text raw tables give the same staging rows as typed ones."""

from __future__ import annotations

import pytest

from tillhouse.plans.registry import MODELS
from tillhouse.plans.warehouse import Warehouse
from tillhouse.sources.landing import as_text
from tillhouse.sources.order_book import OrderBookSource

from .conftest import DATA

STAGING = [name for name, entry in MODELS.items() if entry.layer == "staging"]
OTHERS = [name for name, entry in MODELS.items() if entry.layer != "staging"]


@pytest.fixture(scope="module")
def source(spark):
    return OrderBookSource(spark, DATA)


@pytest.mark.parametrize("name", STAGING)
def test_text_equals_typed(name, spark, params, source):
    typed = Warehouse(source, params).table(name)
    text = Warehouse(lambda n: as_text(source(n)), params).table(name)
    assert text.columns == typed.columns
    common = [c for c in typed.columns]
    left = typed.select(*[typed[c].cast("string") for c in common])
    right = text.select(*[text[c].cast("string") for c in common])
    assert left.exceptAll(right).count() == 0
    assert right.count() == left.count()


@pytest.mark.parametrize("name", OTHERS)
def test_empty_input(name, warehouse, params, source):
    empty = warehouse().table(name)
    assert empty.columns == Warehouse(source, params).table(name).columns
    rows = empty.collect()
    if name == "mart_loyalty_engagement":
        assert [(r.current_tier, r.total_members, r.points_liability) for r in rows] == [("ALL", 0, 0)]
    else:
        assert rows == []
