"""Merging in place: rows as by the plain upsert, touched slices only, no exchange of what is stored."""

from __future__ import annotations

import random
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillhouse.sources import landing
from tillhouse.sources.keyed_store import SLICE, KeyedStore
from tillhouse.sources.raw_tables import EXTRACTED_AT, RawTable

EVENTS = RawTable("raw_x.events", "id", ("id", "at", "kind"), "at")
SCHEMA = "id string, at string, kind string"


def files(path):
    return {f: f.stat().st_mtime_ns for f in Path(path).rglob("part-*.parquet")}


def rows_of(frame):
    return sorted((r.id, r.at, r.kind, str(r[EXTRACTED_AT])) for r in frame.collect())


@pytest.fixture
def store(spark, tmp_path):
    return KeyedStore(spark, str(tmp_path), slices=16, buckets=4)


def test_loads_equal_the_plain_upsert(store, frame):
    draw = random.Random(1)
    current, day = None, 0
    for load in range(4):
        day += 1
        rows = [(f"k{draw.randrange(120)}", f"2001-01-{draw.randrange(1, 28):02} 00:00:00", f"v{load}-{i}") for i in range(60)]
        at = datetime(2001, 2, 10 - day if load == 2 else 10 + day)  # the third extract is older than the second
        incoming = landing.stamp(frame(SCHEMA, *rows), at)
        store.merge(EVENTS, incoming, str(load))
        current = landing.upsert(incoming.limit(0) if current is None else current, incoming, EVENTS)
        assert rows_of(store.read(EVENTS)) == rows_of(current), load


def test_other_slices_keep_their_files(store, frame):
    store.replace(EVENTS, landing.stamp(frame(SCHEMA, *[(f"k{i}", None, "old") for i in range(300)]), datetime(2001, 1, 1)), "0")
    before = files(store.path(EVENTS))
    assert len(before) == 16  # a slice is one file
    touched = store.merge(EVENTS, landing.stamp(frame(SCHEMA, ("k7", None, "new"), ("brand new", None, "new")), datetime(2001, 1, 2)), "1")
    assert 1 <= len(touched) <= 2
    after = files(store.path(EVENTS))
    assert {f.parent.name for f in before.keys() ^ after.keys()} == {f"{SLICE}={s}" for s in touched}
    assert all(before[f] == after[f] for f in before.keys() & after.keys())
    assert {(r.id, r.kind) for r in store.read(EVENTS).filter("kind = 'new'").collect()} == {("k7", "new"), ("brand new", "new")}
    assert store.read(EVENTS).count() == 301


def test_stored_rows_are_not_shuffled(store, frame):
    store.replace(EVENTS, landing.stamp(frame(SCHEMA, *[(f"k{i}", None, "old") for i in range(50)]), datetime(2001, 1, 1)), "0")
    incoming = store._split(EVENTS, landing.stamp(frame(SCHEMA, ("k1", None, "new")), datetime(2001, 1, 2)), "1")
    plan = store.merged(EVENTS, incoming, [3, 5])._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("FullOuter") :]
    stored = stored[: stored.index("FileScan")]
    assert "Exchange" not in stored and plan.count("Exchange hashpartitioning") == 1
    assert "PartitionFilters: [" in plan and f"{SLICE}" in plan and "Bucketed: true" in plan


def test_null_keys_missing_columns_and_empty_loads(store, frame):
    store.replace(EVENTS, landing.stamp(frame(SCHEMA, ("a", "x", "1"), (None, "y", "2"), (None, "z", "3")), datetime(2001, 1, 1)), "0")
    store.merge(EVENTS, landing.stamp(frame("id string, kind string, extra string", ("b", "4", "e"), (None, "5", "e")), datetime(2001, 1, 2)), "1")
    for _ in range(2):
        assert store.merge(EVENTS, landing.stamp(frame(SCHEMA), datetime(2001, 1, 3)), "2") == []
    assert {(r.id, r.at, r.kind) for r in store.read(EVENTS).collect()} == {("a", "x", "1"), ("b", None, "4")}
    assert sorted((r._load, r.kind) for r in store.keyless(EVENTS).collect()) == [("0", "2"), ("0", "3"), ("1", "5")]
    store.replace(EVENTS, landing.stamp(frame(SCHEMA, ("c", None, None)), datetime(2001, 1, 4)), "3")
    assert [r.id for r in store.read(EVENTS).collect()] == ["c"]


def test_a_table_is_found_again_from_its_files(store, spark, frame):
    store.replace(EVENTS, landing.stamp(frame(SCHEMA, ("a", None, "1"), ("b", None, "1")), datetime(2001, 1, 1)), "0")
    spark.sql(f"DROP TABLE {store._registered(EVENTS)}")
    again = KeyedStore(spark, store.root, slices=16, buckets=4)
    again.merge(EVENTS, landing.stamp(frame(SCHEMA, ("b", None, "2")), datetime(2001, 1, 2)), "1")
    assert {(r.id, r.kind) for r in again.read(EVENTS).collect()} == {("a", "1"), ("b", "2")}
    with pytest.raises(ValueError):
        KeyedStore(spark, store.root, slices=10, buckets=4)


def test_a_load_run_again_changes_nothing(store, frame):
    store.replace(EVENTS, landing.stamp(frame(SCHEMA, *[(f"k{i}", None, "old") for i in range(40)]), datetime(2001, 1, 1)), "0")
    load = landing.stamp(frame(SCHEMA, ("k1", "a", "x"), ("k1", "b", "y"), ("new", None, "z")), datetime(2001, 1, 2))
    store.merge(EVENTS, load, "1")
    once = rows_of(store.read(EVENTS))
    store.merge(EVENTS, load, "1")
    assert rows_of(store.read(EVENTS)) == once and len(once) == 41
