"""Merging, schema drift, batches on disk, streaming, export."""

from __future__ import annotations

import json
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillhouse.plans.charts import ChartMetric, kpi_query
from tillhouse.plans.quality import freshness, scan_table, select_rules, unpaired_clock_events
from tillhouse.plans.quality import Rule, check_unique, orphans
from tillhouse.plans.warehouse import Warehouse, build_order, shared_models
from tillhouse.sources import landing
from tillhouse.sources.export import delivery_complete, export_report
from tillhouse.sources.order_book import OrderBookSource
from tillhouse.sources.raw_tables import RAW_TABLES, RawTable
from tillhouse.streaming.polling import landing_stream, load_stream

from .conftest import DATA

EVENTS = RawTable("raw_x.events", "id", ("id", "at", "kind"), "at")
MEMBERS = RawTable("raw_x.members", "id", ("id", "name"))


def stamped(frame, at):
    return landing.stamp(frame, at)


def test_registry_shape():
    assert len(RAW_TABLES) == 27
    assert sum(t.incremental for t in RAW_TABLES.values()) == 7


def test_upsert_same_key_twice_later_load_new_and_missing_column(frame):
    current = stamped(frame("id string, at string, kind string", ("1", "2000-12-30", "old"), ("2", "2000-12-31", "kept")), datetime(2001, 1, 1))
    incoming = stamped(
        frame("id string, kind string, extra string", ("1", "x", "e"), ("1", "y", "e"), ("3", "new", "e")), datetime(2001, 1, 2)
    )
    merged = landing.upsert(current, incoming, EVENTS)
    assert merged.columns == current.columns
    found = {r.id: (r.at, r.kind) for r in merged.collect()}
    assert found.pop("1") in ((None, "x"), (None, "y"))  # either version of one load, the same on every run
    assert found == {"2": ("2000-12-31", "kept"), "3": (None, "new")}
    earlier = stamped(frame("id string, at string, kind string", ("2", "2001-01-05", "stale")), datetime(2000, 1, 1))
    assert {r.id: r.kind for r in landing.upsert(current, earlier, EVENTS).collect()}["2"] == "kept"
    nothing = incoming.limit(0)
    assert landing.upsert(current, nothing, EVENTS).count() == 2


def test_incremental_window_and_first_load(frame):
    rows = frame("id string, at string, kind string", *[(str(i), f"2001-01-{i:02d} 00:00:00", "k") for i in range(1, 11)])
    now = datetime(2001, 1, 9)
    newest = datetime(2001, 1, 3)
    assert sorted(r.id for r in landing.incremental(rows, newest, EVENTS, now).collect()) == ["3", "4", "5", "6", "7", "8", "9"]
    assert landing.incremental(rows, None, EVENTS, now).count() == 9
    assert landing.incremental(rows, F.lit(None).cast("timestamp"), EVENTS, now).count() == 9
    old = frame("id string, at string, kind string", ("1", "1969-12-31 00:00:00", "k"))
    assert landing.incremental(old, None, EVENTS, now).count() == 1  # a first load has no lower bound
    explicit = landing.incremental(rows, newest, EVENTS, now, datetime(2001, 1, 1), datetime(2001, 1, 2))
    assert explicit.count() == 2


def test_text_form_and_conform(frame, spark):
    nested = frame("id bigint, tags array<string>, deep struct<a:int>", (1, ["x"], (2,)))
    row = landing.as_text(nested).first()
    assert tuple(row) == ("1", '["x"]', '{"a":2}')
    shaped = landing.conform(landing.as_text(nested), ["id", "missing"])
    assert shaped.columns == ["id", "missing"] and shaped.first().missing is None


def test_schema_action():
    assert landing.schema_action(None, EVENTS) == "create"
    assert landing.schema_action(["other"], EVENTS) == "recreate"
    assert landing.schema_action(["id"], EVENTS) == "keep"


def test_full_tables_show_the_newest_complete_batch(frame, spark, tmp_path):
    store = landing.RawStore(spark, str(tmp_path))
    assert store.read(MEMBERS) is None
    store.load(MEMBERS, frame("id string, name string", ("1", "a"), ("2", "b")), datetime(2001, 1, 1))
    store.load(MEMBERS, frame("id string, name string", ("1", "c")), datetime(2001, 1, 2))
    # A load that wrote its rows but never finished.
    frame("id string, name string", ("9", "broken")).write.parquet(f"{store.path(MEMBERS)}/_batch=20010103T000000000000")
    assert [(r.id, r.name) for r in store.read(MEMBERS).collect()] == [("1", "c")]


def test_incremental_tables_merge_and_compact(frame, spark, tmp_path):
    store = landing.RawStore(spark, str(tmp_path))
    schema = "id string, at string, kind string"
    store.load(EVENTS, frame(schema, ("1", "2001-01-01 00:00:00", "a"), ("2", "2001-01-02 00:00:00", "b")), datetime(2001, 1, 3))
    later = frame(schema, ("2", "2001-01-04 00:00:00", "c"), ("3", "2001-01-05 00:00:00", "d"), ("0", "2000-12-31 00:00:00", "late"))
    for _ in range(2):  # a repeated load replaces itself
        store.load(EVENTS, later, datetime(2001, 1, 6))
    expected = {("1", "a"), ("2", "c"), ("3", "d")}
    assert {(r.id, r.kind) for r in store.read(EVENTS).collect()} == expected
    store.compact(EVENTS, datetime(2001, 1, 7))
    assert store.live(EVENTS) == ["20010107T000000000000"]
    assert {(r.id, r.kind) for r in store.read(EVENTS).collect()} == expected
    assert store.newest(EVENTS) == datetime(2001, 1, 5)
    plan = store.read(EVENTS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and re.search(r"PartitionFilters: \[[^]]*_batch", plan)
    wrong = spark.createDataFrame([("z",)], "unrelated string")
    store.write_batch(EVENTS, wrong, "20010108T000000")
    assert {(r.id, r.kind) for r in store.read(EVENTS).collect()} == expected


def test_stream_over_several_files(spark, tmp_path):
    landing_folder = tmp_path / "landing" / "raw_x" / "events"
    landing_folder.mkdir(parents=True)

    def deliver(name, *rows):
        (landing_folder / name).write_text("\n".join(json.dumps(r, separators=(",", ":")) for r in rows))

    def run():
        store = landing.RawStore(spark, str(tmp_path / "raw"))
        stream = landing_stream(spark, str(tmp_path / "landing"), EVENTS, files_per_batch=1)
        load_stream(stream, store, EVENTS, str(tmp_path / "progress")).awaitTermination()
        return {(r.id, r.kind) for r in store.read(EVENTS).collect()}

    deliver("a.json", {"id": "1", "at": "2001-01-01T00:00:00", "kind": {"n": 1}}, {"id": "2", "at": "2001-01-01T01:00:00", "kind": "b"})
    assert run() == {("1", '{"n":1}'), ("2", "b")}
    deliver("b.json", {"id": "2", "at": "2001-01-01T01:00:00", "kind": "b"}, {"id": "2", "at": "2001-01-01T02:00:00", "kind": "c"})
    assert run() == {("1", '{"n":1}'), ("2", "c")}
    assert run() == {("1", '{"n":1}'), ("2", "c")}
    deliver("c.json", {"id": "3", "at": "1990-01-01T00:00:00", "kind": "very late"})
    assert run() == {("1", '{"n":1}'), ("2", "c"), ("3", "very late")}


def test_export_and_delivery(spark, params, tmp_path):
    house = Warehouse(OrderBookSource(spark, DATA), params)
    day = date(2001, 8, 2)
    assert not any(r.complete for r in delivery_complete(spark, house.table, str(tmp_path), day).collect())
    files = export_report(spark, house.table, str(tmp_path), day, datetime(2001, 8, 2, 6))
    assert len(files) == 8 and files[0]["rows"] == house.table("mart_daily_revenue").count()
    assert all(r.complete for r in delivery_complete(spark, house.table, str(tmp_path), day).collect())
    manifest = json.loads(spark.read.text(f"{tmp_path}/exec-report/{day}/manifest.json").first().value)
    assert [f["rows"] for f in manifest["files"]] == [f["rows"] for f in files]


def test_nothing_is_cut(spark, tmp_path):
    """More than 10,000 groups and rows reach the chart, the file and the manifest."""
    wide = spark.range(12_345).select(F.col("id").cast("string").alias("g"), F.col("id").alias("v"))
    assert kpi_query(wide, [ChartMetric("SUM", "v")], ["g"]).count() == 12_345
    files = export_report(spark, lambda name: wide, str(tmp_path), date(2001, 8, 2), datetime(2001, 8, 2, 6))
    assert {f["rows"] for f in files} == {12_345}
    found = delivery_complete(spark, lambda name: wide, str(tmp_path), date(2001, 8, 2)).collect()
    assert {(r.mart_rows, r.file_rows, r.manifest_rows, r.complete) for r in found} == {(12_345, 12_345, 12_345, True)}
    part = sorted((tmp_path / "exec-report" / "2001-08-02" / files[0]["key"].rsplit("/", 1)[1]).glob("part-*"))[0]
    part.unlink()
    found = delivery_complete(spark, lambda name: wide, str(tmp_path), date(2001, 8, 2)).collect()
    assert sum(not r.complete for r in found) == 1


def test_build_order_and_materialise(spark, params, tmp_path):
    names = [entry.name for entry in build_order(["mart_location_performance"])]
    assert names.index("stg_pos_transactions") < names.index("mart_daily_revenue") < names.index("mart_location_performance")
    assert {"int_pos_sales_enriched", "int_transport_enriched", "mart_department_performance"} <= shared_models()
    house = Warehouse(OrderBookSource(spark, DATA), params)
    before = house.table("mart_location_performance").count()
    written = Warehouse(OrderBookSource(spark, DATA), params).materialise(spark, str(tmp_path), ["mart_location_performance"])
    assert spark.read.parquet(written["mart_location_performance"]).count() == before


def test_rule_counts():
    found = {check: len(select_rules(check)) for check in ("unique", "not_null", "relationships", "accepted_values", "row_count", "between", "pair")}
    assert found == {
        "unique": 69, "not_null": 338, "relationships": 37, "accepted_values": 16, "row_count": 37, "between": 9, "pair": 3,
    }


def test_checks_count_failures(frame):
    data = frame("k string, v int, w int, s string", ("1", 1, 2, "a"), ("1", 5, None, "z"), (None, -1, -2, None), (None, None, 0, "a"))
    rules = [
        Rule("t", "not_null", "k"), Rule("t", "accepted_values", "s", ("a",)), Rule("t", "between", "v", ("0", "4")),
        Rule("t", "pair", "v", (">", "w")), Rule("t", "row_count", "*", ("1", "3")),
    ]
    assert [r.failures for r in scan_table(data, rules).collect()] == [2, 1, 2, 1, 1]
    assert check_unique(data, Rule("t", "unique", "k")).first().failures == 1
    parent = frame("k string", ("2",))
    assert orphans(data, "k", parent, "k").first().orphan_count == 2
    assert orphans(data, "k", parent, "k", count_null=True).first().orphan_count == 4


def test_unpaired_events_leave_out_today(frame):
    events = frame("employee_id string, event_date date, event_type string", ("E1", date(2001, 1, 1), "clock_in"), ("E1", date(2001, 1, 2), "clock_in"))
    assert [r.event_date for r in unpaired_clock_events(events, date(2001, 1, 2)).collect()] == [date(2001, 1, 1)]


def test_freshness_status(spark):
    def table(name):
        hours = {"raw_hr.locations": 1, "raw_hr.employees": 30, "raw_hr.schedules": 60}.get(name)
        at = None if hours is None else F.expr(f"timestamp'2001-01-10 00:00:00' - interval {hours} hours")
        return spark.range(1).select((F.lit(None).cast("timestamp") if at is None else at).alias("_sdc_extracted_at"))

    found = {f"{r.source}.{r.table}": r.status for r in freshness(table, datetime(2001, 1, 10)).collect()}
    assert found["raw_hr.locations"] == "pass" and found["raw_hr.employees"] == "warn" and found["raw_hr.schedules"] == "error"
    assert found["raw_pos.products"] == "error"
