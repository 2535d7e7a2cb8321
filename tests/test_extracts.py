"""Lines kept aside, drift of fields, and counts from footers."""

from __future__ import annotations

import re

import pytest

from tillhouse.plans import suite
from tillhouse.sources import landing
from tillhouse.sources.footers import footer_view
from tillhouse.sources.raw_tables import RawTable

from .conftest import DATA

EVENTS = RawTable("raw_x.events", "id", ("id", "at", "kind", "gone"), "at")


@pytest.fixture
def extract(spark, tmp_path):
    def build(*lines):
        folder = tmp_path / "raw_x" / "events"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text("\n".join(lines))
        return landing.read_extract(spark, str(tmp_path), EVENTS)

    return build


def test_lines_are_rows_or_kept_aside(extract):
    found = extract(
        '{"id": 1, "at": "2001-01-01", "kind": {"n": [1, 2]}}',
        '{"id": "2", "kind": null, "colour": "red", "deep": {"a": 1.5}}',
        '{"id": "3", "at": "x"',
        "[1, 2]",
        '"text"',
        '{"kind": "no id"}',
        '{"id": null, "kind": "x"}',
        "",
        "  ",
        '{"id": true, "colour": 7}',
    )
    assert sorted(map(tuple, found.rows.collect()), key=str) == [
        ("1", "2001-01-01", '{"n":[1,2]}', None),
        ("2", None, None, None),
        ("true", None, None, None),
    ]
    assert sorted((r.problem, r.line) for r in found.bad.collect()) == [
        ("no key", '{"id": null, "kind": "x"}'),
        ("no key", '{"kind": "no id"}'),
        ("not JSON", '{"id": "3", "at": "x"'),
        ("not an object", '"text"'),
        ("not an object", "[1, 2]"),
    ]
    assert all(r.file.endswith("a.json") for r in found.bad.collect())


def test_drift_of_fields(extract):
    found = extract('{"id": 1, "new": 1}', '{"id": 2, "new": "x", "deep": {"a": [1.5], "b, c": 1}}', '{"id": 3, "deep": {"d": true}}')
    drift = {r.field: (r.type, r.rows, r.status) for r in found.drift().collect()}
    assert drift["id"] == ("BIGINT", 3, "known") and drift["at"] == (None, 0, "missing") == drift["gone"]
    assert drift["new"] == ("VARIANT", 2, "new")
    assert drift["deep"][1:] == (2, "new") and drift["deep"][0].startswith("OBJECT<a: ARRAY<DECIMAL(2,1)>") and "d: BOOLEAN" in drift["deep"][0]
    assert {r.id: str(r.fields) for r in found.unknown().selectExpr("id", "to_json(fields) AS fields").collect()} == {
        "1": '{"new":1}',
        "2": '{"deep":{"a":[1.5],"b, c":1},"new":"x"}',
        "3": '{"deep":{"d":true}}',
    }


def test_an_extract_of_nothing(extract):
    found = extract("")
    assert found.rows.count() == found.bad.count() == found.unknown().count() == 0
    assert {r.status for r in found.drift().collect()} == {"missing"}


def test_counts_come_from_footers(spark, tmp_path):
    spark.range(1000).selectExpr("id", "date_add(date'2001-01-01', cast(id AS int)) AS day").write.parquet(str(tmp_path / "t"))
    view = footer_view(spark, str(tmp_path / "t"), spark.read.parquet(str(tmp_path / "t")).schema)
    asked = view.selectExpr("count(*)", "max(day)", "min(id)")
    assert "PushedAggregation: [COUNT(*), MAX(day), MIN(id)]" in asked._jdf.queryExecution().executedPlan().toString()
    assert asked.first()[0] == 1000 and str(asked.first()[1]) == "2003-09-27"
    assert view.filter("id % 2 = 0").count() == 500
    assert "FileScan" in spark.read.parquet(str(tmp_path / "t"))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["d05_row_count_staging", "d05_row_count_mart", "d18_mart_table_counts", "d18_layout_by_month"])
def test_row_counts_open_no_row_group(spark, name):
    plan = suite.all_queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall("(?:BatchScan|FileScan).*", plan)
    assert scans and all("PushedAggregation: [COUNT(*)]" in scan for scan in scans)
