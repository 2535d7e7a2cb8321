"""A stream's first rows: repeats, late rows, bounded state, batches run again."""

from __future__ import annotations

import json
import os

import pandas as pd

from tillhouse.sources.raw_tables import RawTable
from tillhouse.streaming.first_rows import LATE, _sorter, first_rows, first_rows_stream, keyless_rows
from tillhouse.streaming.polling import landing_stream

EVENTS = RawTable("raw_x.events", "id", ("id", "at", "kind"), "at")
HOUR = 3600


def at(hour):
    return f"2001-01-{1 + hour // 24:02d} {hour % 24:02d}:00:00"


def test_out_of_order_batches(spark, tmp_path):
    folder = tmp_path / "landing" / "raw_x" / "events"
    folder.mkdir(parents=True)
    batches = [
        [("a", at(50), "1"), ("b", at(52), "1"), ("a", at(50), "1"), (None, at(51), "no key")],
        [("a", at(53), "2"), ("c", at(49), "late but in the span"), ("d", at(10), "too late"), ("e", "soon", "no moment")],
        [("f", at(200), "1"), ("b", at(52), "late repeat")],
        [("b", at(52), "late repeat"), ("a", at(201), "again, long after"), ("d", at(11), "too late, again"), ("g", at(199), "1")],
    ]

    def run():
        stream = landing_stream(spark, str(tmp_path / "landing"), EVENTS, files_per_batch=1)
        first_rows_stream(stream, EVENTS, str(tmp_path / "out"), str(tmp_path / "progress"), 10 * HOUR, buckets=2).awaitTermination()

    for i, batch in enumerate(batches):
        path = folder / f"{i}.json"
        path.write_text("\n".join(json.dumps(dict(zip(EVENTS.columns, row))) for row in batch))
        os.utime(path, (1_000_000_000 + i, 1_000_000_000 + i))
        if i in (1, 3):
            run()
    run()
    found = {r.id: (r.kind, r[2]) for r in first_rows(spark, EVENTS, str(tmp_path / "out")).toDF("id", "at", "text", "kind").selectExpr("id", "kind", "text").collect()}
    assert set(found) == set("abcdefg")
    assert found["a"] == ("first", "1") and found["b"] == ("first", "1") and found["c"] == ("first", "late but in the span")
    assert found["d"] == (LATE, "too late") and found["e"] == (LATE, "no moment") and found["g"][0] == "first"
    assert [r.kind for r in keyless_rows(spark, EVENTS, str(tmp_path / "out")).collect()] == ["no key"]


class State:
    def __init__(self):
        self.value = None

    @property
    def exists(self):
        return self.value is not None

    @property
    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_the_state_holds_the_span_only():
    state, sort_out, kept = State(), _sorter("id", 100), []
    for batch in range(200):
        rows = pd.DataFrame({"id": [f"k{batch * 10 + i}" for i in range(10)], "_micros": [batch * 20 + i for i in range(10)], "_line": 0, "_bucket": 0})
        kept += [len(x) for x in sort_out((0,), [rows], state)]
        assert len(state.value[0]) <= 60
    assert kept == [10] * 200
