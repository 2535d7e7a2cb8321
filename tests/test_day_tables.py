"""Tables by day, reloads of some days, and the build."""

from __future__ import annotations

import re
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillhouse.operators.stock import mart_inventory_turnover
from tillhouse.plans import suite
from tillhouse.plans.charts import ChartMetric, kpi_query
from tillhouse.plans.day_tables import on_range, read_laid_out, reload_periods, write_laid_out
from tillhouse.plans.quality import unpaired_clock_events
from tillhouse.plans.registry import MODELS
from tillhouse.plans.warehouse import Warehouse, build_waves
from tillhouse.sources.order_book import OrderBookSource

from .conftest import DATA

DAY = "_day"
SCHEMA = "id int, at timestamp, v string"


def files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("part-*.parquet")}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_days(frame, spark, tmp_path):
    """Ten days of three rows, and a row without a moment."""
    rows = [(10 * d + i, datetime(2001, 3, d, 8 * i), "old") for d in range(1, 11) for i in range(3)] + [(999, None, "none")]
    table = frame(SCHEMA, *rows)
    path = str(tmp_path / "t")
    write_laid_out(table, path, "at")
    return path, table


def test_reload_rewrites_its_days_only(stored_days, frame, spark):
    path, table = stored_days
    before = files(path)
    new = frame(SCHEMA, (50, datetime(2001, 3, 5, 1), "new"), (77, datetime(2001, 3, 7), "other day"), (998, None, "none"))
    for _ in range(2):  # running it again changes nothing
        reload_periods(new, path, "at", date(2001, 3, 5), date(2001, 3, 6))
        found = {(r.id, r.v) for r in read_laid_out(spark, path, table.schema).collect()}
        kept = {(10 * d + i, "old") for d in range(1, 11) if d not in (5, 6) for i in range(3)}
        assert found == kept | {(50, "new"), (999, "none")}
    after = files(path)
    touched = {f for f in before.keys() | after.keys() if before.get(f) != after.get(f)}
    assert {f.split("/")[0] for f in touched} == {f"{DAY}=2001-03-05", f"{DAY}=2001-03-06"}


def test_a_range_opens_its_days_only(stored_days, spark):
    path, table = stored_days
    rows = read_laid_out(spark, path, table.schema)
    some = on_range(rows, "at", start=datetime(2001, 3, 4, 8), before=datetime(2001, 3, 6, 9))
    assert sorted(r.id for r in some.collect()) == [41, 42, 50, 51, 52, 60, 61]
    assert re.search(r"PartitionFilters: \[[^]]*_day[^]]*>=[^]]*_day[^]]*<=", plan(some))
    assert len(some.inputFiles()) >= 1
    opened = {re.search(rf"{DAY}=([^/]*)", f)[1] for f in (r[0] for r in some.select(F.input_file_name()).collect())}
    assert opened <= {"2001-03-04", "2001-03-05", "2001-03-06"}
    # Without the layout the rows are the same.
    assert sorted(r.id for r in on_range(table, "at", datetime(2001, 3, 4, 8), datetime(2001, 3, 6, 9)).collect()) == [41, 42, 50, 51, 52, 60, 61]
    assert on_range(rows, "at").count() == 31


def test_empty_table_and_empty_reload(frame, spark, tmp_path):
    empty = frame(SCHEMA, (1, None, "x")).filter("id > 1")
    path = str(tmp_path / "e")
    write_laid_out(empty, path, "at")
    assert read_laid_out(spark, path, empty.schema).columns == ["id", "at", "v", DAY]
    assert read_laid_out(spark, path, empty.schema).count() == 0
    reload_periods(empty, path, "at", date(2001, 1, 1), date(2001, 1, 2))
    assert read_laid_out(spark, path, empty.schema).count() == 0


@pytest.fixture(scope="module")
def monthly(spark, tmp_path_factory):
    """Some models of the given tables as tables, laid out by month."""
    house = Warehouse(OrderBookSource(spark, DATA), suite.PARAMS)
    root = str(tmp_path_factory.mktemp("monthly"))
    house.materialise(spark, root, MODELS["mart_inventory_turnover"].inputs + ("stg_timeclock_events", "stg_pos_transactions"))
    return house, root


def test_turnover_clock_check_and_charts_read_their_months(spark, monthly):
    house, _ = monthly
    turnover = mart_inventory_turnover(suite.PARAMS, *map(house.table, MODELS["mart_inventory_turnover"].inputs))
    assert re.search(r"PartitionFilters: \[[^]]*_month[^]]*2001-07-01", plan(turnover))
    assert re.search(r"PartitionFilters: \[[^]]*_month", plan(unpaired_clock_events(house.table("stg_timeclock_events"), date(2001, 7, 20))))
    receipts = house.table("stg_pos_transactions")
    chart = kpi_query(receipts, [ChartMetric("SUM", "total")], time_column="transaction_dt", time_range=(datetime(1996, 1, 1), datetime(1996, 2, 1)))
    assert re.search(r"PartitionFilters: \[[^]]*_month", plan(chart))
    lazy = Warehouse(OrderBookSource(spark, DATA), suite.PARAMS).table("stg_pos_transactions")
    month = lazy.filter("transaction_dt >= '1996-01-01' AND transaction_dt < '1996-02-01'")
    assert chart.first()[0] == month.agg(F.sum("total")).first()[0]


def test_reloaded_model(spark, monthly):
    """One month of receipts is computed anew from changed sources; no other file is touched."""
    house, root = monthly
    source = house.raw
    receipts = house.table("stg_pos_transactions")
    path = Path(root) / "staging" / "stg_pos_transactions"
    before = files(path)
    changed = Warehouse(lambda name: source(name).withColumn("payment_method", F.lit("corrected")), suite.PARAMS)
    changed.reload(root, "stg_pos_transactions", date(1997, 5, 3), date(1997, 5, 4))
    again = read_laid_out(spark, str(path), receipts.schema, "month")
    month = F.date_format("transaction_date", "yyyy-MM")
    assert {r[0] for r in again.filter("payment_method = 'corrected'").select(month).distinct().collect()} == {"1997-05"}
    assert again.count() == source("raw_pos.transactions").count()
    assert {f.split("/")[0] for f, _ in set(before.items()) ^ set(files(path).items())} == {"_month=1997-05-01"}


def test_waves_hold_no_model_with_its_inputs():
    waves = build_waves()
    seen = set()
    for wave in waves:
        names = {entry.name for entry in wave}
        assert all(i in seen or i.startswith("raw_") for entry in wave for i in entry.inputs)
        seen |= names
    assert seen == set(MODELS)


def test_no_job_while_a_query_on_built_tables_is_made(spark):
    suite.build(spark, DATA)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("made", "queries being made")
    try:
        queries = suite.all_queries()
        for name in [*sorted(queries)[::17], "b07_headline_kpis", "d16_unpaired_clock_events", "k03_ytd_revenue", "m20_inventory_turnover", "i08_materialised_mart"]:
            # Staging models, loads and checks of raw tables read source files.
            if name[0] in "bkxm" and name != "m42_time_spine" or name[:3] in ("d16", "i08"):
                queries[name](spark, DATA)
                assert list(tracker.getJobIdsForGroup("made")) == [], name
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_new_input_makes_new_tables(spark, tmp_path):
    import shutil

    copy = tmp_path / "data"
    shutil.copytree(DATA, copy)
    first = suite.stored(spark, str(copy))("stg_pos_products").count()
    customers = spark.read.parquet(f"{DATA}/part.parquet")
    customers.filter("p_partkey < 100").toPandas().to_parquet(copy / "part.parquet")
    assert suite.stored(spark, str(copy))("stg_pos_products").count() == 100 < first
