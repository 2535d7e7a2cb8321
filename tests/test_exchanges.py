"""What is shuffled on the way to the large tables: each row once where its next steps share a key."""

from __future__ import annotations

import re
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillhouse.operators.intermediate import int_fulfillment_enriched, int_pos_sales_enriched
from tillhouse.operators.promotion import mart_promotion_effectiveness
from tillhouse.plans.day_tables import reload_periods, write_laid_out
from tillhouse.plans.quality import ForeignKey, check_keys
from tillhouse.sources.order_book import OrderBookSource


@pytest.fixture
def shuffled(spark):
    """Plans as they are for tables that are too large to broadcast: `shuffled(frame)` gives each exchange with its input."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def exchanges(frame) -> list[tuple[str, str]]:
        lines = [re.sub(r"#\d+L?", "", line) for line in frame._jdf.queryExecution().executedPlan().toString().splitlines()]
        return [(line[line.index("hashpartitioning") :].split("), ")[0], below) for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]

    yield exchanges
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def order_book(spark, tmp_path):
    """Two orders, one of them there twice; three lines of one are alike but for their amounts."""
    day = datetime(2001, 5, 1)
    orders = [(4, 1, day), (4, 2, day), (8, 1, day)]
    lines = [(4, 7, 3, 1, float(q), 10.0 * q, 0.0, 0.0, flag, "O", day) for q, flag in ((2, "A"), (1, "A"), (3, "R"))] + [(8, 7, 3, 1, 5.0, 50.0, 0.0, 0.0, "A", "O", day), (None, 7, 3, 1, 5.0, 50.0, 0.0, 0.0, "A", "O", day)]
    tables = {
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp"),
        "lineitem": (lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
        "customer": ([(1, 1, 5.0), (2, 2, 5.0)], "c_custkey bigint, c_nationkey int, c_acctbal double"),
        "supplier": ([(0,), (1,)], "s_suppkey bigint"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return OrderBookSource(spark, str(tmp_path))


@pytest.mark.parametrize("name", ["pos_transaction_items", "inv_receipt_items", "inv_shrinkage_events"])
def test_lines_are_numbered_where_they_meet_their_order(order_book, shuffled, name):
    by_order = [key for key, _ in shuffled(getattr(order_book, name)) if "l_orderkey" in key]
    assert len(by_order) == 1 and "l_linenumber" not in by_order[0], by_order


def test_alike_lines_keep_their_numbers(order_book):
    sold = sorted((r.item_id, r.location_id, float(r.quantity)) for r in order_book.pos_transaction_items.collect())
    numbered = [(f"I4-1-7-3-{i}", float(i)) for i in (1, 2, 3)]
    assert sold == sorted([(name, place, q) for name, q in numbered for place in ("L1", "L2")] + [("I8-1-7-3-1", "L1", 5.0)])
    # Numbers count all lines, whatever is taken of them; a line without an order is no receipt's, but an ordered item.
    assert sorted(r.receipt_item_id for r in order_book.inv_receipt_items.collect()) == ["RI4-1-7-3-1"] * 2 + ["RI4-1-7-3-2"] * 2 + ["RI8-1-7-3-1"]
    assert [r.shrinkage_id for r in order_book.inv_shrinkage_events.collect()] == ["SH4-1-7-3-3"] * 2
    assert order_book.ordering_store_order_items.count() == 5


def test_members_meet_receipts_not_lines(spark, params, shuffled):
    items = spark.createDataFrame([("i1", "T1", "P", Decimal(2), Decimal(3), Decimal(0), Decimal(6)), ("i2", "T1", "P", Decimal(1), Decimal(3), Decimal(0), Decimal(3)), ("i3", "T2", "P", Decimal(1), Decimal(3), Decimal(0), Decimal(3))], "item_id string, transaction_id string, product_id string, quantity decimal(18,4), unit_price decimal(18,4), discount decimal(18,4), line_total decimal(18,6)")
    receipts = spark.createDataFrame([("T1", "L1", date(2001, 1, 1), "M1", Decimal(3), Decimal(0), True, True, False), ("T2", "L1", date(2001, 1, 1), None, Decimal(0), Decimal(0), False, False, False)], "transaction_id string, location_id string, transaction_date date, member_id string, coupon_savings decimal(18,4), deal_savings decimal(18,4), has_loyalty_member boolean, has_coupon boolean, has_deal boolean")
    products = spark.createDataFrame([("P", "p", "c", "s", "D", Decimal(1))], "product_id string, product_name string, category string, subcategory string, department_id string, unit_cost decimal(18,4)")
    places = spark.createDataFrame([("L1", "one", "city", "state", "store")], "location_id string, location_name string, city string, state string, location_type string")
    # A member that is there twice doubles its lines, as a join of the lines does.
    members = spark.createDataFrame([("M1", "gold", 5), ("M1", "silver", 5), (None, "none", 1)], "member_id string, tier string, points_balance int")
    sales = int_pos_sales_enriched(params, items, receipts, products, places, members)
    by_member = [below for key, below in shuffled(sales) if key.startswith("hashpartitioning(member_id")]
    assert len(by_member) == 1 and "item_id" not in by_member[0], by_member
    assert sorted((r.item_id, r.member_tier or "", float(r.allocated_promo_savings)) for r in sales.collect()) == [("i1", "gold", 2.0), ("i1", "silver", 2.0), ("i2", "gold", 1.0), ("i2", "silver", 1.0), ("i3", "", 0.0)]


def test_picks_meet_fulfilments_not_orders(spark, params, shuffled):
    orders = spark.createDataFrame([("O1", "L1", "L2", datetime(2001, 1, 1), date(2001, 1, 1), date(2001, 1, 5), "approved", None, None), ("O2", "L1", "L2", datetime(2001, 1, 1), date(2001, 1, 1), date(2001, 1, 5), "approved", None, None)], "order_id string, store_location_id string, warehouse_location_id string, order_dt timestamp, order_date date, requested_delivery_dt date, status string, approved_dt timestamp, approved_by string")
    items = spark.createDataFrame([("O1", 4, 4)], "order_id string, quantity_requested int, quantity_approved int")
    done = spark.createDataFrame([("O1", "F1b", "completed", None, None, "p"), ("O1", "F1a", "completed", None, None, "q")], "store_order_id string, fulfillment_id string, status string, hours_to_fulfill decimal(18,8), completed_at timestamp, assigned_to_name string")
    loads = spark.createDataFrame([("LD1", "delivered", None, datetime(2001, 1, 4), None, "d", date(2001, 1, 4)), ("LD2", "scheduled", None, None, None, "d", None)], "load_id string, status string, departed_at timestamp, arrived_at timestamp, hours_in_transit decimal(18,8), driver string, load_date date")
    # The same load twice, and one that nobody knows.
    carried = spark.createDataFrame([("O1", "LD2"), ("O1", "LD1"), ("O1", "LD1"), ("O1", "LD0")], "store_order_id string, load_id string")
    places = spark.createDataFrame([("L1", "one", "city", "state"), ("L2", "two", "city", "state")], "location_id string, location_name string, city string, state string")
    picks = spark.createDataFrame([("F1a", "picked", 4, 4), ("F1a", "short", 2, 1), ("F1b", "picked", 9, 9)], "fulfillment_id string, pick_status string, quantity_requested int, quantity_picked int")
    enriched = int_fulfillment_enriched(params, orders, items, done, loads, carried, places, picks)
    found = shuffled(enriched)
    by_pick = [below for key, below in found if key.startswith("hashpartitioning(fulfillment_id")]
    assert by_pick and not any("order_dt" in below for below in by_pick), by_pick
    assert not any("_load)" in key or ", _load" in key for key, _ in found), found
    rows = {r.order_id: (r.fulfillment_id, r.pick_qty_requested, r.pick_qty_picked, r.total_shorted_qty, r.load_id, r.store_name, r.warehouse_name, r.on_time) for r in enriched.collect()}
    assert rows == {"O1": ("F1a", 6, 5, 2, "LD1", "one", "two", True), "O2": (None, None, None, None, None, "one", "two", False)}


def test_a_products_weeks_and_offers_are_dealt_once(spark, params, shuffled, tmp_path):
    week = (date(2001, 1, 1), date(2001, 1, 7))
    # The ad is there twice; an offer names no ad, one no product, one a product that nobody bought, one has no id.
    ads = spark.createDataFrame([("A1", "one", *week), ("A1", "one", *week), ("A2", "two", date(2001, 1, 3), date(2001, 1, 9))], "ad_id string, ad_name string, start_date date, end_date date")
    offers = spark.createDataFrame([("A1", "P", "i1", Decimal(5), Decimal(1)), ("A1", "P", "i1", Decimal(5), Decimal(1)), ("A1", "Q", None, Decimal(7), Decimal(2)), (None, "P", "i2", Decimal(1), Decimal(1)), ("A1", None, "i3", Decimal(1), Decimal(1)), ("A2", "Z", "i4", Decimal(1), Decimal(1))], "ad_id string, product_id string, ad_item_id string, discount_pct decimal(18,2), promoted_price decimal(18,4)")
    items = spark.createDataFrame([("T1", "P", Decimal(2), Decimal(3), Decimal(6)), ("T2", "P", Decimal(1), Decimal(3), Decimal(3)), ("T2", "Q", Decimal(1), None, Decimal(3)), ("T2", None, Decimal(4), Decimal(1), Decimal(4))], "transaction_id string, product_id string, quantity decimal(18,4), unit_price decimal(18,4), line_total decimal(18,6)")
    receipts = spark.createDataFrame([("T1", date(2001, 1, 1)), ("T2", date(2001, 1, 4))], "transaction_id string, transaction_date date")
    products = spark.createDataFrame([("P", "p", "c")], "product_id string, product_name string, category string")
    weekly = mart_promotion_effectiveness(params, ads, offers, items, receipts, products)
    found = {(r.ad_name, r.product_id, r.is_ad_item, r.discount_pct): (r.days_active, float(r.total_units_sold), float(r.promo_lift_vs_baseline_pct)) for r in weekly.collect()}
    assert found == {
        ("one", "P", True, Decimal(5)): (2, 12.0, 1100.0),
        ("one", "Q", False, Decimal(7)): (1, 2.0, 33.33),
        ("one", None, False, None): (1, 8.0, 33.33),
        ("two", "P", False, None): (1, 1.0, 0.0),
        ("two", "Q", False, None): (1, 1.0, -33.33),
        ("two", None, False, None): (1, 4.0, -33.33),
    }
    # Tables with files, whose sizes are known: the few ads are broadcast, nothing else is.
    stored = []
    for i, table in enumerate((ads, offers, items, receipts, products)):
        table.write.parquet(f"{tmp_path}/{i}")
        stored.append(spark.read.parquet(f"{tmp_path}/{i}"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    plan = mart_promotion_effectiveness(params, stored[0], *(t.hint("merge") for t in stored[1:]))
    keys = [key for key, below in shuffled(plan) if "product_id" in key]
    assert keys.count("hashpartitioning(product_id, 4") == 1 and len(keys) == 2, keys


def test_a_value_takes_few_counters_however_many_refer_to_it(spark, frame):
    """Eight columns refer to one: each finds its orphans, and a value is shuffled with four counters, not nine."""
    columns = [f"c{i}" for i in range(8)]
    rows = [tuple(None if (r + i) % 5 == 0 else f"v{(r * (i + 1)) % 6}" for i in range(8)) for r in range(30)]
    tables = {"parent": frame("k string", ("v0",), ("v1",), ("v1",), (None,), ("v4",)), "child": frame(", ".join(f"{c} string" for c in columns), *rows)}
    keys = [ForeignKey("child", c, "parent", "k") for c in columns]
    findings = check_keys(tables.__getitem__, [("parent", "k")], keys)
    row = findings.found.select(findings.of_unique("parent", "k").alias("twice"), *[findings.of_key(k, nulls).alias(f"{k.column}{nulls}") for k in keys for nulls in (False, True)]).first()
    assert row.twice == 1
    for i, c in enumerate(columns):
        orphans = sum(r[i] is not None and r[i] not in ("v0", "v1", "v4") for r in rows)
        assert (row[f"{c}False"], row[f"{c}True"]) == (orphans, orphans + sum(r[i] is None for r in rows))
    plan = findings.found._jdf.queryExecution().executedPlan().toString()
    assert max(line.count("partial_count(") for line in plan.splitlines()) <= 4, plan


def test_tables_are_written_in_little_space(spark, warehouse, tmp_path):
    house = warehouse({"raw_pos.departments": [{"department_id": "D", "name": "Deli"}]})
    house.materialise(spark, str(tmp_path), ["stg_pos_departments"])
    sold = spark.createDataFrame([("a", datetime(2001, 1, 1))], "k string, at timestamp")
    write_laid_out(sold, f"{tmp_path}/laid_out", "at", "month")
    reload_periods(sold.withColumn("at", F.lit(datetime(2001, 2, 1))), f"{tmp_path}/laid_out", "at", date(2001, 2, 1), date(2001, 2, 28), "month")
    files = [f.name for f in tmp_path.rglob("*.parquet") if f.is_file()]
    assert len(files) >= 3 and all(".zstd." in name for name in files), files
