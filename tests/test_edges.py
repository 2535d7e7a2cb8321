"""Hand-written rows for the cases the generated data does not reach."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillhouse.functions import divide, percent, shift_hours
from tillhouse.operators.ranking import global_ntile, global_row_number, previous_by_piece, previous_in_group
from tillhouse.plans.charts import ChartMetric, Filter, heatmap, kpi_query
from tillhouse.plans.metrics import MEASURES, MetricLayer
from tillhouse.plans.quality import promotion_dates
from tillhouse.plans.registry import Params
from tillhouse.plans.suite import MEASURE_SLICES

STORE = {"location_id": "L1", "name": "One", "city": "C", "state": "S", "location_type": "store", "is_active": "true"}
DEPOT = {**STORE, "location_id": "L0", "name": "Depot", "location_type": "warehouse"}
STAFF = {"employee_id": "E1", "first_name": "A", "last_name": "B", "hourly_rate": "10.00", "department": "deli", "location_id": "L1"}


def only(frame):
    rows = frame.collect()
    assert len(rows) == 1, rows
    return rows[0]


def clock(*events, employee="E1", place="L1"):
    return [
        {"event_id": f"T{i}", "employee_id": employee, "location_id": place, "event_type": kind, "event_dt": at}
        for i, (kind, at) in enumerate(events)
    ]


def shift(start="08:00:00", end="16:00:00", day="2001-07-02", status="completed", employee="E1", place="L1"):
    return {
        "schedule_id": f"{employee}{day}{start}", "employee_id": employee, "location_id": place, "scheduled_date": day,
        "department": "deli", "shift_start": start, "shift_end": end, "status": status,
    }


def test_shift_hours_over_midnight(frame):
    shifts = frame("s int, e int", (22 * 3600, 6 * 3600), (28800, 28800), (28800, 57600))
    hours = [float(r[0]) for r in shifts.select(shift_hours(F.col("s"), F.col("e"))).collect()]
    assert hours == [8.0, 24.0, 8.0]


def test_ratio_helpers(frame):
    row = only(frame("n int, d int", (1, 0)).select(percent("n", "d", 2).alias("p"), divide("n", "d").alias("q")))
    assert row.p is None and row.q is None
    row = only(frame("n int, d int", (57, 2000)).select(percent("n", "d", 1).alias("p")))
    assert float(row.p) == 2.9  # an exact half rounds up


def test_break_pairing_rules_differ(warehouse):
    """Start, start, end: the follow-up rule takes the second start, the n-th rule the first."""
    house = warehouse(
        {
            "raw_timeclock.events": clock(
                ("clock_in", "2001-07-02 08:00:00"),
                ("break_start", "2001-07-02 10:00:00"),
                ("break_start", "2001-07-02 11:00:00"),
                ("break_end", "2001-07-02 11:30:00"),
                ("clock_out", "2001-07-02 16:00:00"),
            )
        }
    )
    summary = only(house.table("mart_attendance_summary"))
    assert float(summary.total_break_hours) == 0.5 and float(summary.net_hours_worked) == 7.5
    assert summary.completed_break_pairs == 1 and summary.has_unpaired_events
    enriched = only(house.table("int_hr_labor_enriched"))
    assert float(enriched.total_break_hours) == 1.5 and float(enriched.net_hours_worked) == 8.0
    assert enriched.attendance_status == "UNSCHEDULED" and enriched.is_break_compliant


def test_break_end_before_start(warehouse):
    house = warehouse(
        {
            "raw_timeclock.events": clock(
                ("break_end", "2001-07-02 09:00:00"), ("break_start", "2001-07-02 10:00:00")
            )
        }
    )
    summary = only(house.table("mart_attendance_summary"))
    assert float(summary.total_break_hours) == 0 and summary.net_hours_worked is None
    assert float(only(house.table("int_hr_labor_enriched")).total_break_hours) == -1.0


def test_overnight_clocking(warehouse):
    """Out before in on the clock face counts as the next day."""
    house = warehouse(
        {"raw_timeclock.events": clock(("clock_out", "2001-07-02 06:00:00"), ("clock_in", "2001-07-02 22:00:00"))}
    )
    assert float(only(house.table("mart_attendance_summary")).total_clocked_hours) == 8.0


def test_attendance_statuses(warehouse):
    worked = {
        "E1": ("08:00:00", "16:00:00"), "E2": ("08:00:00", "12:30:00"), "E3": ("08:00:00", "10:00:00"),
    }
    events = []
    for emp, (start, end) in worked.items():
        events += clock(("clock_in", f"2001-07-02 {start}"), ("clock_out", f"2001-07-02 {end}"), employee=emp)
    events = [{**e, "event_id": f"T{i}"} for i, e in enumerate(events)]
    shifts = [shift(employee=e) for e in ("E1", "E2", "E3", "E4")]
    house = warehouse({"raw_timeclock.events": events, "raw_hr.schedules": shifts, "raw_hr.employees": [STAFF]})
    for name in ("int_hr_labor_enriched", "mart_employee_hours_vs_schedule"):
        found = {r.employee_id: r.attendance_status for r in house.table(name).collect()}
        assert found == {"E1": "ATTENDED", "E2": "SHORT", "E3": "PARTIAL", "E4": "NO_SHOW"}
    compliance = only(house.table("mart_attendance_compliance"))
    assert (compliance.scheduled_shifts, compliance.no_show_shifts, compliance.worked_shifts) == (4, 1, 3)
    assert float(compliance.no_show_rate_pct) == 25.0


def test_late_arrival_wraps_at_midnight(warehouse):
    """A shift at 23:58 tolerates arrival until 00:03, so 23:59 counts as late on the clock face."""
    house = warehouse(
        {
            "raw_timeclock.events": clock(("clock_in", "2001-07-02 23:59:00")),
            "raw_hr.schedules": [shift("23:58:00", "06:00:00")],
        }
    )
    assert only(house.table("int_hr_labor_enriched")).is_late_arrival


def order_tables(fulfilments, loads):
    carried = [(f, load) for f in (fulfilments or [None]) for load in loads]
    return {
        "raw_hr.locations": [STORE, DEPOT],
        "raw_ordering.store_orders": [
            {
                "order_id": "O1", "store_location_id": "L1", "warehouse_location_id": "L0", "order_dt": "2001-07-02 08:00:00",
                "requested_delivery_dt": "2001-07-04", "status": "approved",
            }
        ],
        "raw_fulfillment.orders": [
            {
                "fulfillment_id": f, "store_order_id": "O1", "status": "completed", "started_at": "2001-07-02 10:00:00",
                "completed_at": f"2001-07-02 {12 + i}:00:00", "created_at": "2001-07-02 09:00:00",
            }
            for i, f in enumerate(fulfilments)
        ],
        "raw_transport.loads": [
            {
                "load_id": load, "status": "delivered", "departed_at": "2001-07-03 06:00:00", "warehouse_location_id": "L0",
                "destination_location_id": "L1", "arrived_at": f"2001-07-05 0{i}:00:00", "to_store": "One",
            }
            for i, load in enumerate(loads)
        ],
        "raw_transport.load_items": [
            {"item_id": f"I{i}", "load_id": load, "fulfillment_id": f, "store_order_id": "O1"}
            for i, (f, load) in enumerate(carried)
        ],
    }


def test_order_with_two_fulfilments_and_three_loads(warehouse):
    house = warehouse(order_tables(["F2", "F1"], ["LD3", "LD1", "LD2"]))
    first = only(house.table("int_fulfillment_enriched"))
    assert (first.fulfillment_id, first.load_id) == ("F1", "LD1")
    assert first.on_time is False and float(first.days_late) == pytest.approx(1 + 1 / 24)
    funnel = only(house.table("mart_order_fulfillment_funnel"))
    assert funnel.pipeline_stage == "COMPLETE" and funnel.on_time is False
    # two fulfilments times six load rows
    assert house.table("mart_supply_chain_summary").count() == 12
    week = only(house.table("mart_delivery_performance"))
    assert (week.total_orders, week.total_fulfillments, week.total_loads, week.stores_served) == (1, 2, 3, 1)
    assert float(week.avg_hours_to_fulfill) == 2.5 and float(week.on_time_delivery_pct) == 100.0


def test_order_with_nothing(warehouse):
    house = warehouse(order_tables([], []))
    bare = only(house.table("int_fulfillment_enriched"))
    assert bare.fulfillment_id is None and bare.load_id is None and bare.on_time is False and bare.days_late is None
    funnel = only(house.table("mart_order_fulfillment_funnel"))
    assert funnel.pipeline_stage == "ORDER_PLACED" and funnel.on_time is None
    week = only(house.table("mart_delivery_performance"))
    assert (week.total_loads, week.on_time_delivery_pct, week.avg_hours_to_fulfill) == (0, None, None)


def test_zero_denominators(warehouse):
    house = warehouse(
        {
            "raw_fulfillment.items": [{"item_id": "1", "fulfillment_id": "F1", "quantity_requested": 0, "quantity_picked": 0, "pick_status": "short"}],
            "raw_pos.products": [{"product_id": "P1", "name": "x", "cost": "1", "current_price": "0"}],
        }
    )
    assert only(house.table("stg_fulfillment_items")).fill_rate_pct is None
    assert only(house.table("stg_pos_products")).margin_pct is None
    accuracy = only(house.table("mart_fulfillment_pick_accuracy"))
    assert accuracy.total_fill_rate_pct is None and accuracy.avg_shorted_line_fill_pct is None


def sale(txn, product, day, quantity=1, price=10, discount=0, coupon="0", **more):
    receipt = {
        "transaction_id": txn, "location_id": "L1", "transaction_dt": f"{day} 10:00:00", "subtotal": "0", "coupon_savings": coupon,
        "deal_savings": "0", "tax": "0", "total": str(quantity * (price - discount)),
    }
    line = {
        "item_id": f"{txn}-{product}", "transaction_id": txn, "product_id": product, "location_id": "L1", "quantity": quantity,
        "unit_price": price, "discount": discount, "transaction_dt": f"{day} 10:00:00", **more,
    }
    return receipt, line


def test_savings_are_shared_by_line_value(warehouse):
    receipt, a = sale("T1", "P1", "2001-07-02", 1, 30, coupon="4")
    _, b = sale("T1", "P2", "2001-07-02", 1, 10)
    free, c = sale("T2", "P1", "2001-07-02", 1, 10, 10, coupon="4")
    house = warehouse({"raw_pos.transactions": [receipt, free], "raw_pos.transaction_items": [a, b, c]})
    shares = {r.item_id: r.allocated_promo_savings for r in house.table("int_pos_sales_enriched").collect()}
    assert shares == {"T1-P1": 3.0, "T1-P2": 1.0, "T2-P1": 0.0}


def test_price_in_force(warehouse):
    """No price before the first change; the last change of a day holds; unchanged prices give no elasticity."""
    rows = [sale("T1", "P1", "2001-01-10", 4), sale("T2", "P1", "2001-02-10", 6), sale("T3", "P1", "2001-03-10", 3), sale("T4", "P1", "2001-04-10", 3)]
    changes = [("2001-02-01 08:00:00", "10"), ("2001-03-01 08:00:00", "19"), ("2001-03-01 09:00:00", "20")]
    house = warehouse(
        {
            "raw_pos.products": [{"product_id": "P1", "name": "apple"}],
            "raw_pos.price_history": [{"price_history_id": f"H{i}", "product_name": "apple", "changed_at": at, "new_price": p} for i, (at, p) in enumerate(changes)],
            "raw_pos.transactions": [r for r, _ in rows],
            "raw_pos.transaction_items": [line for _, line in rows],
        }
    )
    found = {str(r.sale_month)[:7]: r for r in house.table("mart_product_price_elasticity").collect()}
    prices = {month: None if r.effective_price is None else float(r.effective_price) for month, r in found.items()}
    assert prices == {"2001-01": None, "2001-02": 10.0, "2001-03": 20.0, "2001-04": 20.0}
    elasticity = {month: None if r.price_elasticity is None else float(r.price_elasticity) for month, r in found.items()}
    assert elasticity == {"2001-01": None, "2001-02": None, "2001-03": -0.5, "2001-04": None}


def test_price_history_by_name_fans_out_and_id_wins(warehouse):
    products = [{"product_id": p, "name": "apple"} for p in ("P1", "P2")]
    change = {"price_history_id": "H1", "product_name": "apple", "changed_at": "2001-01-01 00:00:00", "new_price": "1"}
    by_name = warehouse({"raw_pos.products": products, "raw_pos.price_history": [change]})
    assert sorted(r.product_id for r in by_name.table("stg_pos_price_history").collect()) == ["P1", "P2"]
    by_id = warehouse({"raw_pos.products": products, "raw_pos.price_history": [{**change, "product_id": "P2"}]})
    assert only(by_id.table("stg_pos_price_history")).product_id == "P2"


def test_promotion_ids_are_used_when_the_source_has_them(warehouse):
    rows = [sale("T1", "P1", "2001-07-02", 2, coupon_id="C1"), sale("T2", "P1", "2001-09-02", 1, coupon_id="C1"), sale("T3", "P1", "2001-07-03")]
    coupon = {"coupon_id": "C1", "code": "X", "max_uses": 4, "uses_count": 1, "valid_from": "2001-07-01", "valid_until": "2001-07-31"}
    house = warehouse(
        {
            "raw_pos.transactions": [r for r, _ in rows],
            "raw_pos.transaction_items": [line for _, line in rows],
            "raw_pos.coupons": [coupon],
        }
    )
    row = only(house.table("mart_promotion_redemption"))
    assert (row.attributed_txn_count, row.attributed_item_count, float(row.attributed_item_total)) == (2, 2, 30.0)
    assert float(row.redemption_rate_pct) == 25.0
    late = only(promotion_dates(house.table("stg_pos_transaction_items"), house.table("stg_pos_coupons"), "coupon_id"))
    assert (late.transaction_id, late.used_on) == ("T2", date(2001, 9, 2))


def test_route_cost_when_the_source_has_miles(warehouse):
    load = {
        "load_id": "1", "warehouse_location_id": "L0", "destination_location_id": "L1", "status": "delivered", "distance_miles": "100",
        "departed_at": "2001-07-02 06:00:00", "arrived_at": "2001-07-03 06:00:00",
    }
    house = warehouse({"raw_transport.loads": [load], "raw_hr.locations": [STORE, DEPOT]})
    assert float(only(house.table("int_transport_enriched")).route_cost) == 185.0
    route = only(house.table("mart_route_efficiency"))
    assert float(route.avg_cost_per_mile) == 1.85 and float(route.on_time_rate_pct) == 100.0


def test_ads_overlap_and_repeat(warehouse):
    """A day in two ads counts in both; two equal offers of one ad double the sums as a plain join would."""
    receipt, line = sale("T1", "P1", "2001-07-04", 3)
    ads = [{"ad_id": a, "ad_name": a, "start_date": "2001-07-02", "end_date": "2001-07-08"} for a in ("A1", "A2")]
    offers = [{"ad_item_id": f"I{i}", "ad_id": "A1", "product_id": "P1", "promoted_price": "9", "discount_pct": "10"} for i in (1, 2)]
    house = warehouse(
        {"raw_pos.transactions": [receipt], "raw_pos.transaction_items": [line], "raw_pricing.weekly_ads": ads, "raw_pricing.ad_items": offers}
    )
    found = {r.ad_name: r for r in house.table("mart_promotion_effectiveness").collect()}
    assert {n: (float(r.total_units_sold), r.days_active, r.is_ad_item) for n, r in found.items()} == {
        "A1": (6.0, 1, True),
        "A2": (3.0, 1, False),
    }
    assert float(found["A1"].promo_lift_vs_baseline_pct) == 100.0


@pytest.mark.parametrize("rows", [1, 3, 5, 12, 103])
def test_global_ntile_equals_plain_ntile(spark, rows):
    """Equal values, fewer rows than tiles, and uneven tiles."""
    data = spark.range(rows).select((F.col("id") % 3).alias("v"), F.format_string("M%04d", "id").alias("k"))
    plain = data.withColumn("t", F.ntile(5).over(Window.orderBy("v", "k")))
    assert sorted(map(tuple, global_ntile(data, 5, ["v", "k"], "t").collect())) == sorted(map(tuple, plain.collect()))


def test_global_row_number_is_dense(spark):
    data = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    numbered = global_row_number(data, ["v"], "n")
    assert numbered.filter("n <> v + 1").count() == 0


def test_previous_in_group_with_a_hot_group(spark):
    """A third of the rows on one key, a null key, and ordinary keys."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, (F.col("id") % 40).cast("string"))
    data = spark.range(900).select(key.alias("g"), (F.col("id") * 7919 % 900).alias("o"), "id")
    plain = data.withColumn("p", F.lag("id").over(Window.partitionBy("g").orderBy("o")))
    found = previous_in_group(data, ["g"], ["o"], "id", "p")
    assert found.exceptAll(plain).count() == 0 and found.count() == 900


def series(frame, *rows):
    daily = frame("transaction_date date, location_id string, state string, total_revenue long", *rows)
    return MetricLayer({"mart_daily_revenue": daily}.__getitem__)


def test_offset_across_a_gap_and_year_to_date(frame):
    layer = series(
        frame,
        (date(2000, 12, 30), "L1", "S", 5), (date(2000, 12, 31), "L1", "S", 7), (date(2001, 1, 2), "L1", "S", 1), (date(2001, 1, 3), "L1", "S", 4),
    )
    growth = {r.metric_time: float(r.revenue_dod_growth) for r in layer.query(["revenue_dod_growth"]).collect()}
    assert growth == {date(2000, 12, 31): 2.0, date(2001, 1, 3): 3.0}
    running = {r.metric_time: float(r.ytd_revenue) for r in layer.query(["ytd_revenue"]).collect()}
    assert running == {date(2000, 12, 30): 5.0, date(2000, 12, 31): 12.0, date(2001, 1, 2): 1.0, date(2001, 1, 3): 5.0}
    month = {r.metric_time: float(r.mtd_revenue) for r in layer.query(["mtd_revenue"]).collect()}
    assert month == running
    ends = {r.metric_time: float(r.ytd_revenue) for r in layer.query(["ytd_revenue"], grain="month").collect()}
    assert ends == {date(2000, 12, 1): 12.0, date(2001, 1, 1): 5.0}
    months = {r.metric_time: float(r.revenue_dod_growth) for r in layer.query(["revenue_dod_growth"], grain="month").collect()}
    assert months == {date(2000, 12, 1): 12.0 - 5.0, date(2001, 1, 1): 5.0 - (7.0 + 1.0 + 4.0)}
    with pytest.raises(ValueError):
        layer.query(["ytd_revenue"], grain=None)
    with pytest.raises(ValueError):
        layer.measures(["daily_revenue_total_revenue"], time_column="signup_date")


def test_every_measure_has_a_query():
    assert {name for names, *_ in MEASURE_SLICES.values() for name in names} == set(MEASURES)


def test_to_date_fills_days_without_data(frame):
    layer = series(frame, (date(2001, 1, 1), "L1", "S", 1), (date(2001, 1, 4), "L1", "S", 2))
    running = [float(r.ytd_revenue) for r in layer.query(["ytd_revenue"]).orderBy("metric_time").collect()]
    assert running == [1.0, 1.0, 1.0, 3.0]


def test_metric_grouping_by_entity_and_unknown_dimension(frame):
    layer = series(frame, (date(2001, 1, 1), "L1", None, 1), (date(2001, 1, 1), "L2", None, 2))
    by_entity = {r.daily_revenue: float(r.total_revenue) for r in layer.query(["total_revenue"], ["daily_revenue"]).collect()}
    assert by_entity == {"L1": 1.0, "L2": 2.0}
    assert float(only(layer.query(["total_revenue", "revenue_dod_growth"], ["state"])).total_revenue) == 3.0
    with pytest.raises(ValueError):
        layer.query(["total_revenue"], ["colour"])


def test_chart_filters_limit_and_order(frame):
    data = frame("g string, d date, v int", ("a", date(2001, 1, 1), 5), ("b", date(2001, 1, 8), None), ("c", date(2001, 1, 9), 7), ("c", date(2001, 1, 9), 1))
    total = ChartMetric("SUM", "v")
    assert [r.g for r in kpi_query(data, [total], ["g"], limit=2).collect()] == ["b", "c"]  # unknown first
    assert [r.g for r in kpi_query(data, [total], ["g"], [Filter("v", "is not null")], limit=1).collect()] == ["c"]
    assert [r.g for r in kpi_query(data, [total], ["g"], [Filter("g", "in", ("a", "x"))]).collect()] == ["a"]
    weekly = kpi_query(data, [total], time_column="d", grain="week").collect()
    assert {r.d: r.sum_v for r in weekly} == {date(2001, 1, 1): 5, date(2001, 1, 8): 8}
    ranged = kpi_query(data, [ChartMetric("COUNT", "g")], time_column="d", time_range=(date(2001, 1, 2), date(2001, 1, 9)))
    assert only(ranged).count_g == 1
    grid = only(heatmap(data.filter("g = 'c'"), "g", "d", total, [date(2001, 1, 9)]))
    assert grid["2001-01-09"] == 8


def test_loyalty_engagement_counts(warehouse):
    members = [{"member_id": m, "tier": t, "points_balance": b} for m, t, b in (("M1", "gold", 5), ("M2", "gold", -2), ("M3", None, 7))]
    point = {"pt_id": "1", "member_id": "M1", "points_earned": 8, "points_redeemed": 2, "reason": "tier_upgrade", "created_at": "2001-07-02 10:00:00"}
    house = warehouse({"raw_pos.loyalty_members": members, "raw_pos.loyalty_point_transactions": [point]})
    found = {r.current_tier: r for r in house.table("mart_loyalty_engagement").collect()}
    whole = found["ALL"]
    assert (whole.total_members, whole.points_liability, whole.tier_upgrades) == (3, 12, 1)
    assert float(whole.active_rate_pct) == 33.3 and float(whole.redemption_rate_pct) == 25.0
    assert (found["gold"].member_count, found["gold"].points_liability) == (2, 3)
    assert found[None].member_count == 1


def test_params_use_no_wall_clock(warehouse):
    moment = Params(as_of=date(2001, 1, 2)).moment
    assert moment == datetime(2001, 1, 2)
    stock = {"stock_id": "1", "product_id": "P1", "location_id": "L1", "quantity_on_hand": 3, "quantity_reserved": 1, "reorder_point": 1, "last_updated": "2001-01-01 00:00:00"}
    house = warehouse({"raw_inv.stock_levels": [stock], "raw_hr.locations": [STORE]})
    row = only(house.table("mart_inventory_turnover"))
    assert row.stock_aging_category == "DEAD_STOCK" and float(row.days_of_supply) == 300.0 and row.daily_sell_rate == 0.01


@pytest.mark.parametrize("order", [["at", "id"]])
def test_previous_by_piece_equals_lag(spark, order):
    """A hot member over many days, days with many events and one, null members, days and values."""
    rows = [("hot", i // 7, i, None if i % 11 == 0 else i * i) for i in range(500)]
    rows += [(None, i % 3, 1000 + i, i) for i in range(20)] + [("few", None if i < 2 else i, 2000 + i, i) for i in range(5)] + [("one", 1, 3000, 7)]
    data = spark.createDataFrame(rows, "member string, day int, id int, v int").withColumn("at", F.col("day") * 100)
    plain = data.withColumn("prev", F.lag("v").over(Window.partitionBy("member").orderBy("day", *order)))
    found = previous_by_piece(data, "member", "day", order, "v", "prev")
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect()))
