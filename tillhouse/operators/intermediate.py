"""Enriched facts that several marts read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.functions import (
    clock_seconds,
    days_elapsed,
    divide,
    first_per,
    hours_elapsed,
    lookup,
    percent,
    rounded,
)
from tillhouse.functions.temporal import DAY_SECONDS, DURATION
from tillhouse.plans.registry import Params, model


@model(
    "X-01",
    "stg_pos_transaction_items",
    "stg_pos_transactions",
    "stg_pos_products",
    "stg_locations",
    "stg_pos_loyalty_members",
)
def int_pos_sales_enriched(
    p: Params,
    items: DataFrame,
    transactions: DataFrame,
    products: DataFrame,
    locations: DataFrame,
    members: DataFrame,
) -> DataFrame:
    """Sold lines with their receipt, product, store and member, and a share of the receipt's savings.

    Receipt totals are summed map-side first and travel with the receipt, so a receipt with very
    many lines only ever meets a join that AQE can split, never a single window group. A member belongs
    to a receipt, so receipts are looked up among members, not the wide lines.
    """
    totals = items.groupBy(F.col("transaction_id").alias("_txn")).agg(F.sum("line_total").alias("_receipt_total"))
    receipts = transactions.select(
        F.col("transaction_id").alias("_txn"),
        "location_id",
        "transaction_date",
        "member_id",
        "coupon_savings",
        "deal_savings",
        "has_loyalty_member",
        "has_coupon",
        "has_deal",
    )
    receipts = lookup(receipts, members, "member_id", member_tier="tier", member_points_balance="points_balance")
    receipts = receipts.join(totals, "_txn")
    sold = items.select(
        "item_id", "transaction_id", "product_id", "quantity", "unit_price", "discount", "line_total"
    ).join(receipts, F.col("transaction_id") == F.col("_txn"))
    sold = lookup(
        sold,
        products,
        "product_id",
        product_name="product_name",
        category="category",
        subcategory="subcategory",
        department_id="department_id",
        _unit_cost="unit_cost",
    )
    sold = lookup(
        sold, locations, "location_id", location_name="location_name", city="city", state="state", location_type="location_type"
    )
    share = divide("line_total", "_receipt_total")
    savings = (F.col("coupon_savings") + F.col("deal_savings")).cast("double")
    cost = F.coalesce(F.col("_unit_cost"), F.lit(0)) * F.col("quantity")
    return sold.select(
        "item_id",
        "transaction_id",
        "transaction_date",
        "location_id",
        "location_name",
        "city",
        "state",
        "location_type",
        "product_id",
        "product_name",
        "category",
        "subcategory",
        "department_id",
        "member_id",
        "member_tier",
        "member_points_balance",
        "has_loyalty_member",
        "has_coupon",
        "has_deal",
        "coupon_savings",
        "deal_savings",
        "quantity",
        "unit_price",
        "discount",
        "line_total",
        (F.col("line_total") - cost).cast("decimal(18,6)").alias("line_margin_proxy"),
        F.when(F.col("_receipt_total") > 0, savings * share).otherwise(0.0).alias("allocated_promo_savings"),
    )


# ---- supply chain


def order_progress(
    orders: DataFrame,
    items: DataFrame,
    fulfillments: DataFrame,
    loads: DataFrame,
    load_items: DataFrame,
    locations: DataFrame,
    *carried_along: str,
) -> DataFrame:
    """One row per store order with its first fulfilment and its first load.

    Taking the smallest (fulfilment, load) of an order is the smallest of each on its own, so each
    side is reduced to one row per order before the join and no pairs are built. Places are named
    last, so their names are not shuffled. `carried_along`: further columns of the fulfilments.
    """
    lines = items.groupBy("order_id").agg(
        F.count("*").alias("order_line_items"),
        F.sum(F.col("quantity_requested").cast("int")).alias("total_qty_ordered"),
        F.sum(F.coalesce("quantity_approved", "quantity_requested").cast("int")).alias("total_qty_approved"),
    )
    fulfilment = first_per(
        fulfillments.select(
            F.col("store_order_id").alias("_f_order"),
            "fulfillment_id",
            F.col("status").alias("fulfillment_status"),
            "hours_to_fulfill",
            F.col("completed_at").alias("fulfillment_completed_at"),
            F.col("assigned_to_name").alias("picker_name"),
            *carried_along,
        ),
        ["_f_order"],
        F.asc_nulls_last("fulfillment_id"),
    )
    carried = load_items.select(F.col("store_order_id").alias("_l_order"), F.col("load_id").alias("_load"))
    load = first_per(
        carried.join(loads, F.col("_load") == F.col("load_id")).select(
            "_l_order",
            "load_id",
            F.col("status").alias("load_status"),
            "departed_at",
            "arrived_at",
            "hours_in_transit",
            F.col("driver").alias("driver_name"),
            "load_date",
        ),
        ["_l_order"],
        F.asc_nulls_last("load_id"),
    )
    placed = orders.select(
        "order_id",
        "store_location_id",
        "warehouse_location_id",
        "order_dt",
        "order_date",
        "requested_delivery_dt",
        F.col("status").alias("order_status"),
        "approved_dt",
        "approved_by",
    )
    joined = (
        placed.join(lines, "order_id", "left")
        .join(fulfilment, F.col("order_id") == F.col("_f_order"), "left")
        .join(load, F.col("order_id") == F.col("_l_order"), "left")
    )
    joined = lookup(
        joined, locations, "store_location_id", "location_id",
        store_name="location_name", store_city="city", store_state="state",
    )
    joined = lookup(joined, locations, "warehouse_location_id", "location_id", warehouse_name="location_name")
    counts = {n: F.coalesce(n, F.lit(0)) for n in ("order_line_items", "total_qty_ordered", "total_qty_approved")}
    days_late = F.greatest(
        days_elapsed(F.col("requested_delivery_dt").cast("timestamp"), "arrived_at"), F.lit(0).cast(DURATION)
    )
    known = F.col("arrived_at").isNotNull() & F.col("requested_delivery_dt").isNotNull()
    return joined.withColumns(
        {
            **counts,
            "days_order_to_fulfill": F.round(days_elapsed("order_dt", "fulfillment_completed_at"), 1),
            "days_order_to_delivery": F.round(days_elapsed("order_dt", "arrived_at"), 1),
            "hours_to_approve": F.round(hours_elapsed("order_dt", "approved_dt"), 1),
            "days_late": F.when(known, days_late),
            "_arrived_in_time": F.when(known, F.to_date("arrived_at") <= F.col("requested_delivery_dt")),
        }
    )


@model(
    "X-02",
    "stg_ordering_store_orders",
    "stg_ordering_store_order_items",
    "stg_fulfillment_orders",
    "stg_transport_loads",
    "stg_transport_load_items",
    "stg_locations",
    "stg_fulfillment_items",
)
def int_fulfillment_enriched(
    p: Params,
    orders: DataFrame,
    order_items: DataFrame,
    fulfillments: DataFrame,
    loads: DataFrame,
    load_items: DataFrame,
    locations: DataFrame,
    picked_items: DataFrame,
) -> DataFrame:
    """Store orders with pick quantities and delivery; `on_time` is false while undelivered.

    Picks meet the narrow fulfilments, of which an order then takes the first, instead of the wide orders.
    """
    short = F.col("pick_status").isin("short", "shorted")
    picks = picked_items.groupBy(F.col("fulfillment_id").alias("_pick")).agg(
        F.sum("quantity_requested").alias("pick_qty_requested"),
        F.sum("quantity_picked").alias("pick_qty_picked"),
        F.sum(F.when(short, F.col("quantity_requested")).otherwise(0)).alias("total_shorted_qty"),
    )
    picked = fulfillments.join(picks, F.col("fulfillment_id") == F.col("_pick"), "left")
    sums = ("pick_qty_requested", "pick_qty_picked", "total_shorted_qty")
    return order_progress(orders, order_items, picked, loads, load_items, locations, *sums).select(
        "order_id",
        "order_date",
        "store_location_id",
        "store_name",
        "store_city",
        "store_state",
        "warehouse_location_id",
        "warehouse_name",
        "requested_delivery_dt",
        "approved_dt",
        "approved_by",
        "order_status",
        "order_line_items",
        "total_qty_ordered",
        "total_qty_approved",
        "fulfillment_id",
        "fulfillment_status",
        "hours_to_fulfill",
        "fulfillment_completed_at",
        "picker_name",
        "pick_qty_requested",
        "pick_qty_picked",
        "total_shorted_qty",
        "load_id",
        "load_status",
        "departed_at",
        "arrived_at",
        "hours_in_transit",
        "driver_name",
        "load_date",
        "days_order_to_fulfill",
        "days_order_to_delivery",
        "hours_to_approve",
        F.coalesce("_arrived_in_time", F.lit(False)).alias("on_time"),
        "days_late",
    )


@model(
    "X-07",
    "stg_transport_loads",
    "stg_transport_trucks",
    "stg_locations",
    "stg_employees",
)
def int_transport_enriched(
    p: Params, loads: DataFrame, trucks: DataFrame, locations: DataFrame, employees: DataFrame
) -> DataFrame:
    trips = lookup(
        loads.drop("license_plate", "driver"), trucks, "truck_id",
        license_plate="license_plate", make="make", model="model",
        capacity_pallets="capacity_pallets", truck_is_active="is_active",
    )
    trips = lookup(trips, locations, "warehouse_location_id", "location_id", warehouse_name="location_name")
    trips = lookup(
        trips, locations, "destination_location_id", "location_id",
        store_name="location_name", store_city="city", store_state="state",
    )
    trips = lookup(trips, employees, "driver_id", "employee_id", driver_name="full_name", hourly_rate="hourly_rate")
    miles = F.col("distance_miles")
    return trips.select(
        "load_id",
        "truck_id",
        "license_plate",
        "make",
        "model",
        "capacity_pallets",
        "truck_is_active",
        "driver_id",
        "driver_name",
        "hourly_rate",
        "warehouse_location_id",
        "warehouse_name",
        "destination_location_id",
        "store_name",
        "store_city",
        "store_state",
        F.concat("warehouse_location_id", F.lit("->"), "destination_location_id").alias("route_key"),
        "departed_at",
        "arrived_at",
        "status",
        "hours_in_transit",
        "load_date",
        "distance_miles",
        (F.col("hours_in_transit") * F.col("hourly_rate")).cast("decimal(18,6)").alias("estimated_labor_cost"),
        F.when(miles > 0, F.round(miles * F.lit(p.cost_per_mile).cast("decimal(10,4)"), 2)).alias("route_cost"),
    )


# ---- labour


def _attendance(events: DataFrame, subtract_breaks: bool) -> DataFrame:
    """One row per employee, day and site.

    Breaks pair the n-th start with the n-th end. The sum of paired lengths equals the sum of the
    first n ends minus the sum of the first n starts, n being the smaller count; so no self join.
    All windows and the aggregate share the partitioning by employee, day and site.
    """
    site_day = ["employee_id", "event_date", "location_id"]
    kind = F.col("event_type")
    starts, ends = kind == "break_start", kind == "break_end"
    whole = Window.partitionBy(*site_day)
    nth = F.row_number().over(Window.partitionBy(*site_day, "event_type").orderBy("event_dt"))
    pairs = F.least(F.count_if(starts).over(whole), F.count_if(ends).over(whole))
    seconds = F.unix_micros("event_dt")
    signed = F.when(ends & (F.col("_nth") <= F.col("_pairs")), seconds).when(
        starts & (F.col("_nth") <= F.col("_pairs")), -seconds
    )
    days = (
        events.repartition(*site_day)
        .withColumns({"_nth": nth, "_pairs": pairs})
        .groupBy(*site_day)
        .agg(
            F.min(F.when(kind == "clock_in", F.col("event_dt"))).alias("clock_in_at"),
            F.max(F.when(kind == "clock_out", F.col("event_dt"))).alias("clock_out_at"),
            F.count_if(kind == "clock_in").alias("_ins"),
            F.count_if(kind == "clock_out").alias("_outs"),
            (F.coalesce(F.sum(signed), F.lit(0)) / F.lit(3.6e9)).cast(DURATION).alias("total_break_hours"),
        )
    )
    clocked = hours_elapsed("clock_in_at", "clock_out_at")
    return days.select(
        *site_day,
        "clock_in_at",
        "clock_out_at",
        clocked.alias("total_clocked_hours"),
        "total_break_hours",
        (clocked - F.col("total_break_hours") if subtract_breaks else clocked).cast(DURATION).alias("net_hours_worked"),
        ((F.col("_ins") > 0) & (F.col("_outs") > 0)).alias("has_complete_pair"),
        (F.col("_ins") != F.col("_outs")).alias("has_unpaired_events"),
    )


def attendance_status(scheduled: Column, present: Column, worked: Column, planned: Column) -> Column:
    both = worked.isNotNull() & planned.isNotNull()
    return (
        F.when(scheduled & ~present, "NO_SHOW")
        .when(present & ~scheduled, "UNSCHEDULED")
        .when(both & (worked >= planned * F.lit(0.9).cast("decimal(3,2)")), "ATTENDED")
        .when(both & (worked < planned * F.lit(0.5).cast("decimal(3,2)")), "PARTIAL")
        .when(both, "SHORT")
        .otherwise("UNKNOWN")
    )


@model("X-03", "stg_hr_schedules", "stg_timeclock_events", "stg_employees", "stg_locations")
def int_hr_labor_enriched(
    p: Params, schedules: DataFrame, events: DataFrame, employees: DataFrame, locations: DataFrame
) -> DataFrame:
    """Planned and clocked time side by side; either may be missing."""
    worked = _attendance(events, p.subtract_breaks).withColumnsRenamed(
        {"employee_id": "_emp", "event_date": "_day", "location_id": "_site"}
    )
    planned = schedules.select(
        F.col("employee_id").alias("_s_emp"),
        F.col("scheduled_date").alias("_s_day"),
        F.col("location_id").alias("_s_site"),
        F.col("department").alias("_s_department"),
        "shift_start",
        "shift_end",
        "scheduled_hours",
        F.col("actual_hours").alias("schedule_actual_hours"),
        F.col("status").alias("schedule_status"),
    )
    same = (
        (F.col("_emp") == F.col("_s_emp")) & (F.col("_day") == F.col("_s_day")) & (F.col("_site") == F.col("_s_site"))
    )
    both = planned.join(worked, same, "full").withColumns(
        {
            "employee_id": F.coalesce("_s_emp", "_emp"),
            "scheduled_date": F.coalesce("_s_day", "_day"),
            "location_id": F.coalesce("_s_site", "_site"),
        }
    )
    both = lookup(
        both, employees, "employee_id",
        full_name="full_name", job_title="job_title", hourly_rate="hourly_rate", _e_department="department",
    )
    both = lookup(
        both, locations, "location_id", location_name="location_name", city="city", state="state", location_type="location_type"
    )
    net, plan = F.col("net_hours_worked"), F.col("scheduled_hours")
    late = clock_seconds("clock_in_at") > (F.col("shift_start") + 300) % DAY_SECONDS
    rested = F.col("has_complete_pair") & (F.coalesce(F.col("total_break_hours"), F.lit(0)) >= 0.5)
    return both.select(
        "employee_id",
        "scheduled_date",
        "location_id",
        F.coalesce("_s_department", "_e_department").alias("department"),
        "full_name",
        "job_title",
        "hourly_rate",
        "shift_start",
        "shift_end",
        "scheduled_hours",
        "schedule_actual_hours",
        "schedule_status",
        "clock_in_at",
        "clock_out_at",
        "total_clocked_hours",
        "total_break_hours",
        "net_hours_worked",
        "has_complete_pair",
        "has_unpaired_events",
        "location_name",
        "city",
        "state",
        "location_type",
        F.coalesce(late, F.lit(False)).alias("is_late_arrival"),
        F.coalesce(net > plan * F.lit(1.25).cast("decimal(3,2)"), F.lit(False)).alias("is_overtime"),
        F.coalesce(rested, F.lit(False)).alias("is_break_compliant"),
        attendance_status(F.col("_s_emp").isNotNull(), F.col("_emp").isNotNull(), net, plan).alias("attendance_status"),
        F.round(net * F.col("hourly_rate"), 2).cast("decimal(18,2)").alias("employee_cost"),
        percent(net, plan, 1).alias("hours_attainment_pct"),
    )


# ---- stock, loyalty, shrinkage


@model(
    "X-04",
    "stg_inv_stock_levels",
    "stg_inv_receipt_items",
    "stg_inv_receipts",
    "stg_inv_shrinkage_events",
    "stg_pos_transaction_items",
    "stg_pos_transactions",
    "stg_locations",
)
def int_inventory_daily_snapshot(
    p: Params,
    stock: DataFrame,
    receipt_items: DataFrame,
    receipts: DataFrame,
    shrinkage: DataFrame,
    items: DataFrame,
    transactions: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Daily movements per product and site, with the change nothing explains.

    The four movement kinds are stacked and summed once per (product, site, day), which gives the
    distinct key set and the four outer joins in one aggregation.
    """
    grain = ["product_id", "location_id", "snapshot_date"]
    qty = "decimal(18,4)"
    measures = ("qoh", "receipts", "shrinkage_units", "shrinkage_value", "sales_units")

    def movement(frame: DataFrame, **values: Column) -> DataFrame:
        return frame.select(
            *grain, *[values.get(m, F.lit(None)).cast("int" if m == "qoh" else qty).alias(m) for m in measures]
        )

    # The newest count of a product at a site (the smallest of its last day) stands for every earlier count day as well.
    dated = stock.select("product_id", "location_id", F.to_date("last_updated").alias("snapshot_date"), "quantity_on_hand")
    per_day = dated.groupBy(*grain).agg(F.min_by("quantity_on_hand", F.struct("quantity_on_hand")).alias("_least"))
    newest = per_day.groupBy(F.col("product_id").alias("_product"), F.col("location_id").alias("_site")).agg(
        F.max_by(F.struct(F.col("_least").alias("quantity")), F.struct("snapshot_date")).alias("_newest")
    )
    same = F.col("product_id").eqNullSafe(F.col("_product")) & F.col("location_id").eqNullSafe(F.col("_site"))
    counted = per_day.join(newest, same).select(*grain, F.col("_newest.quantity").alias("_qoh"))
    received = receipt_items.join(receipts.select("receipt_id", "location_id", "received_date"), "receipt_id").select(
        "product_id", "location_id", F.col("received_date").alias("snapshot_date"), "quantity"
    )
    sold = items.select("transaction_id", "product_id", "quantity").join(
        transactions.select("transaction_id", "location_id", F.col("transaction_date").alias("snapshot_date")),
        "transaction_id",
    )
    lost = shrinkage.withColumn("snapshot_date", F.col("event_date"))
    stacked = (
        movement(counted, qoh=F.col("_qoh"))
        .unionByName(movement(received, receipts=F.col("quantity")))
        .unionByName(
            movement(lost, shrinkage_units=F.col("quantity_lost"), shrinkage_value=F.col("estimated_value_lost"))
        )
        .unionByName(movement(sold, sales_units=F.col("quantity")))
    )
    daily = stacked.groupBy(*grain).agg(
        F.coalesce(F.max("qoh"), F.lit(0)).alias("quantity_on_hand"),
        *[F.coalesce(F.sum(m), F.lit(0)).cast(qty).alias(m) for m in measures[1:]],
    )
    site = locations.select(F.col("location_id").alias("_site"), "location_type", "location_name")
    placed = daily.join(site, F.col("location_id") == F.col("_site"))
    before = F.lag("quantity_on_hand").over(Window.partitionBy("product_id", "location_id").orderBy("snapshot_date"))
    change = before - F.col("quantity_on_hand") + F.col("receipts") - F.col("sales_units") + F.col("shrinkage_units")
    return placed.select(
        "product_id",
        "location_id",
        "location_type",
        "location_name",
        "snapshot_date",
        "quantity_on_hand",
        *measures[1:],
        F.coalesce(change, F.lit(0)).cast(qty).alias("unexplained_variance"),
    )


@model(
    "X-05",
    "stg_pos_loyalty_members",
    "stg_pos_loyalty_point_transactions",
    "stg_pos_transactions",
)
def int_loyalty_enriched(p: Params, members: DataFrame, points: DataFrame, transactions: DataFrame) -> DataFrame:
    """Point events with their receipt; a member without events keeps one row of nulls."""
    receipts = transactions.select(
        F.col("transaction_id").alias("_txn"), "transaction_date", F.col("total").alias("transaction_total")
    )
    known = members.select(
        "member_id",
        F.col("tier").alias("current_tier"),
        F.col("points_balance").alias("current_points_balance"),
        "signup_date",
    )
    # An inner join can be split on a hot member, a left join on its null-supplying side cannot.
    active = known.join(points, "member_id")
    idle = known.join(points.select("member_id").distinct(), "member_id", "left_anti")
    return (
        active.unionByName(idle, allowMissingColumns=True)
        .join(receipts, F.col("transaction_id") == F.col("_txn"), "left")
        .select(
            "member_id",
            "current_tier",
            "current_points_balance",
            "signup_date",
            "pt_id",
            "transaction_id",
            "points_earned",
            "points_redeemed",
            "reason",
            "tier_changed",
            F.to_date("created_at").alias("activity_date"),
            F.col("created_at").alias("activity_ts"),
            "transaction_date",
            "transaction_total",
        )
    )


@model("X-06", "stg_inv_shrinkage_events", "stg_pos_products", "stg_locations")
def int_shrinkage_attributed(p: Params, shrinkage: DataFrame, products: DataFrame, locations: DataFrame) -> DataFrame:
    named = lookup(
        shrinkage, products, "product_id",
        product_name="product_name", sku="sku", category="category",
        department_id="department_id", department_name="department_name",
    )
    named = lookup(
        named, locations, "location_id", location_name="location_name", city="city", state="state", location_type="location_type"
    )
    return named.select(
        "event_id",
        "product_id",
        "product_name",
        "sku",
        "category",
        "department_id",
        "department_name",
        "location_id",
        "location_name",
        "city",
        "state",
        "location_type",
        "event_date",
        "recorded_at",
        "shrinkage_type",
        "quantity_lost",
        "estimated_value_lost",
    )
