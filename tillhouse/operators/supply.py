"""Fulfilment, delivery and fleet marts.

Three on-time rules exist side by side: delivered by the requested day (order progress), in transit
at most 48 hours (delivery performance), and arrived within 24 hours of leaving (transport marts).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import divide, hours_elapsed, lookup, mean, percent, ratio, rounded, week_start, within
from tillhouse.operators.intermediate import order_progress
from tillhouse.plans.registry import Params, model


def _on_time_24h() -> Column:
    return within("departed_at", "arrived_at", 24)


def _arrived() -> Column:
    return F.col("arrived_at").isNotNull() & F.col("departed_at").isNotNull()


# ---- fulfilment


def _pick_sums(items: DataFrame) -> DataFrame:
    short = F.col("pick_status") == "short"
    partial = divide("quantity_picked", "quantity_requested")
    return items.groupBy("fulfillment_id").agg(
        F.count("*").alias("lines"),
        F.sum("quantity_requested").alias("requested"),
        F.sum("quantity_picked").alias("picked"),
        F.count_if(short).alias("short_lines"),
        F.count_if(F.col("pick_status") == "picked").alias("full_lines"),
        rounded(mean("fill_rate_pct"), 1).alias("avg_fill"),
        rounded(
            divide(F.sum(F.when(short, partial.cast("decimal(18,10)"))), F.count(F.when(short, partial))) * 100, 1
        ).alias("avg_short_fill"),
    )


@model("M-05", "stg_fulfillment_orders", "stg_fulfillment_items", "stg_locations")
def mart_daily_fulfillment_summary(
    p: Params, fulfillments: DataFrame, items: DataFrame, locations: DataFrame
) -> DataFrame:
    """Fulfilments are unique by id, so counting rows counts fulfilments."""
    status = F.col("status")
    sums = (
        fulfillments.join(_pick_sums(items), "fulfillment_id", "left")
        .groupBy(F.to_date(F.coalesce("started_at", "created_at")).alias("report_date"), "warehouse_location_id")
        .agg(
            F.count("fulfillment_id").alias("total_orders"),
            F.count_if(status == "completed").alias("completed_orders"),
            F.count_if(status == "cancelled").alias("cancelled_orders"),
            F.count_if(status == "in_progress").alias("in_progress_orders"),
            F.count_distinct("assigned_to").alias("pickers_active"),
            F.coalesce(F.sum("lines"), F.lit(0)).alias("total_items_picked"),
            F.coalesce(F.sum("full_lines"), F.lit(0)).alias("fully_picked_lines"),
            F.coalesce(F.sum("short_lines"), F.lit(0)).alias("shorted_lines"),
            F.coalesce(F.sum("requested"), F.lit(0)).alias("total_qty_requested"),
            F.coalesce(F.sum("picked"), F.lit(0)).alias("total_qty_picked"),
            rounded(mean("hours_to_fulfill"), 2).alias("avg_hours_to_fulfill"),
        )
    )
    named = lookup(sums, locations, "warehouse_location_id", "location_id", warehouse_name="location_name")
    return named.select(
        "report_date",
        "warehouse_location_id",
        "warehouse_name",
        "total_orders",
        "completed_orders",
        "cancelled_orders",
        "in_progress_orders",
        "pickers_active",
        "total_items_picked",
        "fully_picked_lines",
        "shorted_lines",
        "total_qty_requested",
        "total_qty_picked",
        F.coalesce(percent("total_qty_picked", "total_qty_requested", 1), F.lit(0)).alias("daily_fill_rate_pct"),
        "avg_hours_to_fulfill",
        percent("completed_orders", "total_orders", 1).alias("completion_rate_pct"),
        percent("shorted_lines", "total_items_picked", 1).alias("short_rate_pct"),
    )


@model("M-16", "stg_fulfillment_orders", "stg_fulfillment_items", "stg_locations")
def mart_fulfillment_operations(
    p: Params, fulfillments: DataFrame, items: DataFrame, locations: DataFrame
) -> DataFrame:
    named = lookup(fulfillments, locations, "warehouse_location_id", "location_id", warehouse_name="location_name")
    zero = F.lit(0)
    return named.join(_pick_sums(items), "fulfillment_id", "left").select(
        "fulfillment_id",
        "store_order_id",
        "warehouse_location_id",
        "warehouse_name",
        "assigned_to",
        F.col("assigned_to_name").alias("picker_name"),
        F.col("created_at").alias("order_received_at"),
        "started_at",
        "completed_at",
        "hours_to_fulfill",
        F.col("status").alias("fulfillment_status"),
        F.coalesce("lines", zero).alias("total_items"),
        F.coalesce("requested", zero).alias("total_qty_requested"),
        F.coalesce("picked", zero).alias("total_qty_picked"),
        F.coalesce("short_lines", zero).alias("shorted_items"),
        F.coalesce("full_lines", zero).alias("fully_picked_items"),
        F.coalesce("avg_fill", zero).alias("avg_fill_rate_pct"),
        F.round(hours_elapsed("created_at", "started_at"), 2).alias("hours_to_pick_start"),
        F.round(hours_elapsed("started_at", "completed_at"), 2).alias("picking_duration_hours"),
        ((F.coalesce("picked", zero) > 0) | (F.coalesce("lines", zero) > 0)).alias("has_items"),
    )


@model("M-17", "stg_fulfillment_items", "stg_fulfillment_orders")
def mart_fulfillment_pick_accuracy(p: Params, items: DataFrame, fulfillments: DataFrame) -> DataFrame:
    named = lookup(
        _pick_sums(items), fulfillments, "fulfillment_id", picker_name="assigned_to_name", fulfillment_status="status"
    )
    return named.select(
        "fulfillment_id",
        "picker_name",
        "fulfillment_status",
        F.col("lines").alias("total_line_items"),
        F.col("requested").alias("total_qty_requested"),
        F.col("picked").alias("total_qty_picked"),
        F.col("full_lines").alias("fully_picked_lines"),
        F.col("short_lines").alias("shorted_lines"),
        F.col("avg_fill").alias("avg_fill_rate_pct"),
        (F.col("short_lines") == 0).alias("is_perfect_order"),
        F.col("avg_short_fill").alias("avg_shorted_line_fill_pct"),
        percent("picked", "requested", 1).alias("total_fill_rate_pct"),
        percent("full_lines", "lines", 1).alias("perfect_line_rate_pct"),
        F.when(F.col("requested") > F.col("picked"), F.col("requested") - F.col("picked")).alias("total_qty_shorted"),
    )


# ---- orders and delivery


@model(
    "M-29",
    "stg_ordering_store_orders",
    "stg_ordering_store_order_items",
    "stg_fulfillment_orders",
    "stg_transport_loads",
    "stg_transport_load_items",
    "stg_locations",
)
def mart_order_fulfillment_funnel(
    p: Params,
    orders: DataFrame,
    order_items: DataFrame,
    fulfillments: DataFrame,
    loads: DataFrame,
    load_items: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Order progress with its stage; `on_time` is null while undelivered."""
    completed = F.col("fulfillment_status") == "completed"
    stage = (
        F.when(completed & (F.col("load_status") == "delivered"), "COMPLETE")
        .when(completed, "FULFILLED_PENDING_DELIVERY")
        .when(F.col("load_status") == "in_transit", "IN_TRANSIT")
        .when(F.col("load_id").isNotNull(), "ASSIGNED_TO_LOAD")
        .when(F.col("fulfillment_id").isNotNull(), "IN_FULFILLMENT")
        .otherwise("ORDER_PLACED")
    )
    return order_progress(orders, order_items, fulfillments, loads, load_items, locations).select(
        "order_id",
        "order_date",
        "order_dt",
        "store_location_id",
        "store_name",
        "store_city",
        "store_state",
        "warehouse_location_id",
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
        "load_id",
        "load_status",
        "departed_at",
        "arrived_at",
        "hours_in_transit",
        "driver_name",
        "load_date",
        F.col("_arrived_in_time").alias("on_time"),
        "days_late",
        "days_order_to_fulfill",
        "days_order_to_delivery",
        "hours_to_approve",
        stage.alias("pipeline_stage"),
    )


@model("M-28", "int_fulfillment_enriched")
def mart_order_cycle_time(p: Params, orders: DataFrame) -> DataFrame:
    day = F.col("order_date").cast("timestamp")
    return orders.select(
        "order_id",
        "order_date",
        "store_location_id",
        "store_name",
        "warehouse_location_id",
        "warehouse_name",
        "order_status",
        "fulfillment_status",
        "load_status",
        "days_order_to_fulfill",
        "days_order_to_delivery",
        "hours_to_approve",
        "hours_to_fulfill",
        "hours_in_transit",
        F.round(hours_elapsed(day, "fulfillment_completed_at"), 1).alias("order_to_fulfill_hours"),
        F.round(hours_elapsed("fulfillment_completed_at", "arrived_at"), 1).alias("fulfill_to_delivery_hours"),
        F.round(hours_elapsed(day, "arrived_at"), 1).alias("total_order_to_delivery_hours"),
        "on_time",
        "days_late",
        "requested_delivery_dt",
    )


@model("M-38", "int_fulfillment_enriched")
def mart_supply_chain_kpis(p: Params, orders: DataFrame) -> DataFrame:
    def total(name: str) -> Column:
        return F.sum(F.coalesce(name, F.lit(0)))

    sums = orders.groupBy(
        F.col("order_date").alias("report_date"), "warehouse_location_id", "store_location_id"
    ).agg(
        F.count("*").alias("order_count"),
        F.count_if(F.col("fulfillment_status") == "completed").alias("fulfilled_count"),
        F.count_if(F.col("load_status") == "delivered").alias("delivered_count"),
        F.count_if("on_time").alias("on_time_count"),
        total("pick_qty_requested").alias("total_qty_requested"),
        total("pick_qty_picked").alias("total_qty_picked"),
        total("total_shorted_qty").alias("total_shorted_qty"),
    )
    return sums.select(
        "*",
        percent("total_qty_picked", "total_qty_requested", 2).alias("fill_rate_pct"),
        percent("total_shorted_qty", "total_qty_requested", 2).alias("short_rate_pct"),
        percent("on_time_count", "delivered_count", 2).alias("on_time_rate_pct"),
    )


@model(
    "M-39",
    "stg_ordering_store_orders",
    "stg_locations",
    "stg_fulfillment_orders",
    "stg_transport_load_items",
    "stg_transport_loads",
)
def mart_supply_chain_summary(
    p: Params,
    orders: DataFrame,
    locations: DataFrame,
    fulfillments: DataFrame,
    load_items: DataFrame,
    loads: DataFrame,
) -> DataFrame:
    """Order by fulfilment by load, as many rows as there are combinations on one order."""
    named = lookup(
        orders, locations, "store_location_id", "location_id", store_name="location_name", city="city", state="state"
    )
    picked = fulfillments.select(
        F.col("store_order_id").alias("_f_order"),
        "fulfillment_id",
        F.col("status").alias("fulfillment_status"),
        "hours_to_fulfill",
    )
    carried = load_items.select(F.col("store_order_id").alias("_l_order"), "load_id").join(
        loads.select("load_id", F.col("status").alias("load_status"), "departed_at", "arrived_at", "hours_in_transit"),
        "load_id",
    )
    return (
        named.join(picked, F.col("order_id") == F.col("_f_order"), "left")
        .join(carried, F.col("order_id") == F.col("_l_order"), "left")
        .select(
            "order_id",
            "order_date",
            "order_dt",
            "store_location_id",
            "store_name",
            "city",
            "state",
            F.col("status").alias("order_status"),
            "fulfillment_id",
            "fulfillment_status",
            "hours_to_fulfill",
            "load_id",
            "load_status",
            "departed_at",
            "arrived_at",
            "hours_in_transit",
        )
    )


@model(
    "M-07",
    "stg_ordering_store_orders",
    "stg_locations",
    "stg_fulfillment_orders",
    "stg_transport_loads",
    "stg_transport_load_items",
)
def mart_delivery_performance(
    p: Params,
    orders: DataFrame,
    locations: DataFrame,
    fulfillments: DataFrame,
    loads: DataFrame,
    load_items: DataFrame,
) -> DataFrame:
    """Weekly delivery service per warehouse.

    The averages run over fulfilment x load combinations of each order. They are weighted by the
    other side's count instead of building the pairs. Loads shared by several orders are counted
    once per week and warehouse through their own distinct list.
    """
    hours = F.col("hours_to_fulfill")
    picked = fulfillments.groupBy(F.col("store_order_id").alias("_f_order")).agg(
        F.count("*").alias("f_rows"),
        F.count("fulfillment_id").alias("f_count"),
        F.count(hours).alias("f_done"),
        F.count_if(hours <= 24).alias("f_fast"),
        F.sum(hours).alias("f_hours"),
    )
    trips = load_items.select(F.col("store_order_id").alias("_l_order"), "load_id").join(
        loads.select(
            "load_id", "status", "departed_at", "hours_in_transit", "destination_location_id", "to_store"
        ),
        "load_id",
    )
    moved = trips.groupBy("_l_order").agg(
        F.count("*").alias("l_rows"),
        F.count("hours_in_transit").alias("l_done"),
        F.sum("hours_in_transit").alias("l_hours"),
    )
    week = ["report_week_start", "warehouse_location_id"]
    placed = orders.select(
        "order_id", "warehouse_location_id", week_start("order_date").alias("report_week_start")
    )
    f_weight, l_weight = F.greatest("l_rows", F.lit(1)), F.greatest("f_rows", F.lit(1))
    per_order = (
        placed.join(picked, F.col("order_id") == F.col("_f_order"), "left")
        .join(moved, F.col("order_id") == F.col("_l_order"), "left")
        .groupBy(*week)
        .agg(
            F.count("order_id").alias("total_orders"),
            F.coalesce(F.sum("f_count"), F.lit(0)).alias("total_fulfillments"),
            F.coalesce(F.sum("f_done"), F.lit(0)).alias("fulfilled_count"),
            F.coalesce(F.sum("f_fast"), F.lit(0)).alias("fulfilled_within_24h"),
            rounded(divide(F.sum(F.col("f_hours") * f_weight), F.sum(F.col("f_done") * f_weight)), 1).alias(
                "avg_hours_to_fulfill"
            ),
            rounded(divide(F.sum(F.col("l_hours") * l_weight), F.sum(F.col("l_done") * l_weight)), 1).alias(
                "avg_hours_in_transit"
            ),
        )
    )
    left = F.col("departed_at").isNotNull()
    per_load = (
        placed.join(trips, F.col("order_id") == F.col("_l_order"))
        .dropDuplicates([*week, "load_id"])
        .groupBy(*[F.col(c).alias(f"_{c}") for c in week])
        .agg(
            F.count("load_id").alias("total_loads"),
            F.count_if(F.col("status") == "delivered").alias("delivered_count"),
            F.count_if(left).alias("_left"),
            F.count_if(F.col("hours_in_transit") <= 48).alias("_fast"),
            F.count_distinct("destination_location_id").alias("stores_served"),
            F.count_distinct("to_store").alias("store_names"),
        )
    )
    same = (F.col("_report_week_start") == F.col("report_week_start")) & (
        F.col("_warehouse_location_id") == F.col("warehouse_location_id")
    )
    named = lookup(
        per_order.join(per_load, same, "left"), locations, "warehouse_location_id", "location_id", warehouse_name="location_name"
    )
    zero = F.lit(0)
    return named.select(
        *week,
        "warehouse_name",
        "total_orders",
        "total_fulfillments",
        F.coalesce("total_loads", zero).alias("total_loads"),
        "fulfilled_count",
        "fulfilled_within_24h",
        "avg_hours_to_fulfill",
        F.coalesce("delivered_count", zero).alias("delivered_count"),
        "avg_hours_in_transit",
        percent("_fast", "_left", 1).alias("on_time_delivery_pct"),
        F.coalesce("stores_served", zero).alias("stores_served"),
        F.coalesce("store_names", zero).alias("store_names"),
    )


# ---- transport


@model("M-14", "int_transport_enriched")
def mart_fleet_cost(p: Params, trips: DataFrame) -> DataFrame:
    who = [
        "truck_id",
        "license_plate",
        "make",
        "model",
        "capacity_pallets",
        "truck_is_active",
        "driver_id",
        "driver_name",
        "hourly_rate",
    ]
    return trips.groupBy(*who).agg(
        F.count("*").alias("total_loads"),
        F.count_if(F.col("status") == "delivered").alias("delivered_loads"),
        F.sum("hours_in_transit").alias("total_hours_in_transit"),
        F.sum("estimated_labor_cost").alias("estimated_labor_cost"),
        F.sum("distance_miles").alias("total_distance_miles"),
        F.sum("route_cost").alias("total_route_cost"),
        rounded(mean("hours_in_transit"), 2).alias("avg_hours_per_load"),
        F.lit(p.as_of).alias("as_of_date"),
    )


@model("M-15", "stg_transport_trucks", "int_transport_enriched")
def mart_fleet_utilization(p: Params, trucks: DataFrame, trips: DataFrame) -> DataFrame:
    """Loads and their cost come from one pass over the enriched trips."""
    sums = trips.groupBy(F.col("truck_id").alias("_truck")).agg(
        F.count("load_id").alias("_loads"),
        F.count_if(_arrived()).alias("_completed"),
        F.count_if(F.col("status") == "cancelled").alias("_cancelled"),
        F.count_if(_on_time_24h()).alias("_on_time"),
        F.sum("hours_in_transit").alias("total_hours_in_transit"),
        mean("hours_in_transit").alias("avg_hours_per_load"),
        F.min("load_date").alias("first_load_date"),
        F.max("load_date").alias("last_load_date"),
        F.sum("estimated_labor_cost").alias("total_estimated_labor_cost"),
        mean("hourly_rate").alias("avg_driver_hourly_rate"),
    )
    loads = F.coalesce("_loads", F.lit(0))
    active = F.col("is_active") == "true"
    return trucks.join(sums, F.col("truck_id") == F.col("_truck"), "left").select(
        "truck_id",
        "license_plate",
        "make",
        "model",
        "year",
        "capacity_pallets",
        "is_active",
        loads.alias("total_loads"),
        F.coalesce("_completed", F.lit(0)).alias("completed_loads"),
        F.coalesce("_cancelled", F.lit(0)).alias("cancelled_loads"),
        "total_hours_in_transit",
        "avg_hours_per_load",
        percent("_on_time", "_loads", 1).alias("on_time_rate_pct"),
        "first_load_date",
        "last_load_date",
        "total_estimated_labor_cost",
        "avg_driver_hourly_rate",
        ratio("total_hours_in_transit", "_loads", 2).alias("hours_per_load"),
        F.when(active & (loads == 0), "IDLE").when(active, "ACTIVE").otherwise("INACTIVE").alias("utilization_status"),
    )


@model("M-34", "int_transport_enriched")
def mart_route_efficiency(p: Params, trips: DataFrame) -> DataFrame:
    route = [
        "route_key",
        "warehouse_location_id",
        "warehouse_name",
        "destination_location_id",
        "store_name",
        "store_city",
        "store_state",
    ]
    sums = trips.groupBy(*route).agg(
        F.count("*").alias("total_loads"),
        F.count_if(F.col("status") == "delivered").alias("delivered_loads"),
        F.count_if(F.col("status").isin("cancelled", "cancelled_missing_stock")).alias("cancelled_loads"),
        mean("hours_in_transit").alias("avg_transit_hours"),
        F.sum("hours_in_transit").alias("total_transit_hours"),
        F.sum("estimated_labor_cost").alias("estimated_route_cost_labor"),
        F.sum("distance_miles").alias("total_distance_miles"),
        F.sum("route_cost").alias("total_route_cost"),
        F.count_if(_on_time_24h()).alias("_on_time"),
    )
    return sums.select(
        *route,
        "total_loads",
        "delivered_loads",
        "cancelled_loads",
        "avg_transit_hours",
        "total_transit_hours",
        "estimated_route_cost_labor",
        "total_distance_miles",
        "total_route_cost",
        F.when(F.col("total_distance_miles") > 0, ratio("total_route_cost", "total_distance_miles", 2)).alias(
            "avg_cost_per_mile"
        ),
        percent("_on_time", "total_loads", 1).alias("on_time_rate_pct"),
        percent("delivered_loads", "total_loads", 1).alias("completion_rate_pct"),
        F.lit(p.as_of).alias("as_of_date"),
    )


@model("M-40", "int_transport_enriched", "stg_locations")
def mart_transport_daily_metrics(p: Params, trips: DataFrame, locations: DataFrame) -> DataFrame:
    """Loads without a date keep their counts but get no labour cost."""
    status = F.col("status")
    waiting = F.col("departed_at").isNull() & ~status.like("cancel%")
    sums = trips.groupBy("load_date", "warehouse_location_id").agg(
        F.count("load_id").alias("total_loads"),
        F.count_if(_arrived()).alias("completed_loads"),
        F.count_if(status.isin("cancelled", "cancelled_missing_stock")).alias("cancelled_loads"),
        F.count_if(waiting).alias("pending_loads"),
        F.count_if(_on_time_24h()).alias("on_time_loads"),
        rounded(mean("hours_in_transit"), 2).alias("avg_transit_hours"),
        F.coalesce(F.sum("hours_in_transit"), F.lit(0)).cast("decimal(28,8)").alias("total_transit_hours"),
        F.min("departed_at").alias("first_departure"),
        F.max("arrived_at").alias("last_arrival"),
        F.count_distinct("truck_id").alias("active_trucks"),
        F.sum("estimated_labor_cost").alias("_cost"),
    )
    warehouses = locations.filter("location_type = 'warehouse'")
    named = lookup(sums, warehouses, "warehouse_location_id", "location_id", warehouse_name="location_name")
    return named.select(
        "load_date",
        "warehouse_location_id",
        "warehouse_name",
        "total_loads",
        "completed_loads",
        "cancelled_loads",
        "pending_loads",
        "on_time_loads",
        "avg_transit_hours",
        "total_transit_hours",
        "first_departure",
        "last_arrival",
        "active_trucks",
        F.when(F.col("load_date").isNotNull(), F.col("_cost")).alias("total_estimated_labor_cost"),
        percent("on_time_loads", "completed_loads", 1).alias("on_time_rate_pct"),
        percent("completed_loads", "total_loads", 1).alias("completion_rate_pct"),
    )


@model("M-41", "stg_transport_loads", "stg_transport_trucks", "stg_locations")
def mart_transport_load_summary(p: Params, loads: DataFrame, trucks: DataFrame, locations: DataFrame) -> DataFrame:
    trips = lookup(
        loads.drop("license_plate"), trucks, "truck_id",
        license_plate="license_plate", _make="make", _model="model", truck_year="year", capacity_pallets="capacity_pallets",
    )
    trips = lookup(trips, locations, "warehouse_location_id", "location_id", _warehouse="location_id")
    trips = lookup(trips, locations, "destination_location_id", "location_id", store_location_id="location_id")
    return trips.select(
        "load_id",
        "truck_id",
        "license_plate",
        F.concat("_make", F.lit(" "), "_model").alias("truck_model"),
        "truck_year",
        "capacity_pallets",
        "driver_id",
        "driver",
        F.col("from_warehouse").alias("warehouse_name"),
        F.col("_warehouse").alias("warehouse_location_id"),
        F.col("to_store").alias("store_name"),
        "store_location_id",
        "departed_at",
        "arrived_at",
        "hours_in_transit",
        "status",
        "load_date",
        F.coalesce("arrived_at", "departed_at").isNotNull().alias("has_departed"),
        F.col("arrived_at").isNotNull().alias("has_arrived"),
        _on_time_24h().alias("is_on_time"),
        "_extracted_at",
    )
