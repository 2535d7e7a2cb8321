"""Typed, renamed source tables. One function per table; grain is the source key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import LINE, MONEY, clock_seconds, hours_elapsed, lookup, percent, shift_hours
from tillhouse.plans.registry import Params, model
from tillhouse.sources.raw_tables import EXTRACTED_AT

def _extracted() -> Column:
    return F.col(EXTRACTED_AT).alias("_extracted_at")


def _as(kind: str, *names: str, **renamed: str) -> list[Column]:
    """Casts; keyword form is new_name=source_column. A cast to the present type costs nothing."""
    return [F.col(n).cast(kind).alias(n) for n in names] + [
        F.col(src).cast(kind).alias(new) for new, src in renamed.items()
    ]


def _optional(frame: DataFrame, name: str, kind: str) -> Column:
    source = F.col(name) if name in frame.columns else F.lit(None)
    return source.cast(kind).alias(name)


# ---- people and places


@model("S-01", "raw_hr.employees")
def stg_employees(p: Params, employees: DataFrame) -> DataFrame:
    return employees.select(
        "employee_id",
        "location_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        *_as("date", "hire_date", "termination_date"),
        "department",
        "job_title",
        *_as(MONEY, "hourly_rate"),
        "status",
        F.col("termination_date").isNull().alias("is_active"),
        _extracted(),
    )


@model("S-04", "raw_hr.schedules")
def stg_hr_schedules(p: Params, schedules: DataFrame) -> DataFrame:
    start, end = clock_seconds("shift_start", is_text=True), clock_seconds("shift_end", is_text=True)
    hours = shift_hours(start, end)
    return schedules.select(
        "schedule_id",
        "location_id",
        "employee_id",
        *_as("date", "scheduled_date"),
        "department",
        start.alias("shift_start"),
        end.alias("shift_end"),
        "status",
        hours.alias("scheduled_hours"),
        F.when(F.col("status") == "completed", hours).otherwise(F.lit(0).cast("decimal(18,2)")).alias("actual_hours"),
        *_as("timestamp", "created_at"),
        _extracted(),
    )


@model("S-10", "raw_hr.locations")
def stg_locations(p: Params, locations: DataFrame) -> DataFrame:
    return locations.select(
        "location_id",
        F.col("name").alias("location_name"),
        "address",
        "city",
        "state",
        "zip",
        "phone",
        *_as("date", "opened_date"),
        "location_type",
        *_as("int", "store_sqft", "num_aisles"),
        *_as("boolean", "is_active"),
        _extracted(),
    )


@model("S-24", "raw_timeclock.events")
def stg_timeclock_events(p: Params, events: DataFrame) -> DataFrame:
    moment = F.col("event_dt").cast("timestamp")
    return events.select(
        "event_id",
        "employee_id",
        "location_id",
        "event_type",
        moment.alias("event_dt"),
        F.to_date(moment).alias("event_date"),
        clock_seconds(moment).alias("event_time"),
        "notes",
        _extracted(),
    )


# ---- catalogue and promotions


@model("S-15", "raw_pos.departments")
def stg_pos_departments(p: Params, departments: DataFrame) -> DataFrame:
    return departments.select("department_id", F.col("name").alias("department_name"), "code", "is_active")


@model("S-19", "raw_pos.products", "raw_pos.departments")
def stg_pos_products(p: Params, products: DataFrame, departments: DataFrame) -> DataFrame:
    price, cost = F.col("current_price").cast(MONEY), F.col("cost").cast(MONEY)
    return lookup(products, departments, "department", "name", department_id="department_id").select(
        "product_id",
        "sku",
        "upc",
        F.col("name").alias("product_name"),
        "brand",
        "department_id",
        F.col("department").alias("department_name"),
        "category",
        "subcategory",
        "unit_size",
        "unit_of_measure",
        cost.alias("unit_cost"),
        price.alias("unit_price"),
        F.round(price - cost, 4).cast(MONEY).alias("unit_margin"),
        percent(price - cost, price, 2).alias("margin_pct"),
        *_as("boolean", "is_organic", "is_local", "is_active"),
        _extracted(),
    )


@model("S-18", "raw_pos.price_history", "raw_pos.products")
def stg_pos_price_history(p: Params, history: DataFrame, products: DataFrame) -> DataFrame:
    """A source product id wins; otherwise the product is found by name, once per product of that name."""
    if "product_id" not in history.columns:
        history = lookup(history, products, "product_name", "name", product_id="product_id")
    moment = F.col("changed_at").cast("timestamp")
    return history.select(
        "price_history_id",
        "product_id",
        "product_name",
        *_as(MONEY, "old_price", "new_price"),
        moment.alias("changed_at"),
        F.to_date(moment).alias("changed_date"),
    )


@model("S-14", "raw_pos.coupons")
def stg_pos_coupons(p: Params, coupons: DataFrame) -> DataFrame:
    return coupons.select(
        "coupon_id",
        "code",
        "description",
        "coupon_type",
        *_as(MONEY, "discount_value", "min_purchase"),
        F.col("department").alias("department_name"),
        *_as("int", "max_uses", "uses_count"),
        *_as("date", "valid_from", "valid_until"),
        *_as("boolean", "is_active"),
    )


@model("S-13", "raw_pos.combo_deals")
def stg_pos_combo_deals(p: Params, deals: DataFrame) -> DataFrame:
    return deals.select(
        "deal_id",
        F.col("name").alias("deal_name"),
        "description",
        "deal_type",
        *_as("int", "trigger_qty"),
        F.col("trigger_department").alias("trigger_department_name"),
        *_as(MONEY, "deal_price"),
        *_as("date", "valid_from", "valid_until"),
    )


@model("S-23", "raw_pricing.weekly_ads")
def stg_pricing_weekly_ads(p: Params, ads: DataFrame) -> DataFrame:
    return ads.select(
        "ad_id", "ad_name", *_as("date", "start_date", "end_date"), *_as("timestamp", "created_at"), _extracted()
    )


@model("S-22", "raw_pricing.ad_items")
def stg_pricing_ad_items(p: Params, items: DataFrame) -> DataFrame:
    return items.select("ad_item_id", "ad_id", "product_id", "promoted_price", "discount_pct", "created_at", _extracted())


# ---- sales


@model("S-21", "raw_pos.transactions")
def stg_pos_transactions(p: Params, transactions: DataFrame) -> DataFrame:
    moment = F.col("transaction_dt").cast("timestamp")
    return transactions.select(
        "transaction_id",
        "location_id",
        "employee_id",
        "member_id",
        moment.alias("transaction_dt"),
        F.to_date(moment).alias("transaction_date"),
        F.date_trunc("hour", moment).alias("transaction_hour"),
        (F.dayofweek(moment) - 1).alias("day_of_week"),
        F.hour(moment).alias("hour_of_day"),
        *_as(MONEY, "subtotal", "coupon_savings", "deal_savings", "tax", "total"),
        "payment_method",
        "scenario_tag",
        F.col("member_id").isNotNull().alias("has_loyalty_member"),
        (F.col("coupon_savings").cast(MONEY) > 0).alias("has_coupon"),
        (F.col("deal_savings").cast(MONEY) > 0).alias("has_deal"),
        _extracted(),
    )


@model("S-20", "raw_pos.transaction_items", "stg_pos_products")
def stg_pos_transaction_items(p: Params, items: DataFrame, products: DataFrame) -> DataFrame:
    line_total = (F.col("unit_price") - F.col("discount")) * F.col("quantity")
    typed = items.select(
        "item_id",
        "transaction_id",
        "product_id",
        "product_name",
        "category",
        "location_id",
        *_as(MONEY, "quantity", "unit_price", "discount"),
        *_as("timestamp", "transaction_dt"),
        _optional(items, "coupon_id", "string"),
        _optional(items, "deal_id", "string"),
    )
    return lookup(typed, products, "product_id", department_id="department_id").select(
        "item_id",
        "transaction_id",
        "product_id",
        "department_id",
        "product_name",
        "category",
        "location_id",
        "quantity",
        "unit_price",
        "discount",
        line_total.cast(LINE).alias("line_total"),
        "transaction_dt",
        "coupon_id",
        "deal_id",
    )


@model("S-16", "raw_pos.loyalty_members")
def stg_pos_loyalty_members(p: Params, members: DataFrame) -> DataFrame:
    return members.select(
        "member_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        *_as("date", "signup_date"),
        *_as("int", "points_balance"),
        "tier",
        _extracted(),
    )


@model("S-17", "raw_pos.loyalty_point_transactions")
def stg_pos_loyalty_point_transactions(p: Params, points: DataFrame) -> DataFrame:
    return points.select(
        "pt_id",
        "member_id",
        "transaction_id",
        *_as("int", "points_earned", "points_redeemed"),
        "reason",
        *_as("int", points_balance_after="balance_after"),
        (F.col("reason") == "tier_upgrade").alias("tier_changed"),
        *_as("timestamp", "created_at"),
        _extracted(),
    )


# ---- ordering, fulfilment, transport


@model("S-12", "raw_ordering.store_orders")
def stg_ordering_store_orders(p: Params, orders: DataFrame) -> DataFrame:
    moment = F.col("order_dt").cast("timestamp")
    return orders.select(
        "order_id",
        "store_location_id",
        "warehouse_location_id",
        "created_by",
        moment.alias("order_dt"),
        F.to_date(moment).alias("order_date"),
        *_as("date", "requested_delivery_dt"),
        "approved_by",
        *_as("timestamp", "approved_dt"),
        "status",
        "notes",
        _extracted(),
    )


@model("S-11", "raw_ordering.store_order_items")
def stg_ordering_store_order_items(p: Params, items: DataFrame) -> DataFrame:
    return items.select(
        "item_id",
        "order_id",
        "product_id",
        "quantity_requested",
        "quantity_approved",
        F.coalesce("quantity_approved", "quantity_requested").alias("quantity_effective"),
    )


@model("S-03", "raw_fulfillment.orders")
def stg_fulfillment_orders(p: Params, orders: DataFrame) -> DataFrame:
    return orders.select(
        "fulfillment_id",
        "store_order_id",
        "warehouse_location_id",
        "assigned_to",
        "assigned_to_name",
        "status",
        *_as("timestamp", "started_at", "completed_at"),
        hours_elapsed(F.col("started_at").cast("timestamp"), F.col("completed_at").cast("timestamp")).alias(
            "hours_to_fulfill"
        ),
        *_as("timestamp", "created_at"),
    )


@model("S-02", "raw_fulfillment.items")
def stg_fulfillment_items(p: Params, items: DataFrame) -> DataFrame:
    return items.select(
        "item_id",
        "fulfillment_id",
        "product_id",
        *_as("int", "quantity_requested", "quantity_picked"),
        "pick_status",
        percent("quantity_picked", "quantity_requested", 1).alias("fill_rate_pct"),
    )


@model("S-27", "raw_transport.trucks")
def stg_transport_trucks(p: Params, trucks: DataFrame) -> DataFrame:
    return trucks.select("truck_id", "license_plate", "make", "model", "year", "capacity_pallets", "is_active")


@model("S-26", "raw_transport.loads")
def stg_transport_loads(p: Params, loads: DataFrame) -> DataFrame:
    left, came = F.col("departed_at").cast("timestamp"), F.col("arrived_at").cast("timestamp")
    return loads.select(
        "load_id",
        "truck_id",
        "driver_id",
        "warehouse_location_id",
        "destination_location_id",
        left.alias("departed_at"),
        came.alias("arrived_at"),
        "status",
        "license_plate",
        "driver",
        "from_warehouse",
        "to_store",
        hours_elapsed(left, came).alias("hours_in_transit"),
        F.to_date(F.coalesce(came, left)).alias("load_date"),
        _optional(loads, "distance_miles", MONEY),
        _extracted(),
    )


@model("S-25", "raw_transport.load_items")
def stg_transport_load_items(p: Params, items: DataFrame) -> DataFrame:
    return items.select("item_id", "load_id", "fulfillment_id", "store_order_id")


# ---- stock


@model("S-05", "raw_inv.products", "raw_pos.products")
def stg_inv_products(p: Params, stocked: DataFrame, products: DataFrame) -> DataFrame:
    return lookup(stocked, products, "product_id", product_name="name", category="category", sku="sku").select(
        "inv_product_id",
        "product_id",
        "product_name",
        "category",
        "sku",
        "reorder_point",
        "reorder_qty",
        "unit_of_measure",
        "supplier_name",
        "lead_time_days",
    )


@model("S-09", "raw_inv.stock_levels", "raw_pos.products", "raw_inv.products")
def stg_inv_stock_levels(p: Params, stock: DataFrame, products: DataFrame, stocked: DataFrame) -> DataFrame:
    named = lookup(stock, products, "product_id", sku="sku")
    named = lookup(named, stocked, "product_id", supplier_name="supplier_name")
    on_hand, reserved = F.col("quantity_on_hand").cast("int"), F.col("quantity_reserved").cast("int")
    return named.select(
        "stock_id",
        "product_id",
        "sku",
        "product_name",
        "category",
        "location_id",
        on_hand.alias("quantity_on_hand"),
        reserved.alias("quantity_reserved"),
        (on_hand - reserved).alias("quantity_available"),
        *_as("int", "reorder_point", "reorder_qty"),
        "supplier_name",
        (on_hand <= F.col("reorder_point").cast("int")).alias("is_below_reorder"),
        *_as("timestamp", "last_updated"),
        _extracted(),
    )


@model("S-07", "raw_inv.receipts")
def stg_inv_receipts(p: Params, receipts: DataFrame) -> DataFrame:
    moment = F.col("received_dt").cast("timestamp")
    return receipts.select(
        "receipt_id",
        "location_id",
        moment.alias("received_dt"),
        F.to_date(moment).alias("received_date"),
        "supplier_name",
        "po_number",
        *_as(MONEY, "total_cost"),
        *_as("int", "line_items"),
        _extracted(),
    )


@model("S-06", "raw_inv.receipt_items")
def stg_inv_receipt_items(p: Params, items: DataFrame) -> DataFrame:
    return items.select(
        "receipt_item_id",
        "receipt_id",
        "product_id",
        "product_name",
        "category",
        *_as(MONEY, "quantity", "unit_cost", "line_total"),
    )


@model("S-08", "raw_inv.shrinkage_events")
def stg_inv_shrinkage_events(p: Params, events: DataFrame) -> DataFrame:
    moment = F.col("recorded_at").cast("timestamp")
    return events.select(
        F.col("shrinkage_id").alias("event_id"),
        "product_id",
        "location_id",
        F.to_date(moment).alias("event_date"),
        moment.alias("recorded_at"),
        F.col("reason").alias("shrinkage_type"),
        *_as(MONEY, quantity_lost="quantity", estimated_value_lost="estimated_cost"),
        _extracted(),
    )
