"""Check queries for the staging models."""

from __future__ import annotations

from oracles.base import STAMP
from oracles.sql import dbl

EXTRACTED = f"{STAMP} AS _extracted_at"

STAGING: dict[str, str] = {
    "stg_employees": f"""
SELECT employee_id, location_id, first_name, last_name, full_name, email, hire_date, termination_date, department, job_title,
       {dbl("hourly_rate")}, status, is_active, {EXTRACTED} FROM b_employees""",
    "stg_fulfillment_items": """
SELECT item_id, fulfillment_id, product_id, quantity_requested, quantity_picked, pick_status, fill_rate_pct FROM b_fulfillment_items""",
    "stg_fulfillment_orders": f"""
SELECT fulfillment_id, store_order_id, warehouse_location_id, assigned_to, assigned_to_name, status, started_at, completed_at,
       {dbl("hours_to_fulfill")}, created_at FROM b_fulfillment_orders""",
    "stg_hr_schedules": f"""
SELECT schedule_id, location_id, employee_id, scheduled_date, department, shift_start, shift_end, status,
       {dbl("scheduled_hours", "actual_hours")}, created_at, {EXTRACTED} FROM b_schedules""",
    "stg_inv_products": """
SELECT inv_product_id, product_id, product_name, category, sku, reorder_point, reorder_qty, unit_of_measure, supplier_name, lead_time_days
FROM b_inv_products""",
    "stg_inv_receipt_items": f"""
SELECT receipt_item_id, receipt_id, product_id, product_name, category, {dbl("quantity", "unit_cost", "line_total")} FROM b_receipt_items""",
    "stg_inv_receipts": f"""
SELECT receipt_id, location_id, received_dt, received_date, supplier_name, po_number, {dbl("total_cost")}, line_items, {EXTRACTED}
FROM b_receipts""",
    "stg_inv_shrinkage_events": f"""
SELECT event_id, product_id, location_id, event_date, recorded_at, shrinkage_type, {dbl("quantity_lost", "estimated_value_lost")}, {EXTRACTED}
FROM b_shrink""",
    "stg_inv_stock_levels": f"""
SELECT stock_id, product_id, sku, product_name, category, location_id, quantity_on_hand, quantity_reserved, quantity_available,
       reorder_point, reorder_qty, supplier_name, is_below_reorder, last_updated, {EXTRACTED} FROM b_stock""",
    "stg_locations": f"""
SELECT location_id, location_name, address, city, state, zip, phone, opened_date, location_type, store_sqft, num_aisles, is_active, {EXTRACTED}
FROM b_locations""",
    "stg_ordering_store_order_items": """
SELECT item_id, order_id, product_id, quantity_requested, quantity_approved, quantity_effective FROM b_store_order_items""",
    "stg_ordering_store_orders": f"""
SELECT order_id, store_location_id, warehouse_location_id, created_by, order_dt, order_date, requested_delivery_dt, approved_by,
       approved_dt, status, notes, {EXTRACTED} FROM b_store_orders""",
    "stg_pos_combo_deals": f"""
SELECT deal_id, deal_name, description, deal_type, trigger_qty, trigger_department_name, {dbl("deal_price")}, valid_from, valid_until FROM b_deals""",
    "stg_pos_coupons": f"""
SELECT coupon_id, code, description, coupon_type, {dbl("discount_value", "min_purchase")}, department_name, max_uses, uses_count,
       valid_from, valid_until, is_active FROM b_coupons""",
    "stg_pos_departments": "SELECT department_id, department_name, code, is_active FROM b_departments",
    "stg_pos_loyalty_members": f"""
SELECT member_id, first_name, last_name, full_name, email, signup_date, points_balance, tier, {EXTRACTED} FROM b_members""",
    "stg_pos_loyalty_point_transactions": f"""
SELECT pt_id, member_id, transaction_id, points_earned, points_redeemed, reason, points_balance_after, tier_changed, created_at, {EXTRACTED}
FROM b_points""",
    "stg_pos_price_history": f"""
SELECT price_history_id, product_id, product_name, {dbl("old_price", "new_price")}, changed_at, changed_date FROM b_price_history""",
    "stg_pos_products": f"""
SELECT product_id, sku, upc, product_name, brand, department_id, department_name, category, subcategory, unit_size, unit_of_measure,
       {dbl("unit_cost", "unit_price", "unit_margin", "margin_pct")}, is_organic, is_local, is_active, {EXTRACTED} FROM b_products""",
    "stg_pos_transaction_items": f"""
SELECT item_id, transaction_id, product_id, department_id, product_name, category, location_id,
       {dbl("quantity", "unit_price", "discount", "line_total")}, transaction_dt, CAST(NULL AS VARCHAR) AS coupon_id, CAST(NULL AS VARCHAR) AS deal_id
FROM b_items""",
    "stg_pos_transactions": f"""
SELECT transaction_id, location_id, employee_id, member_id, transaction_dt, transaction_date, transaction_hour, day_of_week, hour_of_day,
       {dbl("subtotal", "coupon_savings", "deal_savings", "tax", "total")}, payment_method, scenario_tag, has_loyalty_member, has_coupon, has_deal,
       {EXTRACTED} FROM b_transactions""",
    "stg_pricing_ad_items": f"""
SELECT ad_item_id, ad_id, product_id, {dbl("promoted_price")}, discount_pct, created_at, {EXTRACTED} FROM b_ad_items""",
    "stg_pricing_weekly_ads": f"SELECT ad_id, ad_name, start_date, end_date, created_at, {EXTRACTED} FROM b_ads",
    "stg_timeclock_events": f"""
SELECT event_id, employee_id, location_id, event_type, event_dt, event_date, event_time, notes, {EXTRACTED} FROM b_clock_events""",
    "stg_transport_load_items": "SELECT item_id, load_id, fulfillment_id, store_order_id FROM b_load_items",
    "stg_transport_loads": f"""
SELECT load_id, truck_id, driver_id, warehouse_location_id, destination_location_id, departed_at, arrived_at, status, license_plate,
       driver, from_warehouse, to_store, {dbl("hours_in_transit")}, load_date, distance_miles, {EXTRACTED} FROM b_loads""",
    "stg_transport_trucks": "SELECT truck_id, license_plate, make, model, year, capacity_pallets, is_active FROM b_trucks",
}
