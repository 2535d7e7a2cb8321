"""The source mapping and its typed staging columns as DuckDB tables named b_*."""

from __future__ import annotations

from oracles.sql import choose, clock, days, hours, money, pct, pick  # noqa: F401
from tillhouse.sources.order_book import (
    CLOCK_EPOCH,
    CLOCK_EVENTS,
    EVENT_SHIFT_DAYS,
    ORDER_STATUSES,
    PART_DEPARTMENTS,
    PAYMENT_METHODS,
    SCENARIOS,
    SHIFT_STATUSES,
    SHRINK_REASONS,
    STAFF_DEPARTMENTS,
    TIERS,
)

STAFF = "(SELECT count(*) FROM supplier)"
STAMP = "TIMESTAMP '2024-02-01 00:00:00'"
DEPT_ID = choose("p_type", {k: v[0] for k, v in PART_DEPARTMENTS.items()})
DEPT_NAME = choose("p_type", {k: v[1] for k, v in PART_DEPARTMENTS.items()})


def day(text: str, plus: str) -> str:
    return f"(DATE '{text}' + CAST({plus} AS INTEGER))"


def later(ts: str, seconds: str) -> str:
    return f"({ts} + to_seconds(CAST({seconds} AS BIGINT)))"


BASE: dict[str, str] = {}

BASE["b_lines"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linenumber AS ln, quantity, unit_price,
       {money("CAST(unit_price AS DOUBLE) * l_discount")} AS discount,
       {money("l_extendedprice * CAST(0.6 AS DOUBLE) / l_quantity")} AS unit_cost,
       l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || rn AS line_id
FROM (
  SELECT *, CAST(l_quantity AS DECIMAL(18,4)) AS quantity, {money("l_extendedprice / l_quantity")} AS unit_price,
         row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey, l_suppkey ORDER BY l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM lineitem)
"""

BASE["b_store_sales"] = f"""
SELECT o_orderkey, o_custkey, 'L' || c_nationkey AS location_id,
       CASE WHEN c_acctbal >= 0 THEN 'M' || o_custkey END AS member_id,
       {later("o_orderdate", "(o_orderkey * 37) % 86400")} AS transaction_dt
FROM orders JOIN customer ON c_custkey = o_custkey
WHERE c_nationkey % 5 <> 0
"""

BASE["b_locations"] = f"""
SELECT 'L' || n_nationkey AS location_id, n_name AS location_name, n_nationkey || ' Market Street' AS address,
       n_name || ' City' AS city, r_name AS state, CAST(10000 + n_nationkey * 37 AS VARCHAR) AS zip,
       '555-01' || (n_nationkey + 10) AS phone, {day("1990-01-01", "n_nationkey * 30")} AS opened_date,
       CASE WHEN n_nationkey % 5 = 0 THEN 'warehouse' ELSE 'store' END AS location_type,
       20000 + 500 * n_nationkey AS store_sqft, 10 + n_nationkey % 8 AS num_aisles, true AS is_active
FROM nation JOIN region ON r_regionkey = n_regionkey
"""

BASE["b_employees"] = f"""
SELECT 'E' || s_suppkey AS employee_id, 'L' || s_nationkey AS location_id, 'Given' || (s_suppkey % 50) AS first_name,
       s_name AS last_name, 'Given' || (s_suppkey % 50) || ' ' || s_name AS full_name,
       'e' || s_suppkey || '@staff.example' AS email, {day("1990-01-01", "s_suppkey % 2000")} AS hire_date,
       CASE WHEN s_suppkey % 11 = 0 THEN DATE '2001-01-01' END AS termination_date,
       {pick(STAFF_DEPARTMENTS, "s_suppkey")} AS department,
       CASE WHEN s_suppkey % 3 = 0 THEN 'Lead' ELSE 'Clerk' END AS job_title,
       CAST(12 + s_suppkey % 20 AS DECIMAL(18,4)) AS hourly_rate,
       CASE WHEN s_suppkey % 11 = 0 THEN 'terminated' ELSE 'active' END AS status, s_suppkey % 11 <> 0 AS is_active
FROM supplier
"""

BASE["b_clock"] = f"""
SELECT event_id AS k, user_id % {STAFF} AS emp_no, {choose("event_type", CLOCK_EVENTS)} AS event_type,
       date_trunc('second', ts) - INTERVAL {EVENT_SHIFT_DAYS} DAY AS event_dt
FROM events WHERE event_type IN ('click', 'purchase', 'view', 'signup', 'error')
"""

BASE["b_clock_events"] = f"""
SELECT 'T' || k AS event_id, 'E' || emp_no AS employee_id, 'L' || (emp_no % 25) AS location_id, event_type, event_dt,
       CAST(event_dt AS DATE) AS event_date, {clock("event_dt")} AS event_time, CAST(NULL AS VARCHAR) AS notes
FROM b_clock
"""

BASE["b_schedules"] = f"""
SELECT 'SC' || emp_no || '-' || d || '-' || seq AS schedule_id, 'L' || ((emp_no + seq) % 25) AS location_id,
       'E' || emp_no AS employee_id, shift_day AS scheduled_date, {pick(STAFF_DEPARTMENTS, "emp_no")} AS department,
       CASE WHEN (emp_no + d) % 4 = 0 THEN 79200 ELSE 28800 END AS shift_start,
       CASE WHEN (emp_no + d) % 4 = 0 THEN 21600 ELSE 57600 END AS shift_end,
       {pick(SHIFT_STATUSES, "emp_no * 3 + d + seq")} AS status, CAST(8 AS DECIMAL(18,2)) AS scheduled_hours,
       CAST(CASE WHEN {pick(SHIFT_STATUSES, "emp_no * 3 + d + seq")} = 'completed' THEN 8 ELSE 0 END AS DECIMAL(18,2)) AS actual_hours,
       CAST(shift_day - 7 AS TIMESTAMP) AS created_at
FROM (SELECT DISTINCT emp_no, CAST(event_dt AS DATE) AS shift_day, datediff('day', DATE '{CLOCK_EPOCH}', CAST(event_dt AS DATE)) AS d
      FROM b_clock),
     (SELECT unnest([0, 1]) AS seq)
WHERE (seq = 0 AND (emp_no + d) % 6 <> 0) OR (seq = 1 AND (emp_no + d) % 6 = 1)
"""

BASE["b_departments"] = f"""
SELECT DISTINCT {DEPT_ID} AS department_id, {DEPT_NAME} AS department_name, p_type[1:3] AS code, 'true' AS is_active FROM part
"""

BASE["b_products"] = f"""
SELECT *, CAST(unit_price - unit_cost AS DECIMAL(18,4)) AS unit_margin,
       {pct("unit_price - unit_cost", "unit_price", 2)} AS margin_pct
FROM (
  SELECT 'P' || p_partkey AS product_id, 'SKU' || p_partkey AS sku, lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS upc,
         p_name || ' #' || p_partkey AS product_name, p_brand AS brand, {DEPT_ID} AS department_id,
         {DEPT_NAME} AS department_name, 'C' || (p_size % 10) AS category, 'S' || (p_size % 25) AS subcategory,
         '1' AS unit_size, 'each' AS unit_of_measure, {money("p_retailprice * CAST(0.6 AS DOUBLE)")} AS unit_cost,
         {money("p_retailprice")} AS unit_price, p_partkey % 4 = 0 AS is_organic, p_partkey % 6 = 0 AS is_local,
         p_partkey % 13 <> 0 AS is_active
  FROM part)
"""

BASE["b_price_history"] = f"""
SELECT 'PH' || p_partkey || '-' || i AS price_history_id, 'P' || p_partkey AS product_id, p_name || ' #' || p_partkey AS product_name,
       round({money("p_retailprice")} * CAST(1 + (i - 1) * 0.05 AS DECIMAL(6,2)), 2) AS old_price,
       round({money("p_retailprice")} * CAST(1 + i * 0.05 AS DECIMAL(6,2)), 2) AS new_price,
       {later("CAST(" + day("1995-01-01", "p_partkey % 90 + 500 * i") + " AS TIMESTAMP)", "21600")} AS changed_at,
       {day("1995-01-01", "p_partkey % 90 + 500 * i")} AS changed_date
FROM part, (SELECT unnest([0, 1, 2, 3]) AS i)
"""

BASE["b_coupons"] = f"""
SELECT 'CP' || p_partkey AS coupon_id, 'SAVE' || p_partkey AS code, 'Save on ' || p_name AS description,
       CASE WHEN p_partkey % 4 = 0 THEN 'percent' ELSE 'fixed' END AS coupon_type, 5 + p_partkey % 10 AS discount_value,
       20 AS min_purchase, {DEPT_NAME} AS department_name,
       CASE WHEN p_partkey % 100 = 0 THEN 0 ELSE 100 + p_partkey % 200 END AS max_uses, p_partkey % 90 AS uses_count,
       {day("1996-01-01", "p_partkey % 300")} AS valid_from, {day("1996-03-01", "p_partkey % 300")} AS valid_until,
       (p_partkey // 50) % 3 <> 0 AS is_active
FROM part
"""

BASE["b_deals"] = f"""
SELECT 'CD' || p_partkey AS deal_id, 'Deal ' || p_partkey AS deal_name, 'Bundle of ' || p_name AS description,
       CASE WHEN p_partkey % 4 = 1 THEN 'bundle' ELSE 'bogo' END AS deal_type, 2 + p_partkey % 3 AS trigger_qty,
       {DEPT_NAME} AS trigger_department_name, {money("p_retailprice * CAST(0.8 AS DOUBLE)")} AS deal_price,
       {day("1996-01-01", "p_partkey % 300")} AS valid_from, {day("1996-03-01", "p_partkey % 300")} AS valid_until
FROM part
"""

BASE["b_transactions"] = f"""
SELECT *, CAST(transaction_dt AS DATE) AS transaction_date, date_trunc('hour', transaction_dt) AS transaction_hour,
       dayofweek(transaction_dt) AS day_of_week, hour(transaction_dt) AS hour_of_day,
       CAST(subtotal + tax - coupon_savings - deal_savings + CASE WHEN k % 101 = 5 THEN 0.5 ELSE 0 END AS DECIMAL(18,4)) AS total, member_id IS NOT NULL AS has_loyalty_member,
       coupon_savings > 0 AS has_coupon, deal_savings > 0 AS has_deal
FROM (
  SELECT o_orderkey AS k, 'T' || o_orderkey AS transaction_id, location_id, 'E' || (o_orderkey % {STAFF}) AS employee_id,
         member_id, transaction_dt, subtotal,
         CASE WHEN o_orderkey % 5 = 0 THEN {money("CAST(subtotal AS DOUBLE) * CAST(0.05 AS DOUBLE)")} ELSE 0 END AS coupon_savings,
         CASE WHEN o_orderkey % 7 = 0 THEN {money("CAST(subtotal AS DOUBLE) * CAST(0.03 AS DOUBLE)")} ELSE 0 END AS deal_savings,
         {money("CAST(subtotal AS DOUBLE) * CAST(0.08 AS DOUBLE)")} AS tax,
         {pick(PAYMENT_METHODS, "o_orderkey")} AS payment_method, {pick(SCENARIOS, "o_orderkey // 6")} AS scenario_tag
  FROM b_store_sales JOIN (
    SELECT l_orderkey, CAST(sum(CAST((unit_price - discount) * quantity AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS subtotal
    FROM b_lines GROUP BY l_orderkey) ON l_orderkey = o_orderkey)
"""

BASE["b_items"] = f"""
SELECT 'I' || line_id AS item_id, 'T' || o_orderkey AS transaction_id, 'P' || l_partkey AS product_id,
       {DEPT_ID} AS department_id, 'Item ' || l_partkey AS product_name, 'C' || (l_partkey % 10) AS category, location_id,
       quantity, unit_price, discount, CAST((unit_price - discount) * quantity AS DECIMAL(18,6)) AS line_total, transaction_dt
FROM b_lines JOIN b_store_sales ON o_orderkey = l_orderkey LEFT JOIN part ON p_partkey = l_partkey
"""

BASE["b_members"] = f"""
SELECT 'M' || c_custkey AS member_id, 'Given' || (c_custkey % 50) AS first_name, c_name AS last_name,
       'Given' || (c_custkey % 50) || ' ' || c_name AS full_name, 'm' || c_custkey || '@member.example' AS email,
       {day("1995-01-01", "c_custkey % 700")} AS signup_date, c_custkey % 500 AS points_balance,
       {pick(TIERS, "c_custkey")} AS tier
FROM customer
"""

BASE["b_points"] = """
SELECT 'PT' || k AS pt_id, member_id, transaction_id, points_earned, points_redeemed,
       CASE WHEN k % 50 = 0 THEN 'tier_upgrade' WHEN k % 4 = 0 THEN 'redeem' ELSE 'purchase' END AS reason,
       CAST(sum(points_earned - points_redeemed) OVER (PARTITION BY member_id ORDER BY created_at, k)
            + CASE WHEN k % 97 = 0 THEN 7 ELSE 0 END AS BIGINT) AS points_balance_after,
       k % 50 = 0 AS tier_changed, created_at
FROM (
  SELECT k, member_id, transaction_id, points_earned, CASE WHEN k % 4 = 0 THEN points_earned // 4 ELSE 0 END AS points_redeemed, created_at
  FROM (SELECT k, member_id, transaction_id, CAST(floor(CAST(total AS DOUBLE) / 10) AS BIGINT) % 1000 AS points_earned,
               transaction_dt AS created_at
        FROM b_transactions WHERE member_id IS NOT NULL))
"""

BASE["b_order_base"] = f"""
SELECT o_orderkey, o_orderkey // 4 AS k, CASE WHEN c_nationkey % 5 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS store_no,
       ((o_orderkey // 4) % 5) * 5 AS warehouse_no, CAST(o_orderdate AS DATE) AS order_date,
       {later("o_orderdate", "(o_orderkey * 53) % 86400")} AS order_dt
FROM orders JOIN customer ON c_custkey = o_custkey
"""

BASE["b_store_orders"] = f"""
SELECT 'O' || o_orderkey AS order_id, 'L' || store_no AS store_location_id, 'L' || warehouse_no AS warehouse_location_id,
       'E' || (k % {STAFF}) AS created_by, order_dt, CAST(order_dt AS DATE) AS order_date,
       order_date + CAST(k % 5 + 1 AS INTEGER) AS requested_delivery_dt,
       CASE WHEN k % 9 <> 0 THEN 'E' || ((k + 1) % {STAFF}) END AS approved_by,
       CASE WHEN k % 9 <> 0 THEN {later("order_dt", "(k % 30 + 1) * 3600")} END AS approved_dt,
       CASE WHEN k % 17 = 0 THEN 'cancelled' ELSE {pick(ORDER_STATUSES, "k")} END AS status, CAST(NULL AS VARCHAR) AS notes
FROM b_order_base
"""

BASE["b_store_order_items"] = """
SELECT *, coalesce(quantity_approved, quantity_requested) AS quantity_effective
FROM (
  SELECT 'OI' || line_id AS item_id, 'O' || l_orderkey AS order_id, 'P' || l_partkey AS product_id,
         CAST(quantity AS INTEGER) AS quantity_requested,
         CASE WHEN (l_orderkey // 4 + ln) % 9 <> 0 THEN CAST(quantity AS INTEGER) - CASE WHEN ln % 3 = 0 THEN 1 ELSE 0 END END AS quantity_approved
  FROM b_lines)
"""

BASE["b_fulfilments"] = f"""
SELECT *, CASE WHEN k % 7 <> 0 THEN {later("started_at", "(k % 30 + 1) * 3600 + part_no * 1800")} END AS completed_at
FROM (
  SELECT *, 'F' || o_orderkey || CASE part_no WHEN 1 THEN 'b' ELSE 'a' END AS fulfillment_id,
         CASE WHEN k % 13 <> 0 THEN {later("order_dt", "(k % 40 + 2 + part_no * 30) * 3600")} END AS started_at
  FROM b_order_base, (SELECT unnest([0, 1]) AS part_no)
  WHERE k % 6 <> 0 AND (part_no = 0 OR k % 25 = 1))
"""

BASE["b_fulfillment_orders"] = f"""
SELECT fulfillment_id, 'O' || o_orderkey AS store_order_id, 'L' || warehouse_no AS warehouse_location_id,
       'E' || (k % {STAFF}) AS assigned_to, 'Picker ' || (k % {STAFF}) AS assigned_to_name,
       CASE WHEN k % 17 = 0 THEN 'cancelled' WHEN completed_at IS NOT NULL THEN 'completed' ELSE 'in_progress' END AS status,
       started_at, completed_at, {hours("started_at", "completed_at")} AS hours_to_fulfill,
       {later("order_dt", "1800")} AS created_at
FROM b_fulfilments
"""

BASE["b_fulfillment_items"] = f"""
SELECT *, {pct("quantity_picked", "quantity_requested", 1)} AS fill_rate_pct
FROM (
  SELECT 'FI' || line_id AS item_id, 'F' || l_orderkey || 'a' AS fulfillment_id, 'P' || l_partkey AS product_id,
         CAST(quantity AS INTEGER) AS quantity_requested,
         CAST(quantity AS INTEGER) - CASE WHEN (l_orderkey // 4 + ln) % 10 = 0 THEN 1 ELSE 0 END AS quantity_picked,
         CASE WHEN (l_orderkey // 4 + ln) % 10 = 0 THEN 'short' ELSE 'picked' END AS pick_status
  FROM b_lines WHERE (l_orderkey // 4) % 6 <> 0)
"""

BASE["b_trucks"] = """
SELECT 'TR' || n_nationkey AS truck_id, 'PLT-' || n_nationkey AS license_plate, 'Make' || (n_nationkey % 4) AS make,
       'Model' || (n_nationkey % 6) AS model, 2015 + n_nationkey % 8 AS year, 10 + n_nationkey % 15 AS capacity_pallets,
       CASE WHEN n_nationkey % 5 = 4 THEN 'false' ELSE 'true' END AS is_active
FROM nation
"""

BASE["b_shipments"] = """
SELECT fulfillment_id, o_orderkey, warehouse_no AS w, CAST(completed_at AS DATE) AS ship_day,
       datediff('day', DATE '1995-01-01', CAST(completed_at AS DATE)) AS d,
       'LD' || strftime(CAST(completed_at AS DATE), '%Y%m%d') || '-' || warehouse_no AS load_id
FROM b_fulfilments WHERE completed_at IS NOT NULL
"""

BASE["b_loads"] = f"""
SELECT *, {hours("departed_at", "arrived_at")} AS hours_in_transit, CAST(coalesce(arrived_at, departed_at) AS DATE) AS load_date,
       CASE WHEN (d + w) % 23 = 0 THEN 'cancelled' WHEN (d + w) % 29 = 0 THEN 'cancelled_missing_stock'
            WHEN arrived_at IS NOT NULL THEN 'delivered' WHEN departed_at IS NOT NULL THEN 'in_transit' ELSE 'scheduled' END AS status,
       CAST(NULL AS DOUBLE) AS distance_miles
FROM (
  SELECT *, CASE WHEN (d + w) % 7 <> 0 THEN {later("departed_at", "((d * 5 + w) % 60 + 3) * 3600")} END AS arrived_at
  FROM (
    SELECT load_id, d, w, 'TR' || ((d + w) % 18) AS truck_id, 'E' || ((d * 7 + w) % {STAFF}) AS driver_id,
           'L' || w AS warehouse_location_id, 'L' || ((d * 3 + w) % 4 + 1 + (d % 5) * 5) AS destination_location_id,
           'PLT-' || ((d + w) % 18) AS license_plate, 'Driver ' || ((d * 7 + w) % {STAFF}) AS driver,
           'Warehouse ' || w AS from_warehouse, 'Store ' || ((d * 3 + w) % 4 + 1 + (d % 5) * 5) AS to_store,
           CASE WHEN (d + w) % 11 <> 0 THEN CAST(ship_day + 1 AS TIMESTAMP) + INTERVAL 6 HOUR END AS departed_at
    FROM (SELECT DISTINCT load_id, w, ship_day, d FROM b_shipments)))
"""

BASE["b_load_items"] = """
SELECT 'LI' || fulfillment_id AS item_id, load_id, fulfillment_id, 'O' || o_orderkey AS store_order_id FROM b_shipments
"""

BASE["b_inv_products"] = """
SELECT 'IP' || p_partkey AS inv_product_id, 'P' || p_partkey AS product_id, p_name || ' #' || p_partkey AS product_name,
       'C' || (p_size % 10) AS category, 'SKU' || p_partkey AS sku, 10 + p_partkey % 20 AS reorder_point, 50 AS reorder_qty,
       'each' AS unit_of_measure, 'Supplier ' || (p_partkey % 10) AS supplier_name, 1 + p_partkey % 14 AS lead_time_days
FROM part
"""

BASE["b_stock"] = f"""
SELECT *, quantity_on_hand - quantity_reserved AS quantity_available, quantity_on_hand <= reorder_point AS is_below_reorder
FROM (
  SELECT 'ST' || p_partkey || '-' || n AS stock_id, 'P' || p_partkey AS product_id, 'SKU' || p_partkey AS sku,
         p_name || ' #' || p_partkey AS product_name, 'C' || (p_size % 10) AS category, 'L' || ((p_partkey * 3 + 8 * n) % 25) AS location_id,
         (p_partkey * 7 + n) % 60 AS quantity_on_hand, (p_partkey + n) % 5 AS quantity_reserved, 10 + p_partkey % 20 AS reorder_point,
         50 AS reorder_qty, 'Supplier ' || (p_partkey % 10) AS supplier_name,
         {later("CAST(DATE '2001-08-01' - CAST((p_partkey * 11 + n) % 700 AS INTEGER) AS TIMESTAMP)", "(p_partkey + n) % 20 * 3600")} AS last_updated
  FROM part, (SELECT unnest([0, 1, 2]) AS n))
"""

BASE["b_dated_lines"] = """
SELECT b_lines.*, CAST(o_orderdate AS DATE) AS sale_day, (l_partkey * 3 + (ln % 3) * 8) % 25 AS site
FROM b_lines JOIN orders ON o_orderkey = l_orderkey
"""

BASE["b_receipt_lines"] = """
SELECT *, 'R' || strftime(sale_day, '%Y%m%d') || '-' || site || '-' || l_suppkey AS receipt_id,
       CAST(sale_day AS TIMESTAMP) + INTERVAL 9 HOUR AS received_dt, CAST(quantity * unit_cost AS DECIMAL(18,4)) AS line_total
FROM b_dated_lines WHERE l_returnflag = 'A'
"""

BASE["b_receipts"] = """
SELECT receipt_id, 'L' || site AS location_id, received_dt, CAST(received_dt AS DATE) AS received_date,
       'Supplier ' || (l_suppkey % 10) AS supplier_name, 'PO-' || receipt_id AS po_number, sum(line_total) AS total_cost, count(*) AS line_items
FROM b_receipt_lines GROUP BY ALL
"""

BASE["b_receipt_items"] = """
SELECT 'RI' || line_id AS receipt_item_id, receipt_id, 'P' || l_partkey AS product_id, 'Item ' || l_partkey AS product_name,
       'C' || (l_partkey % 10) AS category, quantity, unit_cost, line_total, 'L' || site AS site_id, received_dt
FROM b_receipt_lines
"""

BASE["b_shrink"] = f"""
SELECT 'SH' || line_id AS event_id, 'P' || l_partkey AS product_id,
       'L' || CASE WHEN site % 5 = 0 THEN site + 1 ELSE site END AS location_id, sale_day AS event_date,
       CAST(sale_day AS TIMESTAMP) + INTERVAL 20 HOUR AS recorded_at, {pick(SHRINK_REASONS, "(l_orderkey + ln) // 5")} AS shrinkage_type,
       CAST(1 + CAST(quantity AS INTEGER) % 5 AS DECIMAL(18,4)) AS quantity_lost,
       CAST((1 + CAST(quantity AS INTEGER) % 5) * unit_cost AS DECIMAL(18,4)) AS estimated_value_lost
FROM b_dated_lines WHERE l_returnflag = 'R'
"""

BASE["b_ads"] = """
SELECT 'AD' || strftime(monday, '%Y%m%d') AS ad_id, 'Week of ' || strftime(monday, '%Y-%m-%d') AS ad_name, monday AS start_date,
       monday + 6 AS end_date, CAST(monday - 3 AS TIMESTAMP) AS created_at,
       CAST(floor(datediff('day', DATE '1995-01-02', monday) / 7.0) AS BIGINT) AS w
FROM (SELECT DISTINCT CAST(date_trunc('week', o_orderdate) AS DATE) AS monday FROM orders)
"""

BASE["b_ad_items"] = f"""
SELECT 'AI' || ad_id || '-' || p_partkey AS ad_item_id, ad_id, 'P' || p_partkey AS product_id,
       round({money("p_retailprice")} * CAST((90 - (p_partkey + w) % 21) / 100.0 AS DECIMAL(6,2)), 2) AS promoted_price,
       10 + (p_partkey + w) % 21 AS discount_pct, created_at
FROM part JOIN b_ads ON p_partkey % 20 = ((w % 20) + 20) % 20
"""
