"""Check queries for the intermediate and mart models, written for DuckDB.

Where the Spark job replaces pairs, ranges or ranks by something that scales, the query here keeps
the plain form, so that the two are compared.
"""

from __future__ import annotations

from oracles.sql import avg, big, cents, clock, days, dbl, dec, f8, hours, pct, quo, rat, rnd

AS_OF = "DATE '2001-08-02'"

MODELS_SQL: dict[str, str] = {}
HELPERS: dict[str, str] = {}

# ------------------------------------------------------------------ enriched sales

MODELS_SQL["int_pos_sales_enriched"] = f"""
SELECT i.item_id, i.transaction_id, t.transaction_date, t.location_id, location_name, city, state, location_type,
       i.product_id, p.product_name, p.category, p.subcategory, p.department_id, t.member_id, m.tier AS member_tier,
       m.points_balance AS member_points_balance, has_loyalty_member, has_coupon, has_deal,
       {dbl("coupon_savings", "deal_savings", "quantity")}, {f8("i.unit_price")} AS unit_price, {dbl("discount", "line_total")},
       {f8("CAST(line_total - coalesce(unit_cost, 0) * quantity AS DECIMAL(18,6))")} AS line_margin_proxy,
       CASE WHEN sum(line_total) OVER receipt > 0
            THEN {f8("coupon_savings + deal_savings")} * {quo("line_total", "sum(line_total) OVER receipt")} ELSE 0 END AS allocated_promo_savings
FROM b_items i JOIN b_transactions t USING (transaction_id)
LEFT JOIN b_products p ON p.product_id = i.product_id
LEFT JOIN b_locations l ON l.location_id = t.location_id
LEFT JOIN b_members m ON m.member_id = t.member_id
WINDOW receipt AS (PARTITION BY i.transaction_id)
"""

MODELS_SQL["mart_category_sales_performance"] = f"""
SELECT t.transaction_date, t.location_id, p.category, {f8("sum(line_total)")} AS category_revenue, {f8("sum(quantity)")} AS category_units,
       count(DISTINCT transaction_id) AS transaction_count, {rat("sum(line_total)", "count(DISTINCT transaction_id)", 2)} AS avg_basket_size
FROM b_items i JOIN b_transactions t USING (transaction_id) LEFT JOIN b_products p ON p.product_id = i.product_id
GROUP BY ALL
"""

HELPERS["t_dept_sales"] = """
SELECT t.transaction_date, t.location_id, i.department_id, count(DISTINCT transaction_id) AS n, sum(quantity) AS units,
       sum(CAST(quantity * unit_price AS DECIMAL(18,6))) AS gross, sum(discount) AS discounts, sum(line_total) AS net
FROM b_items i JOIN b_transactions t USING (transaction_id) GROUP BY ALL
"""

MODELS_SQL["mart_department_performance"] = f"""
SELECT transaction_date, location_id, location_name, department_id, department_name, n AS transaction_count, {f8("units")} AS units_sold,
       {f8("gross")} AS gross_revenue, {f8("discounts")} AS total_discounts, {f8("net")} AS net_revenue, {rat("gross", "n", 2)} AS avg_basket_size
FROM t_dept_sales LEFT JOIN b_locations USING (location_id) LEFT JOIN b_departments USING (department_id)
"""

MODELS_SQL["mart_product_performance"] = f"""
SELECT t.transaction_date, t.location_id, location_name, i.product_id, p.product_name, p.department_name, p.category, p.subcategory,
       {f8("sum(quantity)")} AS units_sold, {f8("sum(CAST(quantity * i.unit_price AS DECIMAL(18,6)))")} AS gross_revenue,
       {f8("sum(discount)")} AS total_discounts, {f8("sum(line_total)")} AS net_revenue, count(DISTINCT transaction_id) AS transaction_count,
       {f8("sum(CAST(quantity * unit_cost AS DECIMAL(18,6)))")} AS total_cost,
       {f8("sum(line_total) - sum(CAST(quantity * unit_cost AS DECIMAL(18,6)))")} AS gross_profit,
       {pct("sum(line_total) - sum(CAST(quantity * unit_cost AS DECIMAL(18,6)))", "sum(line_total)", 2)} AS margin_pct
FROM b_items i JOIN b_transactions t USING (transaction_id) LEFT JOIN b_products p ON p.product_id = i.product_id
LEFT JOIN b_locations l ON l.location_id = t.location_id
GROUP BY ALL
"""

MODELS_SQL["mart_daily_revenue"] = f"""
SELECT transaction_date, location_id, location_name, city, state, location_type, count(*) AS pos_transaction_count,
       {f8("sum(total)")} AS pos_revenue, {avg("total")} AS pos_avg_transaction, count(member_id) AS loyalty_transactions,
       {f8("sum(coupon_savings)")} AS coupon_savings_total, {f8("sum(deal_savings)")} AS deal_savings_total,
       {f8("sum(coupon_savings + deal_savings)")} AS total_discount_savings, {f8("sum(total)")} AS total_revenue
FROM b_transactions LEFT JOIN b_locations USING (location_id) GROUP BY ALL
"""

MODELS_SQL["mart_location_performance"] = f"""
SELECT location_id, location_name, city, state, location_type, min(transaction_date) AS first_sale_date, max(transaction_date) AS last_sale_date,
       count(DISTINCT transaction_date) AS days_with_sales, count(*) AS total_pos_transactions, {f8("sum(total)")} AS total_pos_revenue,
       count(member_id) AS total_loyalty_transactions, {f8("sum(total)")} AS total_revenue,
       {rat("sum(total)", "count(DISTINCT transaction_date)", 2)} AS avg_daily_revenue, {pct("count(member_id)", "count(*)", 1)} AS loyalty_attach_rate_pct,
       {f8("sum(coupon_savings)")} AS total_coupon_savings, {f8("sum(deal_savings)")} AS total_deal_savings
FROM b_transactions LEFT JOIN b_locations USING (location_id) GROUP BY ALL
"""

MODELS_SQL["mart_hourly_sales_pattern"] = f"""
SELECT hour_of_day, day_of_week, dayname(DATE '2023-01-01' + CAST(day_of_week AS INTEGER)) AS day_name, location_id, location_name, city, state,
       n AS transaction_count, active AS days_active, {f8("revenue")} AS total_revenue, {quo("revenue", "n")} AS avg_transaction_value,
       {quo("revenue", "active")} AS avg_daily_revenue_at_hour, {pct("revenue", "sum(revenue) OVER (PARTITION BY location_id)", 2)} AS pct_of_store_revenue,
       rank() OVER (PARTITION BY location_id ORDER BY revenue DESC) AS revenue_rank, {AS_OF} AS as_of_date
FROM (SELECT hour_of_day, day_of_week, location_id, count(*) AS n, count(DISTINCT transaction_date) AS active, sum(total) AS revenue
      FROM b_transactions GROUP BY ALL) JOIN b_locations USING (location_id)
"""

# ------------------------------------------------------------------ supply chain

HELPERS["t_order_lines"] = """
SELECT order_id, count(*) AS n, sum(quantity_requested) AS asked, sum(quantity_effective) AS granted FROM b_store_order_items GROUP BY ALL
"""

HELPERS["t_order_trips"] = """
SELECT li.store_order_id, l.* FROM b_load_items li JOIN b_loads l USING (load_id)
"""

HELPERS["t_order_pairs"] = f"""
SELECT o.order_id, o.order_dt, o.order_date, store_location_id, s.location_name AS store_name, s.city AS store_city, s.state AS store_state,
       o.warehouse_location_id, w.location_name AS warehouse_name, requested_delivery_dt, approved_dt, approved_by, o.status AS order_status,
       coalesce(n, 0) AS order_line_items, {big("coalesce(asked, 0)")} AS total_qty_ordered, {big("coalesce(granted, 0)")} AS total_qty_approved,
       f.fulfillment_id, f.status AS fulfillment_status, f.hours_to_fulfill, f.completed_at AS fulfillment_completed_at,
       assigned_to_name AS picker_name, load_id, t.status AS load_status, departed_at, arrived_at, hours_in_transit, driver AS driver_name, load_date,
       CAST(arrived_at AS DATE) <= requested_delivery_dt AS in_time,
       {f8("greatest(0, " + days("CAST(requested_delivery_dt AS TIMESTAMP)", "arrived_at") + ")")} AS late,
       {f8("round(" + days("order_dt", "f.completed_at") + ", 1)")} AS days_order_to_fulfill,
       {f8("round(" + days("order_dt", "arrived_at") + ", 1)")} AS days_order_to_delivery,
       {f8("round(" + hours("order_dt", "approved_dt") + ", 1)")} AS hours_to_approve
FROM b_store_orders o LEFT JOIN b_locations s ON s.location_id = store_location_id
LEFT JOIN b_locations w ON w.location_id = o.warehouse_location_id
LEFT JOIN t_order_lines ol ON ol.order_id = o.order_id
LEFT JOIN b_fulfillment_orders f ON f.store_order_id = o.order_id
LEFT JOIN t_order_trips t ON t.store_order_id = o.order_id
QUALIFY row_number() OVER (PARTITION BY o.order_id ORDER BY f.fulfillment_id NULLS LAST, load_id NULLS LAST) = 1
"""

_LATE = "CASE WHEN arrived_at IS NOT NULL THEN late END AS days_late"

MODELS_SQL["int_fulfillment_enriched"] = f"""
SELECT order_id, order_date, store_location_id, store_name, store_city, store_state, warehouse_location_id, warehouse_name, requested_delivery_dt,
       approved_dt, approved_by, order_status, order_line_items, total_qty_ordered, total_qty_approved, fulfillment_id, fulfillment_status,
       {dbl("hours_to_fulfill")}, fulfillment_completed_at, picker_name, asked AS pick_qty_requested, picked AS pick_qty_picked, short AS total_shorted_qty,
       load_id, load_status, departed_at, arrived_at, {dbl("hours_in_transit")}, driver_name, load_date, days_order_to_fulfill,
       days_order_to_delivery, hours_to_approve, coalesce(in_time, false) AS on_time, {_LATE}
FROM t_order_pairs LEFT JOIN (
  SELECT fulfillment_id, {big("sum(quantity_requested)")} AS asked, {big("sum(quantity_picked)")} AS picked,
         {big("coalesce(sum(quantity_requested) FILTER (pick_status = 'short'), 0)")} AS short
  FROM b_fulfillment_items GROUP BY ALL) USING (fulfillment_id)
"""

MODELS_SQL["mart_order_fulfillment_funnel"] = f"""
SELECT order_id, order_date, order_dt, store_location_id, store_name, store_city, store_state, warehouse_location_id, requested_delivery_dt,
       approved_dt, approved_by, order_status, order_line_items, total_qty_ordered, total_qty_approved, fulfillment_id, fulfillment_status,
       {dbl("hours_to_fulfill")}, fulfillment_completed_at, picker_name, load_id, load_status, departed_at, arrived_at, {dbl("hours_in_transit")},
       driver_name, load_date, in_time AS on_time, {_LATE}, days_order_to_fulfill, days_order_to_delivery, hours_to_approve,
       CASE WHEN fulfillment_status = 'completed' THEN if(load_status = 'delivered', 'COMPLETE', 'FULFILLED_PENDING_DELIVERY')
            WHEN load_status = 'in_transit' THEN 'IN_TRANSIT' WHEN load_id IS NOT NULL THEN 'ASSIGNED_TO_LOAD'
            WHEN fulfillment_id IS NOT NULL THEN 'IN_FULFILLMENT' ELSE 'ORDER_PLACED' END AS pipeline_stage
FROM t_order_pairs
"""

_MIDNIGHT = "CAST(order_date AS TIMESTAMP)"
MODELS_SQL["mart_order_cycle_time"] = f"""
SELECT order_id, order_date, store_location_id, store_name, warehouse_location_id, warehouse_name, order_status, fulfillment_status, load_status,
       days_order_to_fulfill, days_order_to_delivery, hours_to_approve, {dbl("hours_to_fulfill", "hours_in_transit")},
       {f8("round(" + hours(_MIDNIGHT, "fulfillment_completed_at") + ", 1)")} AS order_to_fulfill_hours,
       {f8("round(" + hours("fulfillment_completed_at", "arrived_at") + ", 1)")} AS fulfill_to_delivery_hours,
       {f8("round(" + hours(_MIDNIGHT, "arrived_at") + ", 1)")} AS total_order_to_delivery_hours,
       coalesce(in_time, false) AS on_time, {_LATE}, requested_delivery_dt
FROM t_order_pairs
"""

MODELS_SQL["mart_supply_chain_kpis"] = f"""
SELECT *, {pct("total_qty_picked", "total_qty_requested", 2)} AS fill_rate_pct, {pct("total_shorted_qty", "total_qty_requested", 2)} AS short_rate_pct,
       {pct("on_time_count", "delivered_count", 2)} AS on_time_rate_pct
FROM (
  SELECT order_date AS report_date, warehouse_location_id, store_location_id, count(*) AS order_count,
         count(*) FILTER (fulfillment_status = 'completed') AS fulfilled_count, count(*) FILTER (load_status = 'delivered') AS delivered_count,
         count(*) FILTER (on_time) AS on_time_count, {big("coalesce(sum(pick_qty_requested), 0)")} AS total_qty_requested,
         {big("coalesce(sum(pick_qty_picked), 0)")} AS total_qty_picked, {big("coalesce(sum(total_shorted_qty), 0)")} AS total_shorted_qty
  FROM t_int_fulfillment_enriched GROUP BY ALL)
"""

MODELS_SQL["mart_supply_chain_summary"] = f"""
SELECT o.order_id, order_date, order_dt, store_location_id, location_name AS store_name, city, state, o.status AS order_status, f.fulfillment_id,
       f.status AS fulfillment_status, {dbl("hours_to_fulfill")}, load_id, t.status AS load_status, departed_at, arrived_at, {dbl("hours_in_transit")}
FROM b_store_orders o LEFT JOIN b_locations ON location_id = store_location_id
LEFT JOIN b_fulfillment_orders f ON f.store_order_id = o.order_id LEFT JOIN t_order_trips t ON t.store_order_id = o.order_id
"""

MODELS_SQL["mart_delivery_performance"] = f"""
SELECT CAST(date_trunc('week', order_date) AS DATE) AS report_week_start, o.warehouse_location_id, location_name AS warehouse_name,
       count(DISTINCT o.order_id) AS total_orders, count(DISTINCT f.fulfillment_id) AS total_fulfillments, count(DISTINCT load_id) AS total_loads,
       count(DISTINCT f.fulfillment_id) FILTER (hours_to_fulfill IS NOT NULL) AS fulfilled_count,
       count(DISTINCT f.fulfillment_id) FILTER (hours_to_fulfill <= 24) AS fulfilled_within_24h,
       {rnd(avg("hours_to_fulfill"), 1)} AS avg_hours_to_fulfill, count(DISTINCT load_id) FILTER (t.status = 'delivered') AS delivered_count,
       {rnd(avg("hours_in_transit"), 1)} AS avg_hours_in_transit,
       {pct("count(DISTINCT load_id) FILTER (hours_in_transit <= 48)", "count(DISTINCT load_id) FILTER (departed_at IS NOT NULL)", 1)} AS on_time_delivery_pct,
       count(DISTINCT destination_location_id) AS stores_served, count(DISTINCT to_store) AS store_names
FROM b_store_orders o LEFT JOIN b_locations ON location_id = o.warehouse_location_id
LEFT JOIN b_fulfillment_orders f ON f.store_order_id = o.order_id LEFT JOIN t_order_trips t ON t.store_order_id = o.order_id
GROUP BY 1, 2, 3
"""

_SHORT_FILL = quo("quantity_picked", "quantity_requested")
HELPERS["t_picks"] = f"""
SELECT fulfillment_id, count(*) AS n, {big("sum(quantity_requested)")} AS asked, {big("sum(quantity_picked)")} AS picked,
       count(*) FILTER (pick_status = 'short') AS short, count(*) FILTER (pick_status = 'picked') AS full_lines,
       {rnd(quo("sum(CAST(fill_rate_pct AS DECIMAL(18,1)))", "count(fill_rate_pct)"), 1)} AS avg_fill,
       {rnd(quo(f"sum(CAST({_SHORT_FILL} AS DECIMAL(18,10))) FILTER (pick_status = 'short')",
                f"count({_SHORT_FILL}) FILTER (pick_status = 'short')") + " * 100", 1)} AS avg_short_fill
FROM b_fulfillment_items GROUP BY ALL
"""

MODELS_SQL["mart_daily_fulfillment_summary"] = f"""
SELECT report_date, warehouse_location_id, location_name AS warehouse_name, total_orders, completed_orders, cancelled_orders, in_progress_orders,
       pickers_active, total_items_picked, fully_picked_lines, shorted_lines, total_qty_requested, total_qty_picked,
       coalesce({pct("total_qty_picked", "total_qty_requested", 1)}, 0) AS daily_fill_rate_pct, avg_hours_to_fulfill,
       {pct("completed_orders", "total_orders", 1)} AS completion_rate_pct, {pct("shorted_lines", "total_items_picked", 1)} AS short_rate_pct
FROM (
  SELECT CAST(coalesce(started_at, created_at) AS DATE) AS report_date, warehouse_location_id, count(DISTINCT fulfillment_id) AS total_orders,
         count(DISTINCT fulfillment_id) FILTER (status = 'completed') AS completed_orders,
         count(DISTINCT fulfillment_id) FILTER (status = 'cancelled') AS cancelled_orders,
         count(DISTINCT fulfillment_id) FILTER (status = 'in_progress') AS in_progress_orders, count(DISTINCT assigned_to) AS pickers_active,
         {big("coalesce(sum(n), 0)")} AS total_items_picked, {big("coalesce(sum(full_lines), 0)")} AS fully_picked_lines,
         {big("coalesce(sum(short), 0)")} AS shorted_lines, {big("coalesce(sum(asked), 0)")} AS total_qty_requested,
         {big("coalesce(sum(picked), 0)")} AS total_qty_picked, {rnd(avg("hours_to_fulfill"), 2)} AS avg_hours_to_fulfill
  FROM b_fulfillment_orders LEFT JOIN t_picks USING (fulfillment_id) GROUP BY ALL)
LEFT JOIN b_locations ON location_id = warehouse_location_id
"""

MODELS_SQL["mart_fulfillment_operations"] = f"""
SELECT fulfillment_id, store_order_id, warehouse_location_id, location_name AS warehouse_name, assigned_to, assigned_to_name AS picker_name,
       created_at AS order_received_at, started_at, completed_at, {dbl("hours_to_fulfill")}, status AS fulfillment_status, coalesce(n, 0) AS total_items,
       coalesce(asked, 0) AS total_qty_requested, coalesce(picked, 0) AS total_qty_picked, coalesce(short, 0) AS shorted_items,
       coalesce(full_lines, 0) AS fully_picked_items, coalesce(avg_fill, 0) AS avg_fill_rate_pct,
       {f8("round(" + hours("created_at", "started_at") + ", 2)")} AS hours_to_pick_start,
       {f8("round(" + hours("started_at", "completed_at") + ", 2)")} AS picking_duration_hours, n IS NOT NULL AS has_items
FROM b_fulfillment_orders LEFT JOIN t_picks USING (fulfillment_id) LEFT JOIN b_locations ON location_id = warehouse_location_id
"""

MODELS_SQL["mart_fulfillment_pick_accuracy"] = f"""
SELECT fulfillment_id, assigned_to_name AS picker_name, status AS fulfillment_status, n AS total_line_items, asked AS total_qty_requested,
       picked AS total_qty_picked, full_lines AS fully_picked_lines, short AS shorted_lines, avg_fill AS avg_fill_rate_pct, short = 0 AS is_perfect_order,
       avg_short_fill AS avg_shorted_line_fill_pct, {pct("picked", "asked", 1)} AS total_fill_rate_pct, {pct("full_lines", "n", 1)} AS perfect_line_rate_pct,
       CASE WHEN asked > picked THEN asked - picked END AS total_qty_shorted
FROM t_picks LEFT JOIN b_fulfillment_orders USING (fulfillment_id)
"""

# ------------------------------------------------------------------ transport

HELPERS["t_trips"] = """
SELECT l.* EXCLUDE (license_plate), t.license_plate, make, model, capacity_pallets, t.is_active AS truck_is_active, full_name AS driver_name, hourly_rate,
       w.location_name AS warehouse_name, s.location_name AS store_name, s.city AS store_city, s.state AS store_state,
       CAST(hours_in_transit * hourly_rate AS DECIMAL(18,6)) AS labor, CAST(NULL AS DOUBLE) AS route_cost,
       l.warehouse_location_id || '->' || destination_location_id AS route_key,
       arrived_at IS NOT NULL AND departed_at IS NOT NULL AS done,
       coalesce(arrived_at <= departed_at + INTERVAL 24 HOUR, false) AS quick
FROM b_loads l LEFT JOIN b_trucks t USING (truck_id) LEFT JOIN b_employees e ON employee_id = driver_id
LEFT JOIN b_locations w ON w.location_id = l.warehouse_location_id LEFT JOIN b_locations s ON s.location_id = destination_location_id
"""

MODELS_SQL["int_transport_enriched"] = f"""
SELECT load_id, truck_id, license_plate, make, model, capacity_pallets, truck_is_active, driver_id, driver_name, {dbl("hourly_rate")},
       warehouse_location_id, warehouse_name, destination_location_id, store_name, store_city, store_state, route_key, departed_at, arrived_at, status,
       {dbl("hours_in_transit")}, load_date, distance_miles, {f8("labor")} AS estimated_labor_cost, route_cost
FROM t_trips
"""

MODELS_SQL["mart_fleet_cost"] = f"""
SELECT truck_id, license_plate, make, model, capacity_pallets, truck_is_active, driver_id, driver_name, {dbl("hourly_rate")}, count(*) AS total_loads,
       count(*) FILTER (status = 'delivered') AS delivered_loads, {f8("sum(hours_in_transit)")} AS total_hours_in_transit,
       {f8("sum(labor)")} AS estimated_labor_cost, sum(distance_miles) AS total_distance_miles, sum(route_cost) AS total_route_cost,
       {rnd(avg("hours_in_transit"), 2)} AS avg_hours_per_load, {AS_OF} AS as_of_date
FROM t_trips GROUP BY ALL
"""

MODELS_SQL["mart_fleet_utilization"] = f"""
SELECT truck_id, t.license_plate, t.make, t.model, year, t.capacity_pallets, t.is_active, count(load_id) AS total_loads, count(*) FILTER (done) AS completed_loads,
       count(*) FILTER (status = 'cancelled') AS cancelled_loads, {f8("sum(hours_in_transit)")} AS total_hours_in_transit,
       {avg("hours_in_transit")} AS avg_hours_per_load, {pct("count(*) FILTER (done AND quick)", "count(load_id)", 1)} AS on_time_rate_pct,
       min(load_date) AS first_load_date, max(load_date) AS last_load_date, {f8("sum(labor)")} AS total_estimated_labor_cost,
       {avg("hourly_rate")} AS avg_driver_hourly_rate, {rat("sum(hours_in_transit)", "count(load_id)", 2)} AS hours_per_load,
       CASE WHEN t.is_active <> 'true' THEN 'INACTIVE' WHEN count(load_id) = 0 THEN 'IDLE' ELSE 'ACTIVE' END AS utilization_status
FROM b_trucks t LEFT JOIN t_trips USING (truck_id) GROUP BY 1, 2, 3, 4, 5, 6, 7
"""

MODELS_SQL["mart_route_efficiency"] = f"""
SELECT route_key, warehouse_location_id, warehouse_name, destination_location_id, store_name, store_city, store_state, count(*) AS total_loads,
       count(*) FILTER (status = 'delivered') AS delivered_loads, count(*) FILTER (status LIKE 'cancelled%') AS cancelled_loads,
       {avg("hours_in_transit")} AS avg_transit_hours, {f8("sum(hours_in_transit)")} AS total_transit_hours, {f8("sum(labor)")} AS estimated_route_cost_labor,
       sum(distance_miles) AS total_distance_miles, sum(route_cost) AS total_route_cost, CAST(NULL AS DOUBLE) AS avg_cost_per_mile,
       {pct("count(*) FILTER (done AND quick)", "count(*)", 1)} AS on_time_rate_pct,
       {pct("count(*) FILTER (status = 'delivered')", "count(*)", 1)} AS completion_rate_pct, {AS_OF} AS as_of_date
FROM t_trips GROUP BY ALL
"""

MODELS_SQL["mart_transport_daily_metrics"] = f"""
SELECT load_date, t.warehouse_location_id, location_name AS warehouse_name, count(load_id) AS total_loads, count(*) FILTER (done) AS completed_loads,
       count(*) FILTER (status IN ('cancelled', 'cancelled_missing_stock')) AS cancelled_loads,
       count(*) FILTER (departed_at IS NULL AND NOT starts_with(status, 'cancel')) AS pending_loads, count(*) FILTER (done AND quick) AS on_time_loads,
       {rnd(avg("hours_in_transit"), 2)} AS avg_transit_hours, {f8("coalesce(sum(hours_in_transit), 0)")} AS total_transit_hours,
       min(departed_at) AS first_departure, max(arrived_at) AS last_arrival, count(DISTINCT truck_id) AS active_trucks,
       {f8("CASE WHEN load_date IS NOT NULL THEN sum(labor) END")} AS total_estimated_labor_cost,
       {pct("count(*) FILTER (done AND quick)", "count(*) FILTER (done)", 1)} AS on_time_rate_pct,
       {pct("count(*) FILTER (done)", "count(load_id)", 1)} AS completion_rate_pct
FROM t_trips t LEFT JOIN b_locations w ON w.location_id = t.warehouse_location_id AND w.location_type = 'warehouse' GROUP BY 1, 2, 3
"""

MODELS_SQL["mart_transport_load_summary"] = f"""
SELECT load_id, truck_id, license_plate, make || ' ' || model AS truck_model, year AS truck_year, t.capacity_pallets, driver_id, driver,
       from_warehouse AS warehouse_name, w.location_id AS warehouse_location_id, to_store AS store_name, s.location_id AS store_location_id,
       departed_at, arrived_at, {dbl("hours_in_transit")}, status, load_date, departed_at IS NOT NULL OR arrived_at IS NOT NULL AS has_departed,
       arrived_at IS NOT NULL AS has_arrived, done AND quick AS is_on_time, TIMESTAMP '2024-02-01 00:00:00' AS _extracted_at
FROM t_trips t LEFT JOIN (SELECT truck_id, year FROM b_trucks) USING (truck_id)
LEFT JOIN b_locations w ON w.location_id = warehouse_location_id LEFT JOIN b_locations s ON s.location_id = destination_location_id
"""

# ------------------------------------------------------------------ labour

HELPERS["t_breaks_by_rank"] = f"""
SELECT employee_id, event_date, location_id, sum(epoch_us(e) - epoch_us(s)) AS micros
FROM (SELECT employee_id, event_date, location_id, event_dt AS s, row_number() OVER (PARTITION BY ALL_KEYS ORDER BY event_dt) AS n
      FROM b_clock_events WHERE event_type = 'break_start')
JOIN (SELECT employee_id, event_date, location_id, event_dt AS e, row_number() OVER (PARTITION BY ALL_KEYS ORDER BY event_dt) AS n
      FROM b_clock_events WHERE event_type = 'break_end') USING (employee_id, event_date, location_id, n)
GROUP BY ALL
""".replace("ALL_KEYS", "employee_id, event_date, location_id")

HELPERS["t_clock_days"] = f"""
SELECT *, {hours("clock_in_at", "clock_out_at")} AS clocked
FROM (
  SELECT employee_id, event_date, location_id, min(event_dt) FILTER (event_type = 'clock_in') AS clock_in_at,
         max(event_dt) FILTER (event_type = 'clock_out') AS clock_out_at, count(*) FILTER (event_type = 'clock_in') AS ins,
         count(*) FILTER (event_type = 'clock_out') AS outs, count(*) FILTER (event_type = 'break_start') AS starts,
         count(*) FILTER (event_type = 'break_end') AS ends
  FROM b_clock_events GROUP BY ALL)
"""

MODELS_SQL["int_hr_labor_enriched"] = f"""
SELECT employee_id, scheduled_date, location_id, coalesce(x.department, e.department) AS department, full_name, job_title, {dbl("hourly_rate")}, shift_start,
       shift_end, {dbl("scheduled_hours", "schedule_actual_hours")}, schedule_status, clock_in_at, clock_out_at, {f8("clocked")} AS total_clocked_hours,
       {f8("rest")} AS total_break_hours, {f8("clocked")} AS net_hours_worked, ins > 0 AND outs > 0 AS has_complete_pair, ins <> outs AS has_unpaired_events,
       location_name, city, state, location_type, coalesce({clock("clock_in_at")} > (shift_start + 300) % 86400, false) AS is_late_arrival,
       coalesce(clocked > scheduled_hours * 1.25, false) AS is_overtime, coalesce(ins > 0 AND outs > 0 AND rest >= 0.5, false) AS is_break_compliant,
       CASE WHEN ins IS NULL THEN 'NO_SHOW' WHEN schedule_status IS NULL THEN 'UNSCHEDULED' WHEN clocked IS NULL THEN 'UNKNOWN'
            WHEN clocked * 10 >= scheduled_hours * 9 THEN 'ATTENDED' WHEN clocked * 2 < scheduled_hours THEN 'PARTIAL' ELSE 'SHORT' END AS attendance_status,
       {f8("round(clocked * hourly_rate, 2)")} AS employee_cost, {pct("clocked", "scheduled_hours", 1)} AS hours_attainment_pct
FROM (
  SELECT coalesce(s.employee_id, c.employee_id) AS employee_id, coalesce(s.scheduled_date, c.event_date) AS scheduled_date,
         coalesce(s.location_id, c.location_id) AS location_id, s.department, shift_start, shift_end, scheduled_hours,
         actual_hours AS schedule_actual_hours, s.status AS schedule_status, clock_in_at, clock_out_at, clocked, ins, outs,
         CASE WHEN c.ins IS NOT NULL THEN CAST(coalesce(micros, 0) / 3.6e9 AS DECIMAL(18,8)) END AS rest
  FROM b_schedules s FULL JOIN (SELECT * FROM t_clock_days LEFT JOIN t_breaks_by_rank USING (employee_id, event_date, location_id)) c
    ON c.employee_id = s.employee_id AND c.event_date = s.scheduled_date AND c.location_id = s.location_id) x
LEFT JOIN b_employees e USING (employee_id) LEFT JOIN b_locations l ON l.location_id = x.location_id
""".replace("SELECT employee_id, scheduled_date, location_id, coalesce(x", "SELECT employee_id, scheduled_date, x.location_id, coalesce(x")

MODELS_SQL["mart_attendance_compliance"] = f"""
SELECT *, {pct("no_show_shifts", "scheduled_shifts", 2)} AS no_show_rate_pct, {pct("late_arrival_shifts", "scheduled_shifts", 2)} AS late_arrival_rate_pct,
       {pct("overtime_shifts", "worked_shifts", 2)} AS overtime_rate_pct, {pct("break_compliant_shifts", "worked_shifts", 2)} AS break_compliance_rate_pct
FROM (
  SELECT scheduled_date AS report_date, location_id, department, count(*) AS scheduled_shifts,
         count(*) FILTER (attendance_status = 'NO_SHOW') AS no_show_shifts, count(*) FILTER (is_late_arrival) AS late_arrival_shifts,
         count(*) FILTER (is_overtime) AS overtime_shifts, count(*) FILTER (attendance_status NOT IN ('NO_SHOW', 'UNSCHEDULED', 'UNKNOWN')) AS worked_shifts,
         count(*) FILTER (is_break_compliant) AS break_compliant_shifts
  FROM t_int_hr_labor_enriched WHERE schedule_status IS NOT NULL GROUP BY ALL)
"""

HELPERS["t_breaks_by_lead"] = f"""
SELECT employee_id, event_date, count(*) AS pairs, {cents("sum(" + hours("event_dt", "next_dt") + ")")} AS rest
FROM (SELECT *, lead(event_dt) OVER w AS next_dt, lead(event_type) OVER w AS next_type FROM b_clock_events WHERE event_type LIKE 'break%'
      WINDOW w AS (PARTITION BY employee_id, event_date ORDER BY event_dt, event_id))
WHERE event_type = 'break_start' AND next_type = 'break_end' GROUP BY ALL
"""

HELPERS["t_attendance"] = f"""
SELECT *, CASE WHEN worked > 0 THEN {cents("worked - rest")} END AS net
FROM (
  SELECT c.*, coalesce(pairs, 0) AS pairs, {cents("coalesce(rest, 0)")} AS rest,
         {cents("coalesce(clocked + CASE WHEN " + clock("clock_out_at") + " <= " + clock("clock_in_at") + " THEN 24 ELSE 0 END, 0)")} AS worked
  FROM t_clock_days c LEFT JOIN t_breaks_by_lead USING (employee_id, event_date))
"""

MODELS_SQL["mart_attendance_summary"] = f"""
SELECT employee_id, event_date, location_id, clock_in_at, clock_out_at, {f8("worked")} AS total_clocked_hours, {f8("rest")} AS total_break_hours,
       {f8("net")} AS net_hours_worked, ins AS clock_in_count, outs AS clock_out_count, starts AS break_start_count, ends AS break_end_count,
       pairs AS completed_break_pairs, ins > 0 AND outs > 0 AS has_complete_pair, ins <> outs OR starts <> ends AS has_unpaired_events
FROM t_attendance
"""

MODELS_SQL["mart_daily_attendance_stats"] = f"""
SELECT event_date, a.location_id, location_name, count(DISTINCT employee_id) AS employees_present,
       count(DISTINCT employee_id) FILTER (ins > 0 AND outs > 0) AS employees_with_complete_pair,
       count(DISTINCT employee_id) FILTER (ins <> outs OR starts <> ends) AS employees_with_unpaired_events,
       count(DISTINCT employee_id) FILTER (department IS NOT NULL) AS employees_with_dept, {f8("sum(worked)")} AS total_clocked_hours,
       {f8("sum(rest)")} AS total_break_hours, {f8("sum(net)")} AS total_net_hours, {rat("sum(worked)", "count(DISTINCT employee_id)", 2)} AS avg_hours_per_employee,
       count(*) FILTER (ins > 1) AS multi_clock_in_count, count(*) FILTER (outs > 1) AS multi_clock_out_count,
       {rat("sum(rest)", "count(DISTINCT employee_id)", 2)} AS avg_break_hours_per_employee,
       CASE WHEN sum(worked) > 0 THEN {pct("sum(rest)", "sum(worked)", 1)} END AS break_pct_of_clocked
FROM t_attendance a LEFT JOIN (SELECT employee_id, department FROM b_employees) USING (employee_id)
LEFT JOIN b_locations l ON l.location_id = a.location_id GROUP BY 1, 2, 3
"""

HELPERS["t_dept_labor"] = f"""
SELECT scheduled_date, s.location_id, s.department, count(DISTINCT employee_id) AS staff, count(*) AS n, count(*) FILTER (s.status = 'completed') AS done,
       count(*) FILTER (s.status = 'called_out') AS out, count(*) FILTER (s.status = 'no_show') AS missed, {cents("sum(scheduled_hours)")} AS planned,
       {cents("sum(actual_hours)")} AS worked, {cents("sum(hourly_rate * scheduled_hours)")} AS planned_cost,
       {cents("coalesce(sum(hourly_rate * scheduled_hours) FILTER (s.status = 'completed'), 0)")} AS worked_cost
FROM b_schedules s LEFT JOIN b_employees USING (employee_id) WHERE s.status <> 'scheduled' GROUP BY 1, 2, 3
"""

MODELS_SQL["mart_department_labor"] = f"""
SELECT scheduled_date AS report_date, location_id, location_name, city, state, department, staff AS employees_scheduled, n AS total_shifts,
       done AS completed_shifts, out AS called_out_shifts, missed AS no_show_shifts, {pct("done", "n", 1)} AS attendance_rate_pct,
       {f8("planned")} AS scheduled_hours, {f8("worked")} AS actual_hours, {pct("worked", "planned", 1)} AS hours_utilization_pct,
       {f8("planned_cost")} AS scheduled_cost, {f8("worked_cost")} AS actual_cost, {f8("worked_cost - planned_cost")} AS cost_variance
FROM t_dept_labor LEFT JOIN b_locations USING (location_id)
"""

MODELS_SQL["mart_labor_cost_by_department"] = f"""
SELECT scheduled_date AS report_date, d.location_id, location_name, department, {f8("planned")} AS scheduled_hours, {f8("worked")} AS actual_hours,
       {f8("planned_cost")} AS scheduled_cost, {f8("worked_cost")} AS actual_cost, {f8("worked_cost - planned_cost")} AS cost_variance,
       {pct("done", "d.n", 1)} AS attendance_rate_pct, {f8("coalesce(net, 0)")} AS revenue_proxy,
       CASE WHEN net > 0 THEN {pct("worked_cost", "net", 2)} END AS labor_cost_pct_of_revenue
FROM t_dept_labor d LEFT JOIN b_locations USING (location_id) LEFT JOIN b_departments b ON lower(b.department_name) = lower(department)
LEFT JOIN t_dept_sales r ON r.transaction_date = scheduled_date AND r.location_id = d.location_id AND r.department_id = b.department_id
"""

MODELS_SQL["mart_labor_efficiency"] = f"""
SELECT scheduled_date, location_id, location_name, city, state, department, n AS shifts_scheduled, done AS shifts_completed, out AS shifts_called_out,
       missed AS shifts_no_show, 0 AS shifts_pending, {pct("done", "n", 1)} AS completion_rate_pct, {pct("missed", "n", 1)} AS no_show_rate_pct
FROM t_dept_labor LEFT JOIN b_locations USING (location_id)
"""

MODELS_SQL["mart_employee_cost"] = f"""
SELECT scheduled_date, employee_id, full_name, job_title, department, {dbl("hourly_rate")}, status, location_id, location_name, city, state, n AS shifts_scheduled,
       done AS shifts_completed, out AS shifts_called_out, missed AS shifts_no_show, {f8("planned")} AS scheduled_hours, {f8("planned_cost")} AS scheduled_labor_cost,
       {f8("worked")} AS actual_hours_worked, {f8("worked_cost")} AS actual_labor_cost, {f8("worked_cost - planned_cost")} AS cost_variance,
       {f8("revenue")} AS daily_revenue, CASE WHEN revenue > 0 THEN {pct("worked_cost", "revenue", 3)} END AS labor_pct_of_revenue
FROM (SELECT scheduled_date, employee_id, full_name, job_title, s.department, hourly_rate, e.status, s.location_id, count(*) AS n,
             count(*) FILTER (s.status = 'completed') AS done, count(*) FILTER (s.status = 'called_out') AS out, count(*) FILTER (s.status = 'no_show') AS missed,
             {cents("sum(scheduled_hours)")} AS planned, {cents("sum(scheduled_hours * hourly_rate)")} AS planned_cost,
             {cents("sum(actual_hours)")} AS worked, {cents("sum(actual_hours * hourly_rate)")} AS worked_cost
      FROM b_schedules s LEFT JOIN b_employees e USING (employee_id) WHERE s.status <> 'scheduled' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8)
LEFT JOIN b_locations USING (location_id)
LEFT JOIN (SELECT transaction_date AS scheduled_date, location_id, {cents("sum(total)")} AS revenue FROM b_transactions GROUP BY ALL) USING (scheduled_date, location_id)
"""

MODELS_SQL["mart_employee_hours_vs_schedule"] = f"""
SELECT report_date, employee_id, location_id, full_name, department, job_title, {dbl("hourly_rate")}, is_active, {dbl("scheduled_hours")},
       {f8("actual_hours")} AS schedule_actual_hours, shift_status AS schedule_status, {f8("worked")} AS total_clocked_hours, {f8("net")} AS net_hours_worked,
       {f8("rest")} AS total_break_hours, clock_in_at, clock_out_at, ins > 0 AND outs > 0 AS has_complete_pair, ins <> outs OR starts <> ends AS has_unpaired_events,
       CASE WHEN ins IS NULL THEN 'NO_SHOW' WHEN shift_status IS NULL THEN 'UNSCHEDULED' WHEN net IS NULL THEN 'UNKNOWN'
            WHEN net * 10 >= scheduled_hours * 9 THEN 'ATTENDED' WHEN net * 2 < scheduled_hours THEN 'PARTIAL' ELSE 'SHORT' END AS attendance_status,
       {pct("net", "scheduled_hours", 1)} AS hours_attainment_pct, {f8("round(net * hourly_rate, 2)")} AS estimated_labor_cost
FROM (SELECT coalesce(event_date, scheduled_date) AS report_date, coalesce(a.employee_id, s.employee_id) AS employee_id,
             coalesce(a.location_id, s.location_id) AS location_id, scheduled_hours, actual_hours, s.status AS shift_status, a.* EXCLUDE (employee_id, event_date, location_id)
      FROM t_attendance a FULL JOIN b_schedules s ON s.employee_id = a.employee_id AND scheduled_date = event_date AND s.location_id = a.location_id)
LEFT JOIN (SELECT employee_id, full_name, department, job_title, hourly_rate, is_active FROM b_employees) USING (employee_id)
"""

MODELS_SQL["mart_employee_productivity"] = f"""
SELECT sale_date, employee_id, full_name, department, job_title, {dbl("hourly_rate")}, status, x.location_id, location_name, city, state, n AS transaction_count,
       {f8("revenue")} AS total_revenue_processed, {f8("h")} AS hours_worked, CASE WHEN h > 0 THEN {rat("revenue", "h", 2)} END AS revenue_per_hour,
       CASE WHEN h > 0 THEN {rat("n", "h", 2)} END AS transactions_per_hour, {f8("round(hourly_rate * coalesce(h, 0), 2)")} AS estimated_labor_cost,
       CASE WHEN revenue > 0 THEN {pct("hourly_rate * coalesce(h, 0)", "revenue", 2)} END AS labor_cost_pct_revenue
FROM (SELECT transaction_date AS sale_date, employee_id, location_id, count(*) AS n, {cents("sum(total)")} AS revenue FROM b_transactions GROUP BY ALL) x
LEFT JOIN (SELECT * EXCLUDE (location_id) FROM b_employees) USING (employee_id) LEFT JOIN b_locations l ON l.location_id = x.location_id
LEFT JOIN (SELECT employee_id, event_date AS sale_date, {cents("round(" + hours("i", "o") + " - CASE WHEN b > 0 THEN 0.5 ELSE 0.0 END, 2)")} AS h
           FROM (SELECT employee_id, event_date, min(event_dt) FILTER (event_type = 'clock_in') AS i, max(event_dt) FILTER (event_type = 'clock_out') AS o,
                        count(*) FILTER (event_type = 'break_start') AS b FROM b_clock_events GROUP BY ALL) WHERE o > i) USING (employee_id, sale_date)
"""

# ------------------------------------------------------------------ stock and shrinkage

MODELS_SQL["int_shrinkage_attributed"] = f"""
SELECT event_id, product_id, product_name, sku, category, department_id, department_name, s.location_id, location_name, city, state, location_type,
       event_date, recorded_at, shrinkage_type, {dbl("quantity_lost", "estimated_value_lost")}
FROM b_shrink s LEFT JOIN b_products USING (product_id) LEFT JOIN b_locations l ON l.location_id = s.location_id
"""

MODELS_SQL["int_inventory_daily_snapshot"] = f"""
SELECT product_id, location_id, location_type, location_name, snapshot_date, qoh AS quantity_on_hand, {f8("rec")} AS receipts, {f8("lost")} AS shrinkage_units,
       {f8("lost_value")} AS shrinkage_value, {f8("sold")} AS sales_units,
       {f8("coalesce(lag(qoh) OVER (PARTITION BY product_id, location_id ORDER BY snapshot_date) - qoh + rec - sold + lost, 0)")} AS unexplained_variance
FROM (
  SELECT k.product_id, k.location_id, k.snapshot_date, coalesce(q, 0) AS qoh, coalesce(r, 0) AS rec, coalesce(u, 0) AS lost, coalesce(v, 0) AS lost_value, coalesce(s, 0) AS sold
  FROM (SELECT product_id, location_id, snapshot_date FROM t_counted UNION SELECT product_id, location_id, snapshot_date FROM t_received
        UNION SELECT product_id, location_id, snapshot_date FROM t_lost UNION SELECT product_id, location_id, snapshot_date FROM t_sold) k
  LEFT JOIN t_counted USING (product_id, location_id, snapshot_date) LEFT JOIN t_received USING (product_id, location_id, snapshot_date)
  LEFT JOIN t_lost USING (product_id, location_id, snapshot_date) LEFT JOIN t_sold USING (product_id, location_id, snapshot_date))
JOIN b_locations USING (location_id)
"""
HELPERS["t_counted"] = """
SELECT DISTINCT s.product_id, s.location_id, CAST(s.last_updated AS DATE) AS snapshot_date,
       (SELECT n.quantity_on_hand FROM b_stock n WHERE n.product_id = s.product_id AND n.location_id = s.location_id
        ORDER BY CAST(n.last_updated AS DATE) DESC, n.quantity_on_hand LIMIT 1) AS q
FROM b_stock s
"""
HELPERS["t_received"] = """
SELECT product_id, site_id AS location_id, CAST(received_dt AS DATE) AS snapshot_date, sum(quantity) AS r FROM b_receipt_items GROUP BY ALL
"""
HELPERS["t_lost"] = """
SELECT product_id, location_id, event_date AS snapshot_date, sum(quantity_lost) AS u, sum(estimated_value_lost) AS v FROM b_shrink GROUP BY ALL
"""
HELPERS["t_sold"] = """
SELECT product_id, location_id, CAST(transaction_dt AS DATE) AS snapshot_date, sum(quantity) AS s FROM b_items GROUP BY ALL
"""

HELPERS["t_deliveries"] = """
SELECT product_id, location_id, received_dt, receipt_id, quantity FROM b_receipt_items JOIN (SELECT receipt_id, location_id FROM b_receipts) USING (receipt_id)
"""

MODELS_SQL["mart_inventory_summary"] = f"""
SELECT stock_id, product_id, sku, product_name, category, location_id, location_name, city, state, quantity_on_hand, quantity_reserved, quantity_available,
       reorder_point, reorder_qty, supplier_name, is_below_reorder,
       CASE WHEN quantity_on_hand = 0 THEN 'OUT_OF_STOCK' WHEN is_below_reorder THEN 'REORDER' ELSE 'OK' END AS stock_status,
       last_receipt_dt, {f8("units")} AS total_units_received, last_updated
FROM b_stock LEFT JOIN b_locations USING (location_id)
LEFT JOIN (SELECT product_id, location_id, max(received_dt) AS last_receipt_dt, sum(quantity) AS units FROM t_deliveries GROUP BY ALL) USING (product_id, location_id)
"""

MODELS_SQL["mart_inventory_turnover"] = f"""
SELECT product_id, location_id, location_name, city, state, quantity_on_hand, quantity_available, reorder_point, is_below_reorder, last_receipt_dt,
       datediff('day', CAST(last_receipt_dt AS DATE), {AS_OF}) - CASE WHEN CAST(last_receipt_dt AS DATE) + (TIMESTAMP '2001-08-02' - CAST({AS_OF} AS TIMESTAMP)) < last_receipt_dt THEN 1 ELSE 0 END AS days_since_last_receipt,
       {f8("sold")} AS units_sold_30d, sold_days AS days_with_sales_30d, {f8("received")} AS total_units_received_60d, receipts AS receipt_count_60d,
       {dbl("unit_cost", "unit_price", "margin_pct")}, {f8("sold * (unit_price - unit_cost)")} AS gross_margin_proxy,
       greatest({f8("sold")} / 30.0, CAST(0.01 AS DOUBLE)) AS daily_sell_rate,
       CASE WHEN quantity_on_hand > 0 THEN {rnd("quantity_on_hand / greatest(" + f8("sold") + " / 30.0, CAST(0.01 AS DOUBLE))", 1)} END AS days_of_supply,
       CASE WHEN quantity_on_hand > 0 AND sold > 0 THEN {rnd(f8("sold") + " * 12 / quantity_on_hand", 1)} ELSE 0 END AS estimated_annual_turnover,
       CASE WHEN quantity_on_hand = 0 THEN 'OUT_OF_STOCK' WHEN sold = 0 THEN 'DEAD_STOCK' WHEN quantity_on_hand > sold * 2 THEN 'OVERSTOCKED'
            WHEN is_below_reorder THEN 'REORDER_NEEDED' WHEN last_receipt_dt IS NULL THEN 'NO_RECEIPT_HISTORY' ELSE 'HEALTHY' END AS stock_aging_category,
       last_updated
FROM (
  SELECT s.*, location_name, city, state, unit_cost, unit_price, margin_pct, last_receipt_dt, coalesce(sold, 0) AS sold, coalesce(sold_days, 0) AS sold_days,
         coalesce(received, 0) AS received, coalesce(receipts, 0) AS receipts
  FROM b_stock s JOIN (SELECT * FROM b_locations WHERE location_type = 'store') USING (location_id)
  LEFT JOIN (SELECT product_id, unit_cost, unit_price, margin_pct FROM b_products) USING (product_id)
  LEFT JOIN (SELECT product_id, location_id, max(received_dt) AS last_receipt_dt, sum(quantity) FILTER (received_dt >= {AS_OF} - 60) AS received,
                    count(DISTINCT receipt_id) FILTER (received_dt >= {AS_OF} - 60) AS receipts FROM t_deliveries GROUP BY ALL) USING (product_id, location_id)
  LEFT JOIN (SELECT product_id, location_id, sum(quantity) AS sold, count(DISTINCT CAST(transaction_dt AS DATE)) AS sold_days FROM b_items
             WHERE transaction_dt >= {AS_OF} - 30 GROUP BY ALL) USING (product_id, location_id))
"""

MODELS_SQL["mart_inventory_valuation"] = f"""
SELECT location_id, location_name, location_type, department_id, department_name, {big("sum(quantity_on_hand)")} AS units_on_hand,
       {big("sum(quantity_available)")} AS units_available, {f8(cents("sum(quantity_on_hand * unit_cost)"))} AS value_on_hand_cost,
       {f8(cents("sum(quantity_available * unit_cost)"))} AS value_available_cost, {AS_OF} AS as_of_date
FROM b_stock LEFT JOIN (SELECT product_id, department_id, department_name, unit_cost FROM b_products) USING (product_id) LEFT JOIN b_locations USING (location_id)
GROUP BY ALL
"""

MODELS_SQL["mart_shrink_analysis"] = f"""
SELECT event_date, location_id, location_name, city, state, product_id, product_name, sku, category, shrinkage_type, count(*) AS event_count,
       {f8("sum(quantity_lost)")} AS total_quantity_lost, {f8(cents("sum(estimated_value_lost)"))} AS total_value_lost
FROM b_shrink LEFT JOIN b_locations USING (location_id) LEFT JOIN b_products USING (product_id) GROUP BY ALL
"""

MODELS_SQL["mart_shrinkage_analysis"] = f"""
SELECT event_date, location_id, location_name, location_type, department_id, department_name, category, shrinkage_type, n AS event_count,
       {f8("qty")} AS total_quantity_lost, {f8("val")} AS total_value_lost, {f8(cents("sum(val) OVER d"))} AS dept_value_lost,
       CASE WHEN sum(val) OVER d > 0 THEN {pct("val", "sum(val) OVER d", 2)} ELSE 0 END AS pct_of_dept_value_lost
FROM (SELECT event_date, location_id, location_name, location_type, department_id, department_name, category, shrinkage_type, count(*) AS n,
             sum(quantity_lost) AS qty, sum(estimated_value_lost) AS val
      FROM b_shrink LEFT JOIN b_locations USING (location_id) LEFT JOIN b_products USING (product_id) GROUP BY ALL)
WINDOW d AS (PARTITION BY event_date, location_id, department_id)
"""

_CAUSES = ("expired", "spoilage", "damaged", "theft")
HELPERS["t_dept_lost"] = f"""
SELECT event_date, location_id, department_id, {big("sum(n)")} AS n, sum(qty) AS qty, sum(val) AS val,
       {", ".join(f"sum(val) FILTER (shrinkage_type = '{c}') AS {c}" for c in _CAUSES)}
FROM (SELECT event_date, location_id, m.department_id, shrinkage_type, count(*) AS n, sum(quantity_lost) AS qty, {cents("sum(estimated_value_lost)")} AS val
      FROM b_shrink s LEFT JOIN (SELECT product_id, department_id FROM b_items GROUP BY ALL) m USING (product_id) GROUP BY ALL)
GROUP BY ALL
"""
MODELS_SQL["mart_department_shrinkage"] = f"""
SELECT report_date, location_id, location_name, department_id, department_name, {f8(cents("coalesce(net, 0)"))} AS net_revenue, {f8("coalesce(units, 0)")} AS units_sold,
       coalesce(lost_n, 0) AS shrink_event_count, {f8("coalesce(qty, 0)")} AS total_qty_lost, {f8("coalesce(val, 0)")} AS total_value_lost,
       {", ".join(f"{f8(f'coalesce({c}, 0)')} AS {c}_value_lost" for c in _CAUSES)}, CASE WHEN net > 0 THEN {pct("val", "net", 3)} END AS shrink_pct_of_revenue
FROM (SELECT coalesce(transaction_date, event_date) AS report_date, coalesce(r.location_id, s.location_id) AS location_id,
             coalesce(r.department_id, s.department_id) AS department_id, net, units, s.n AS lost_n, qty, val, {", ".join(_CAUSES)}
      FROM t_dept_sales r FULL JOIN t_dept_lost s ON event_date = transaction_date AND s.location_id = r.location_id AND s.department_id = r.department_id)
LEFT JOIN b_locations USING (location_id) LEFT JOIN b_departments USING (department_id)
"""

_WEEK = "CAST(date_trunc('week', {}) AS DATE)".format
MODELS_SQL["mart_store_weekly_summary"] = f"""
SELECT week_start, location_id, location_name, city, state, coalesce(n, 0) AS transaction_count, {f8("coalesce(revenue, 0)")} AS total_revenue,
       coalesce(mean_total, 0) AS avg_transaction_value, coalesce(active, 0) AS days_with_sales, coalesce(loyal, 0) AS loyalty_transaction_count,
       coalesce(events, 0) AS shrink_event_count, {f8("coalesce(qty, 0)")} AS shrink_qty_lost, {f8("coalesce(val, 0)")} AS shrink_value_lost,
       below AS below_reorder_count, gone AS out_of_stock_count, coalesce(placed, 0) AS orders_placed, coalesce(delivered, 0) AS orders_delivered,
       {f8("coalesce(worked, 0)")} AS total_labor_hours, {f8("coalesce(cost, 0)")} AS total_labor_cost,
       CASE WHEN cost > 0 THEN {pct("cost", "coalesce(revenue, 0)", 2)} END AS labor_cost_pct_of_revenue,
       CASE WHEN revenue > 0 THEN {pct("coalesce(val, 0)", "revenue", 2)} END AS shrink_pct_of_revenue
FROM (SELECT g.week_start, g.location_id, location_name, city, state, count(*) FILTER (is_below_reorder) AS below, count(*) FILTER (quantity_on_hand = 0) AS gone
      FROM (SELECT * FROM (SELECT DISTINCT {_WEEK("transaction_date")} AS week_start FROM b_transactions), (SELECT * FROM b_locations WHERE location_type = 'store')) g
      LEFT JOIN b_stock s ON s.location_id = g.location_id AND last_updated <= week_start + INTERVAL 7 DAY GROUP BY ALL)
LEFT JOIN (SELECT {_WEEK("transaction_date")} AS week_start, location_id, count(*) AS n, sum(total) AS revenue, {avg("total")} AS mean_total,
                  count(DISTINCT transaction_date) AS active, count(DISTINCT member_id) AS loyal FROM b_transactions GROUP BY ALL) USING (week_start, location_id)
LEFT JOIN (SELECT {_WEEK("event_date")} AS week_start, location_id, count(*) AS events, sum(quantity_lost) AS qty, sum(estimated_value_lost) AS val
           FROM b_shrink GROUP BY ALL) USING (week_start, location_id)
LEFT JOIN (SELECT {_WEEK("order_date")} AS week_start, store_location_id AS location_id, count(*) AS placed, count(*) FILTER (status = 'delivered') AS delivered
           FROM b_store_orders GROUP BY ALL) USING (week_start, location_id)
LEFT JOIN (SELECT {_WEEK("scheduled_date")} AS week_start, location_id, sum(worked) AS worked, sum(worked_cost) AS cost FROM t_dept_labor GROUP BY ALL) USING (week_start, location_id)
"""

# ------------------------------------------------------------------ loyalty

MODELS_SQL["int_loyalty_enriched"] = f"""
SELECT m.member_id, tier AS current_tier, points_balance AS current_points_balance, signup_date, pt_id, p.transaction_id, points_earned, points_redeemed,
       reason, tier_changed, CAST(created_at AS DATE) AS activity_date, created_at AS activity_ts, transaction_date, {f8("total")} AS transaction_total
FROM b_members m LEFT JOIN b_points p ON p.member_id = m.member_id LEFT JOIN b_transactions t ON t.transaction_id = p.transaction_id
"""

HELPERS["t_member_pairs"] = f"""
SELECT m.member_id, first_name, last_name, email, tier AS loyalty_tier, points_balance, signup_date, count(DISTINCT t.transaction_id) AS total_transactions,
       {cents("sum(total)")} AS spend, {dec(avg("total"), 2)} AS mean_total, min(transaction_date) AS first_purchase_date,
       max(transaction_date) AS last_purchase_date, {big("sum(points_earned)")} AS lifetime_points_earned, count(*) FILTER (tier_changed) AS tier_upgrades
FROM b_members m LEFT JOIN b_transactions t ON t.member_id = m.member_id LEFT JOIN b_points p ON p.member_id = m.member_id GROUP BY 1, 2, 3, 4, 5, 6, 7
"""
MODELS_SQL["mart_loyalty_cohort"] = f"""
SELECT member_id, first_name, last_name, email, loyalty_tier, points_balance, signup_date, total_transactions, {f8("spend")} AS total_spend,
       {f8("mean_total")} AS avg_transaction_value, first_purchase_date, last_purchase_date, lifetime_points_earned, tier_upgrades,
       count(*) OVER t AS tier_total_members, {rnd(quo("sum(spend) OVER t", "count(spend) OVER t"), 2)} AS tier_avg_spend
FROM t_member_pairs WINDOW t AS (PARTITION BY loyalty_tier)
"""

MODELS_SQL["mart_loyalty_engagement"] = f"""
SELECT 'ALL' AS current_tier, CAST(NULL AS BIGINT) AS member_count, {pct("count(*) FILTER (recent)", "count(*)", 1)} AS active_rate_pct,
       {pct("(SELECT sum(points_redeemed) FROM t_int_loyalty_enriched)", "(SELECT sum(points_earned) FROM t_int_loyalty_enriched)", 1)} AS redemption_rate_pct,
       {big("coalesce(sum(points_balance) FILTER (points_balance > 0), 0)")} AS points_liability,
       (SELECT count(*) FILTER (tier_changed) FROM t_int_loyalty_enriched) AS tier_upgrades, count(*) AS total_members
FROM (SELECT m.member_id, points_balance, max(activity_date) >= (SELECT max(activity_date) FROM t_int_loyalty_enriched) - 90 AS recent
      FROM b_members m LEFT JOIN t_int_loyalty_enriched USING (member_id) GROUP BY 1, 2)
UNION ALL
SELECT tier, count(*), NULL, NULL, {big("sum(points_balance)")}, NULL, NULL FROM b_members GROUP BY tier
"""

MODELS_SQL["mart_loyalty_rfm"] = f"""
SELECT *, CASE WHEN recency_score >= 4 AND frequency_score >= 4 AND monetary_score >= 4 THEN 'Champions'
               WHEN recency_score >= 4 AND frequency_score >= 3 THEN 'Loyal' WHEN recency_score >= 3 AND frequency_score <= 2 THEN 'At Risk'
               WHEN recency_score <= 2 THEN 'Hibernating' ELSE 'Regular' END AS rfm_segment
FROM (
  SELECT member_id, tier, points_balance, signup_date, last_activity_date, snapshot_date, datediff('day', last_activity_date, snapshot_date) AS recency_days,
         coalesce(active_days, 0) AS active_days, coalesce(n, 0) AS frequency, {f8(cents("coalesce(spend, 0)"))} AS monetary,
         {big("coalesce(earned, 0)")} AS lifetime_points_earned, {big("coalesce(redeemed, 0)")} AS lifetime_points_redeemed,
         CASE WHEN snapshot_date - 30 <= last_activity_date THEN 5 WHEN snapshot_date - 90 <= last_activity_date THEN 4
              WHEN snapshot_date - 180 <= last_activity_date THEN 3 WHEN snapshot_date - 365 <= last_activity_date THEN 2 ELSE 1 END AS recency_score,
         ntile(5) OVER (ORDER BY coalesce(n, 0), member_id) AS frequency_score, ntile(5) OVER (ORDER BY coalesce(spend, 0), member_id) AS monetary_score
  FROM (SELECT *, (SELECT max(activity_date) FROM t_int_loyalty_enriched) AS snapshot_date FROM b_members)
  LEFT JOIN (SELECT member_id, max(activity_date) AS last_activity_date, count(DISTINCT activity_date) AS active_days, sum(points_earned) AS earned,
                    sum(points_redeemed) AS redeemed FROM t_int_loyalty_enriched GROUP BY ALL) USING (member_id)
  LEFT JOIN (SELECT member_id, count(DISTINCT transaction_id) AS n, sum(total) AS spend FROM b_transactions WHERE member_id IS NOT NULL GROUP BY ALL) USING (member_id))
"""

# ------------------------------------------------------------------ promotion and price

HELPERS["t_ad_sales"] = f"""
SELECT a.start_date AS ad_week_start, a.end_date AS ad_week_end, ad_name, i.product_id, ad_item_id IS NOT NULL AS is_ad_item, discount_pct, promoted_price,
       count(DISTINCT CAST(transaction_dt AS DATE)) AS days_active, sum(quantity) AS units, {cents("sum(line_total)")} AS revenue, {dec(avg("unit_price"), 2)} AS price
FROM b_items i JOIN b_ads a ON CAST(transaction_dt AS DATE) BETWEEN a.start_date AND a.end_date
LEFT JOIN b_ad_items x ON x.ad_id = a.ad_id AND x.product_id = i.product_id GROUP BY 1, 2, 3, 4, 5, 6, 7
"""
MODELS_SQL["mart_promotion_effectiveness"] = f"""
SELECT ad_week_start, ad_week_end, ad_name, product_id, product_name, category, is_ad_item, discount_pct, {dbl("promoted_price")}, days_active,
       {f8("units")} AS total_units_sold, {f8("revenue")} AS total_revenue, {f8("price")} AS avg_unit_price,
       coalesce({pct(f8("units") + " - base", "base", 2)}, 0) AS promo_lift_vs_baseline_pct
FROM t_ad_sales LEFT JOIN b_products USING (product_id)
LEFT JOIN (SELECT product_id, {avg("nullif(units, 0)")} AS base FROM t_ad_sales WHERE NOT is_ad_item GROUP BY ALL) USING (product_id)
"""

MODELS_SQL["mart_promotion_redemption"] = f"""
SELECT 'coupon' AS promotion_type, coupon_id AS promotion_id, code AS promotion_name, description, coupon_type AS promotion_detail, department_name, uses_count,
       max_uses, CASE WHEN max_uses > 0 THEN {pct("uses_count", "max_uses", 2)} END AS redemption_rate_pct, 0 AS attributed_txn_count, 0 AS attributed_item_count,
       CAST(0 AS DOUBLE) AS attributed_item_total, valid_from, valid_until, is_active, (SELECT count(*) FROM b_transactions WHERE has_coupon) AS coupon_txn_count,
       (SELECT {f8("sum(coupon_savings)")} FROM b_transactions) AS coupon_total_savings, CAST(NULL AS BIGINT) AS combo_txn_count, CAST(NULL AS DOUBLE) AS combo_total_savings
FROM b_coupons
UNION ALL
SELECT 'combo_deal', deal_id, deal_name, description, deal_type, trigger_department_name, NULL, NULL, NULL, 0, 0, 0, valid_from, valid_until, true, NULL, NULL,
       (SELECT count(*) FROM b_transactions WHERE has_deal), (SELECT {f8("sum(deal_savings)")} FROM b_transactions)
FROM b_deals
"""

HELPERS["t_month_sales"] = """
SELECT product_id, CAST(date_trunc('month', sale_date) AS DATE) AS sale_month, sum(quantity) AS units, sum(line_total) AS revenue,
       CASE WHEN sum(quantity) > 0 THEN PRICE END AS price
FROM (SELECT product_id, CAST(transaction_dt AS DATE) AS sale_date, quantity, line_total FROM b_items) s
ASOF LEFT JOIN (SELECT product_id, changed_date, new_price FROM b_price_history) h ON h.product_id = s.product_id AND h.changed_date <= s.sale_date
GROUP BY 1, 2
""".replace("SELECT product_id, CAST(date_trunc", "SELECT s.product_id, CAST(date_trunc").replace(
    "PRICE", dec(quo("sum(quantity * new_price)", "sum(quantity)"), 10)
)
MODELS_SQL["mart_product_price_elasticity"] = f"""
SELECT product_id, sale_month, {f8("units")} AS units_sold, {f8("revenue")} AS revenue, {f8("price")} AS effective_price, {f8("prev_units")} AS prev_units,
       {f8("prev_price")} AS prev_price,
       CASE WHEN prev_price > 0 AND prev_units > 0 AND price <> prev_price
            THEN {rnd(quo(quo("units - prev_units", "prev_units"), quo("price - prev_price", "prev_price")), 4)} END AS price_elasticity
FROM (SELECT *, lag(units) OVER w AS prev_units, lag(price) OVER w AS prev_price FROM t_month_sales WINDOW w AS (PARTITION BY product_id ORDER BY sale_month))
"""
