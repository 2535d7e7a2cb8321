"""Check queries for metrics, dashboards, quality checks and loads."""

from __future__ import annotations

from oracles.base import STAMP
from oracles.sql import dbl, f8, money, quo
from tillhouse.plans import suite
from tillhouse.plans.charts import BORROWED, CHARTS, HEADLINES, Chart
from tillhouse.plans.metrics import MARTS, MEASURES, METRICS, Measure
from tillhouse.plans.quality import ORPHAN_KEYS, PROPAGATED, Rule, select_rules
from tillhouse.plans.registry import MODELS
from tillhouse.plans.warehouse import LAID_OUT
from tillhouse.sources.raw_tables import RAW_TABLES

# Raw table -> the table that holds its rows here.
RAW_AS = {
    "raw_hr.locations": "b_locations",
    "raw_hr.employees": "b_employees",
    "raw_hr.schedules": "b_schedules",
    "raw_pos.departments": "b_departments",
    "raw_pos.products": "b_products",
    "raw_pos.price_history": "b_price_history",
    "raw_pos.coupons": "b_coupons",
    "raw_pos.combo_deals": "b_deals",
    "raw_pos.loyalty_members": "b_members",
    "raw_pos.loyalty_point_transactions": "b_points",
    "raw_pos.transactions": "b_transactions",
    "raw_pos.transaction_items": "b_items",
    "raw_timeclock.events": "b_clock_events",
    "raw_ordering.store_orders": "b_store_orders",
    "raw_ordering.store_order_items": "b_store_order_items",
    "raw_fulfillment.orders": "b_fulfillment_orders",
    "raw_fulfillment.items": "b_fulfillment_items",
    "raw_transport.trucks": "b_trucks",
    "raw_transport.loads": "b_loads",
    "raw_transport.load_items": "b_load_items",
    "raw_inv.products": "b_inv_products",
    "raw_inv.stock_levels": "b_stock",
    "raw_inv.receipts": "b_receipts",
    "raw_inv.receipt_items": "b_receipt_items",
    "raw_inv.shrinkage_events": "b_shrink",
    "raw_pricing.weekly_ads": "b_ads",
    "raw_pricing.ad_items": "b_ad_items",
}
RAW_COLUMN = {"shrinkage_id": "event_id"}


def table_name(name: str) -> str:
    return RAW_AS.get(name, f"t_{name}")


def exact_sum(column: str) -> str:
    """Durations carry eight places, amounts at most six."""
    scale = 10 if "hours" in column or "days" in column else 6
    return f"sum(CAST({column} AS DECIMAL(28,{scale})))"


def exact_avg(column: str) -> str:
    return quo(exact_sum(column), f"count({column})")


# ---- metrics


def _measure(m: Measure) -> str:
    if m.aggregate == "flags":
        return f8(f"count(*) FILTER ({m.column})")
    if m.aggregate == "count":
        return f8(f"count({m.column})")
    return f8(exact_sum(m.column)) if m.aggregate == "sum" else exact_avg(m.column)


def _grouped(
    mart: str, values: dict[str, Measure], group_by: list[str], grain: str | None, time_column: str | None = None
) -> str:
    spec = MARTS[mart]
    columns = [f"CAST(date_trunc('{grain}', {time_column or spec.time_column}) AS DATE) AS metric_time"] if grain else []
    columns += [f"{spec.entities.get(g, g)} AS {g}" for g in group_by]
    columns += [f"{_measure(m)} AS {name}" for name, m in values.items()]
    grouping = f" GROUP BY {', '.join(str(i + 1) for i in range(len(group_by) + bool(grain)))}" if group_by or grain else ""
    return f"SELECT {', '.join(columns)} FROM t_{mart}{grouping}"


def metric_sql(names: list[str], group_by: list[str], grain: str | None) -> str:
    needed: dict[str, dict[str, Measure]] = {}
    for name in names:
        metric = METRICS[name]
        for part in (name,) if metric.kind == "simple" else (metric.numerator, metric.denominator):
            measure = MEASURES[METRICS[part].measure]
            needed.setdefault(measure.mart, {})[part] = measure
    keys = (["metric_time"] if grain else []) + group_by
    texts = [_grouped(mart, values, group_by, grain) for mart, values in needed.items()]
    merged = " UNION ALL BY NAME ".join(f"({t})" for t in texts)
    every = [part for values in needed.values() for part in values]
    source = f"SELECT {', '.join(keys)}, {', '.join(f'max({p}) AS {p}' for p in every)} FROM ({merged}) GROUP BY ALL"
    shown = [
        f"{quo(METRICS[n].numerator, METRICS[n].denominator)} AS {n}" if METRICS[n].kind == "ratio" else n for n in names
    ]
    return f"SELECT {', '.join(keys + shown)} FROM ({source})"


def series_sql(name: str, group_by: list[str], grain: str) -> str:
    metric = METRICS[name]
    measure = MEASURES[metric.measure or METRICS[metric.base].measure]
    daily = f"(SELECT * FROM ({_grouped(measure.mart, {'v': measure}, group_by, 'day')}) WHERE metric_time IS NOT NULL)"
    groups = "".join(f", a.{g}" for g in group_by)
    if metric.kind == "offset":
        same = "".join(f" AND a.{g} IS NOT DISTINCT FROM b.{g}" for g in group_by)
        if grain != "day":
            listed = "".join(f", {g}" for g in group_by)
            now = f"(SELECT CAST(date_trunc('{grain}', metric_time) AS DATE) AS metric_time{listed}, {exact_sum('v')} AS v FROM {daily} GROUP BY ALL)"
            then = now.replace("metric_time) AS DATE)", f"metric_time + {metric.days}) AS DATE)")
            return f"""
SELECT a.metric_time{groups}, {f8("CAST(a.v AS DECIMAL(28,6)) - CAST(b.v AS DECIMAL(28,6))")} AS {name}
FROM {now} a JOIN {then} b ON b.metric_time = a.metric_time{same}"""
        return f"""
SELECT a.metric_time{groups}, {f8("CAST(a.v AS DECIMAL(28,6)) - CAST(b.v AS DECIMAL(28,6))")} AS {name}
FROM {daily} a JOIN {daily} b ON b.metric_time = a.metric_time - {metric.days}{same}"""
    days = f"""
SELECT CAST(d AS DATE) AS metric_time{groups}, {f8(exact_sum("a.v"))} AS {name}
FROM (SELECT unnest(generate_series(min(metric_time), max(metric_time), INTERVAL 1 DAY)) AS d FROM {daily}) s
JOIN {daily} a ON a.metric_time <= d AND date_trunc('{metric.period}', a.metric_time) = date_trunc('{metric.period}', d)
GROUP BY ALL"""
    if grain == "day":
        return days
    listed = "".join(f", {g}" for g in group_by)
    return f"SELECT CAST(date_trunc('{grain}', metric_time) AS DATE) AS metric_time{listed}, arg_max({name}, metric_time) AS {name} FROM ({days}) GROUP BY 1{listed}"


def metrics_sql() -> dict[str, str]:
    found = {key: metric_sql(*spec) for key, spec in suite.METRIC_SLICES.items()}
    found |= {key: series_sql(*spec) for key, spec in suite.SERIES_SLICES.items()}
    for key, (names, group_by, grain, time_column) in suite.MEASURE_SLICES.items():
        values = {n: MEASURES[n] for n in names}
        found[key] = _grouped(next(iter(values.values())).mart, values, group_by, grain, time_column)
    return found


# ---- dashboards


def _chart_metric(aggregate: str, column: str) -> str:
    return {
        "SUM": exact_sum(column),
        "AVG": exact_avg(column),
        "COUNT": f"count({column})",
        "COUNT_DISTINCT": f"count(DISTINCT {column})",
    }[aggregate]


def chart_sql(chart: Chart) -> str:
    keys = list(chart.group_by)
    columns = list(chart.group_by)
    if chart.grain:
        keys.insert(0, chart.time_column)
        columns.insert(0, f"CAST(date_trunc('{chart.grain}', {chart.time_column}) AS DATE) AS {chart.time_column}")
    values = {m.name: _chart_metric(m.aggregate, m.column) for m in chart.metrics}
    shown = [f"{f8(v) if not n.startswith('count') else v} AS {n}" for n, v in values.items()]
    where = ""
    for f in chart.filters:
        test = {
            "==": f"{f.column} = {str(f.values[0]).lower() if f.values else ''}",
            "in": f"{f.column} IN ({', '.join(repr(v) for v in f.values)})",
            "is not null": f"{f.column} IS NOT NULL",
        }[f.op]
        where = f" WHERE {test}"
    source = f"t_{chart.mart}"
    for column in chart.group_by:
        if (chart.mart, column) in BORROWED:
            sibling, key = BORROWED[chart.mart, column]
            source += f" LEFT JOIN (SELECT {key}, {column} FROM t_{sibling}) USING ({key})"
    text = f"SELECT {', '.join(columns + shown)} FROM {source}{where}"
    if not keys:
        return text
    numbers = [str(i + 1) for i in range(len(keys))]
    first = next(iter(values.values()))
    order = ", ".join([f"{first} DESC NULLS FIRST", *[f"{n} ASC NULLS FIRST" for n in numbers]])
    return f"{text} GROUP BY {', '.join(numbers)} ORDER BY {order}" + (f" LIMIT {chart.limit}" if chart.limit else "")


def dashboards_sql() -> dict[str, str]:
    found = {suite.chart_key(chart): chart_sql(chart) for chart in CHARTS.values()}
    grid = CHARTS[79]
    x, y = grid.group_by
    cells = ", ".join(
        f"{f8(exact_sum(grid.metrics[0].column) + f' FILTER ({y} = {name!r})')} AS {name}" for name in suite.sales.DAY_NAMES
    )
    found["b06_peak_hours_heatmap"] = f"SELECT {x}, {cells} FROM t_{grid.mart} GROUP BY {x}"
    rows = []
    for kpi, number in HEADLINES.items():
        chart = CHARTS[number]
        value = f8(_chart_metric(chart.metrics[0].aggregate, chart.metrics[0].column))
        where = " WHERE current_tier = 'ALL'" if kpi == "points_liability" else ""
        rows.append(f"SELECT '{kpi}' AS kpi, {value} AS value FROM t_{chart.mart}{where}")
    found["b07_headline_kpis"] = " UNION ALL ".join(rows)
    return found


# ---- quality


def _failures(rule: Rule) -> str:
    table, column = table_name(rule.table), RAW_COLUMN.get(rule.column, rule.column)
    if rule.check == "unique":
        return f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
    if rule.check == "relationships":
        parent, key = rule.args
        return (
            f"(SELECT count(*) FROM {table} c WHERE {column} IS NOT NULL"
            f" AND NOT EXISTS (SELECT 1 FROM {table_name(parent)} p WHERE p.{key} = c.{column}))"
        )
    if rule.check == "row_count":
        return f"(SELECT CASE WHEN count(*) BETWEEN {rule.args[0]} AND {rule.args[1]} THEN 0 ELSE 1 END FROM {table})"
    condition = {
        "not_null": lambda: f"{column} IS NULL",
        "accepted_values": lambda: f"{column} NOT IN ({', '.join(repr(v) for v in rule.args)})",
        "between": lambda: " OR ".join(f"{column} {op} {v}" for op, v in zip("<>", rule.args)),
        "pair": lambda: f"NOT ({column} {rule.args[0]} {rule.args[1]})",
    }[rule.check]()
    return f"(SELECT count(*) FROM {table} WHERE {condition})"


def _rules_sql(rules: list[Rule]) -> str:
    rows = []
    for rule in rules:
        column = " ".join([rule.column, *rule.args]) if rule.check == "pair" else rule.column
        rows.append(
            f"SELECT '{rule.check}' AS \"check\", '{rule.table}' AS \"table\", '{column}' AS \"column\","
            f" '{rule.severity}' AS severity, {_failures(rule)} AS failures"
        )
    return " UNION ALL ".join(rows)


def _orphans() -> str:
    return " UNION ALL ".join(
        f"SELECT '{child}.{column} -> {parent}.{key}' AS fk_name, count(*) FILTER (p.{key} IS NULL) AS orphan_count"
        f" FROM {table_name(child)} c LEFT JOIN (SELECT DISTINCT {key} FROM {table_name(parent)}) p ON c.{column} = p.{key}"
        for child, column, parent, key in ORPHAN_KEYS
    )


def _counts(names: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {table_name(n)}" for n in names)


#: The key of each staging table.
STAGED_KEYS = {r.table: r.column for r in reversed(select_rules("unique", "staging"))}


def _damaged(name: str) -> str:
    """A staging table with the known faults, else the table as it is."""
    if name not in STAGED_KEYS:
        return table_name(name)
    last = f"right({STAGED_KEYS[name]}, 1)"
    changed = [f"CASE WHEN {last} <> '5' THEN {column} END AS {column}" for child, column, _, _ in ORPHAN_KEYS if child == name]
    if name == "stg_pos_transaction_items":
        changed.append(f"line_total + CASE WHEN {last} = '9' THEN 1 ELSE 0 END AS line_total")
    columns = f"* REPLACE ({', '.join(changed)})" if changed else "*"
    rows = f"SELECT {columns} FROM {table_name(name)} WHERE {last}"
    return f"({rows} <> '3' UNION ALL {rows} = '7')"


def _all_keys(shown) -> str:
    rows = [
        f"SELECT 'unique' AS \"check\", '{r.table}.{r.column}' AS name, (SELECT count(*) FROM (SELECT k FROM"
        f" (SELECT {RAW_COLUMN.get(r.column, r.column) if r.layer == 'source' else r.column} AS k FROM {shown(r.table)}) WHERE k IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS failures"
        for r in select_rules("unique")
    ]
    keys = dict.fromkeys([(r.table, r.column, *r.args) for r in select_rules("relationships")] + [tuple(k) for k in ORPHAN_KEYS])
    for child, column, parent, key in keys:
        name = f"{child}.{column} -> {parent}.{key}"
        rows.append(
            f"SELECT 'orphan', '{name}', (SELECT count(*) FROM {shown(child)} c WHERE {column} IS NOT NULL"
            f" AND {column} NOT IN (SELECT {key} FROM {shown(parent)} WHERE {key} IS NOT NULL))"
        )
        rows.append(f"SELECT 'missing', '{name}', (SELECT count(*) FROM {shown(child)} c WHERE {column} IS NULL)")
    return " UNION ALL ".join(rows)


def _mismatches_damaged() -> str:
    pairs = " UNION ALL ".join(
        f"SELECT '{entity}' AS entity, CAST(a AS VARCHAR) AS raw_count, CAST(b AS VARCHAR) AS staging_count, NULL AS expected_count, NULL AS actual_count,"
        f" 'raw_staging_mismatch' AS failure_type FROM (SELECT (SELECT count(*) FROM {table_name(raw)}) AS a, (SELECT count(*) FROM {_damaged(staged)} x) AS b) WHERE a <> b"
        for entity, (raw, staged) in PROPAGATED.items()
    )
    return f"""{pairs} UNION ALL SELECT 'mart_daily_revenue_transaction_sum', NULL, NULL, CAST(a AS VARCHAR), CAST(b AS VARCHAR), 'mart_aggregation_mismatch'
FROM (SELECT (SELECT count(*) FROM {_damaged("stg_pos_transactions")} x) AS a, (SELECT CAST(sum(pos_transaction_count) AS BIGINT) FROM t_mart_daily_revenue) AS b) WHERE a <> b"""


def quality_sql() -> dict[str, str]:
    marts = [name for name, entry in MODELS.items() if entry.layer == "mart"]
    found = {key: _rules_sql(select_rules(*spec)) for key, spec in suite.RULE_SETS.items()}
    found["d08_severities"] = f"""
SELECT severity, count(*) AS checks, CAST(sum(failures) AS BIGINT) AS failures FROM ({_rules_sql(select_rules("unique", "staging"))}) GROUP BY ALL"""
    found["d09_orphans_all"] = _orphans()
    found["d09_orphans_failing"] = f"SELECT * FROM ({_orphans()}) WHERE orphan_count > 0"
    found["d10_revenue_consistency"] = f"""
SELECT check_name, {f8("expected")} AS expected, {f8("actual")} AS actual, {f8("abs(expected - actual)")} AS difference, CAST(NULL AS BIGINT) AS bad_count
FROM (
  SELECT 'raw_vs_staging_total_mismatch' AS check_name, (SELECT sum(total) FROM b_transactions) AS expected,
         (SELECT sum(total) FROM t_stg_pos_transactions) AS actual
  UNION ALL SELECT 'mart_vs_staging_revenue_mismatch', (SELECT sum(total) FROM t_stg_pos_transactions), (SELECT sum(pos_revenue) FROM t_mart_daily_revenue))
WHERE abs(expected - actual) > 1
UNION ALL
SELECT 'total_formula_mismatch', NULL, NULL, NULL, count(*) FROM b_transactions
WHERE abs(total - (subtotal + tax - coupon_savings - deal_savings)) > 0.01 HAVING count(*) > 0
UNION ALL
SELECT 'line_total_formula_mismatch', NULL, NULL, NULL, count(*) FROM b_items
WHERE abs(line_total - (unit_price - discount) * quantity) > 0.01 HAVING count(*) > 0"""
    found["d09_all_keys"] = _all_keys(table_name)
    found["d09_all_keys_damaged"] = _all_keys(_damaged)
    missing = _all_keys(_damaged)
    found["d09_orphans_failing_damaged"] = f"""
SELECT name AS fk_name, CAST(sum(failures) AS BIGINT) AS orphan_count FROM ({missing})
WHERE "check" <> 'unique' AND name IN ({', '.join(f"'{c}.{k} -> {p}.{pk}'" for c, k, p, pk in ORPHAN_KEYS)}) GROUP BY 1 HAVING sum(failures) > 0"""
    found["d11_count_mismatches_damaged"] = _mismatches_damaged()
    lines, receipts = _damaged("stg_pos_transaction_items"), _damaged("stg_pos_transactions")
    found["d12_line_total_balance_damaged"] = f"""
SELECT item_id, transaction_id, product_id, {dbl("unit_price", "discount", "quantity", "line_total")}, {f8("(unit_price - discount) * quantity")} AS expected_line_total
FROM {lines} x WHERE abs(line_total - (unit_price - discount) * quantity) > 0.01"""
    found["d10_revenue_consistency_damaged"] = f"""
SELECT check_name, {f8("expected")} AS expected, {f8("actual")} AS actual, {f8("abs(expected - actual)")} AS difference, CAST(NULL AS BIGINT) AS bad_count
FROM (
  SELECT 'raw_vs_staging_total_mismatch' AS check_name, (SELECT sum(total) FROM b_transactions) AS expected, (SELECT sum(CAST(total AS DECIMAL(18,4))) FROM {receipts} x) AS actual
  UNION ALL SELECT 'mart_vs_staging_revenue_mismatch', (SELECT sum(CAST(total AS DECIMAL(18,4))) FROM {receipts} x), (SELECT sum(CAST(pos_revenue AS DECIMAL(18,4))) FROM t_mart_daily_revenue))
WHERE abs(expected - actual) > 1
UNION ALL
SELECT 'total_formula_mismatch', NULL, NULL, NULL, count(*) FROM {receipts} x
WHERE abs(total - (subtotal + tax - coalesce(coupon_savings, 0) - coalesce(deal_savings, 0))) > 0.01 HAVING count(*) > 0
UNION ALL
SELECT 'line_total_formula_mismatch', NULL, NULL, NULL, count(*) FROM {lines} x
WHERE abs(line_total - (unit_price - coalesce(discount, 0)) * quantity) > 0.01 HAVING count(*) > 0"""
    found["d11_count_mismatches"] = """
SELECT 'mart_daily_revenue_transaction_sum' AS entity, CAST(NULL AS VARCHAR) AS raw_count, CAST(NULL AS VARCHAR) AS staging_count,
       CAST(a AS VARCHAR) AS expected_count, CAST(b AS VARCHAR) AS actual_count, 'mart_aggregation_mismatch' AS failure_type
FROM (SELECT (SELECT count(*) FROM b_transactions) AS a, (SELECT CAST(sum(pos_transaction_count) AS BIGINT) FROM t_mart_daily_revenue) AS b) WHERE a <> b"""
    found["d12_line_total_balance"] = f"""
SELECT item_id, transaction_id, product_id, {dbl("unit_price", "discount", "quantity", "line_total")}, {f8("(unit_price - discount) * quantity")} AS expected_line_total
FROM b_items WHERE abs(line_total - (unit_price - discount) * quantity) > 0.01"""
    found["d13_transaction_total_balance"] = f"""
SELECT transaction_id, {dbl("subtotal", "tax", "coupon_savings", "deal_savings", "total")}, {f8("subtotal + tax - coupon_savings - deal_savings")} AS expected_total
FROM b_transactions WHERE abs(total - (subtotal + tax - coupon_savings - deal_savings)) > 0.01"""
    found["d14_loyalty_balance"] = """
SELECT pt_id, member_id, transaction_dt, points_earned, points_redeemed, points_balance_after, prev_balance,
       prev_balance + points_earned - points_redeemed AS expected_balance
FROM (SELECT p.*, transaction_dt, lag(points_balance_after) OVER (PARTITION BY p.member_id ORDER BY transaction_dt, points_balance_after) AS prev_balance
      FROM b_points p JOIN b_transactions t USING (transaction_id))
WHERE points_balance_after <> prev_balance + points_earned - points_redeemed"""
    found["d15_negative_stock"] = """
SELECT stock_id, product_id, location_id, quantity_on_hand, quantity_reserved, quantity_available FROM b_stock
WHERE least(quantity_on_hand, quantity_available) < 0"""
    found["d16_unpaired_clock_events"] = """
SELECT employee_id, event_date, CAST(sum(ins) AS BIGINT) AS clock_ins, CAST(sum(outs) AS BIGINT) AS clock_outs, CAST(sum(starts) AS BIGINT) AS break_starts, CAST(sum(ends) AS BIGINT) AS break_ends
FROM t_clock_days WHERE event_date < DATE '2001-07-31' GROUP BY 1, 2 HAVING sum(ins) <> sum(outs) OR sum(starts) <> sum(ends)"""
    for key, table, column in (("d17_coupon_dates", "b_coupons", "coupon_id"), ("d17_deal_dates", "b_deals", "deal_id")):
        found[key] = f"""
SELECT item_id, transaction_id, i.promotion_id, CAST(transaction_dt AS DATE) AS used_on, valid_from, valid_until
FROM (SELECT *, CAST(NULL AS VARCHAR) AS promotion_id FROM b_items) i JOIN {table} ON {column} = promotion_id
WHERE CAST(transaction_dt AS DATE) NOT BETWEEN valid_from AND valid_until"""
    found["d18_raw_table_counts"] = _counts(list(RAW_TABLES))
    found["d18_mart_table_counts"] = _counts(marts)
    found["d18_empty_tables"] = f"SELECT table_name FROM ({_counts(list(RAW_TABLES))}) WHERE row_count = 0"
    found["d19_negative_values"] = """
SELECT 'raw_pos.transactions_total' AS check_name, count(*) FILTER (total < 0) AS bad_count FROM b_transactions
UNION ALL SELECT 'raw_pos.transaction_items_line_total', count(*) FILTER (line_total < 0) FROM b_items
UNION ALL SELECT 'raw_inv.stock_levels_qty', count(*) FILTER (quantity_on_hand < 0) FROM b_stock
UNION ALL SELECT 'mart.mart_inventory_summary_qty', count(*) FILTER (quantity_on_hand < 0) FROM t_mart_inventory_summary"""
    found["d20_revenue_by_layer"] = " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, {f8(exact_sum(column))} AS total_revenue FROM {table}"
        for layer, table, column in (
            ("raw_pos.transactions", "b_transactions", "total"),
            ("staging.stg_pos_transactions", "t_stg_pos_transactions", "total"),
            ("mart.mart_daily_revenue(pos_revenue)", "t_mart_daily_revenue", "pos_revenue"),
            ("mart.mart_daily_revenue(total_revenue)", "t_mart_daily_revenue", "total_revenue"),
        )
    )
    found["d18_table_columns"] = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, column_name, values FROM (UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\\1' FROM {table_name(name)})"
        ' ON COLUMNS(*) INTO NAME column_name VALUE "values")'
        for name in MODELS
    )
    found["d18_layout_by_month"] = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(date_trunc('month', {moment}) AS DATE) AS month, count(*) AS row_count FROM {table_name(name)} GROUP BY ALL"
        for name, moment in LAID_OUT.items()
    )
    found["d20_count_propagation"] = " UNION ALL ".join(
        [
            f"SELECT '{entity}' AS entity, (SELECT count(*) FROM {table_name(raw)}) AS expected_count,"
            f" (SELECT count(*) FROM {table_name(staged)}) AS actual_count, 'raw_staging_mismatch' AS failure_type"
            for entity, (raw, staged) in PROPAGATED.items()
        ]
        + [
            "SELECT 'mart_daily_revenue_transaction_sum', (SELECT count(*) FROM b_transactions),"
            " (SELECT CAST(sum(pos_transaction_count) AS BIGINT) FROM t_mart_daily_revenue), 'mart_aggregation_mismatch'"
        ]
    )
    return found


# ---- loads and exports



#: The damaged product lines: what is wrong with each, by the number of its part.
_LINES = f"""(
  SELECT p_partkey AS n, p_name || ' #' || p_partkey AS name, CAST({money("p_retailprice")} AS VARCHAR) AS price,
         CASE WHEN p_partkey % 11 = 0 THEN 'not JSON' WHEN p_partkey % 19 = 0 THEN 'not an object' WHEN p_partkey % 13 = 0 THEN 'no key' END AS problem
  FROM part)"""


def ingest_sql(mart_daily_revenue: str) -> dict[str, str]:
    scan = " UNION ALL ".join(
        f"SELECT '{t.name}' AS table_name, '{'incremental' if t.incremental else 'full'}' AS strategy, count(*) AS row_count,"
        f" {f'max({t.watermark})' if t.watermark else 'CAST(NULL AS TIMESTAMP)'} AS newest FROM {RAW_AS[t.name]}"
        for t in RAW_TABLES.values()
    )
    exported = [CHARTS[number] for number in HEADLINES.values()]
    return {
        "i01_source_scan": scan,
        "i02_full_refresh": f"""
SELECT 'P' || p_partkey AS product_id, p_name || ' #' || p_partkey AS name, CAST({money("p_retailprice")} AS VARCHAR) AS current_price,
       TIMESTAMP '2002-01-01 00:00:00' AS extracted_at FROM part""",
        "i03_incremental_window": """
SELECT transaction_id, transaction_dt FROM b_transactions
WHERE transaction_dt BETWEEN (SELECT max(transaction_dt) FROM b_transactions WHERE transaction_dt < TIMESTAMP '2001-01-01') AND TIMESTAMP '2002-01-01'""",
        "i03_backfill_window": """
SELECT transaction_id, transaction_dt FROM b_transactions WHERE transaction_dt BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1996-03-31'""",
        "i04_upsert": f"""
SELECT transaction_id, CASE WHEN late THEN 'corrected' ELSE payment_method END AS payment_method, {f8("total")} AS total,
       CASE WHEN late THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '2001-01-01' END AS extracted_at
FROM (SELECT *, transaction_dt >= TIMESTAMP '2001-01-01' AS late FROM b_transactions)""",
        "i04_keyed_merge": f"""
SELECT transaction_id, CASE WHEN late THEN 'corrected' ELSE payment_method END AS payment_method, {f8("total")} AS total,
       CASE WHEN late THEN TIMESTAMP '2002-01-01' ELSE TIMESTAMP '2001-01-01' END AS extracted_at
FROM (SELECT *, transaction_dt >= TIMESTAMP '2001-01-01' AS late FROM b_transactions)""",
        "i08_reloaded_month": """
SELECT transaction_id, CASE WHEN month = DATE '1997-05-01' THEN 'corrected' ELSE payment_method END AS payment_method, month
FROM (SELECT *, CAST(date_trunc('month', transaction_dt) AS DATE) AS month FROM b_transactions)""",
        "i05_text_form": """
SELECT item_id, '{"product_id":"' || product_id || '","category":"' || category || '"}' AS product, '["' || location_id || '"]' AS places FROM b_items""",
        "i06_schema_drift": """
SELECT member_id, first_name, last_name, email, CAST(signup_date AS VARCHAR) AS signup_date, CAST(points_balance AS VARCHAR) AS points_balance,
       CAST(NULL AS VARCHAR) AS tier FROM b_members""",
        "i07_event_stream": """
SELECT 'T' || event_id AS event_id, 'E' || user_id AS employee_id,
       CASE event_type WHEN 'click' THEN 'clock_in' WHEN 'purchase' THEN 'clock_out' WHEN 'view' THEN 'break_start' WHEN 'error' THEN 'clock_out' ELSE 'break_end' END AS event_type,
       ts AS event_dt, props AS notes
FROM events WHERE event_type IN ('click', 'purchase', 'view', 'signup', 'error')""",
        "i08_materialised_mart": mart_daily_revenue,
        "i09_csv_export": " UNION ALL ".join(
            f"SELECT '{i:03d}_{c.title.replace(': ', '_').replace(' ', '_').lower()}.csv' AS file, count(*) AS row_count FROM t_{c.mart}"
            for i, c in enumerate(exported, start=1)
        ),
        "i10_delivery_check": " UNION ALL ".join(
            f"SELECT '{i:03d}_{c.title.replace(': ', '_').replace(' ', '_').lower()}.csv' AS file, count(*) AS mart_rows, count(*) AS file_rows,"
            f" count(*) AS manifest_rows, true AS complete FROM t_{c.mart}"
            for i, c in enumerate(exported, start=1)
        ),
        "i01_landing_scan": f"""
SELECT 'P' || p_partkey AS product_id, p_name || ' #' || p_partkey AS name, CAST({money("p_retailprice")} AS VARCHAR) AS current_price,
       CAST(p_partkey % 13 <> 0 AS VARCHAR) AS is_active FROM part""",
        "i04_repeated_loads": f"""
SELECT transaction_id, CASE WHEN transaction_dt >= TIMESTAMP '2001-01-01' THEN 'corrected' ELSE payment_method END AS payment_method, {f8("total")} AS total
FROM b_transactions""",
        "i01_quarantined_lines": f"""
SELECT problem, CASE WHEN problem IS NULL THEN 'P' || n END AS product_id, name, CASE WHEN problem IS NULL THEN price END AS current_price
FROM {_LINES}""",
        "i06_drift_report": f"""
SELECT * FROM (
  SELECT field, CASE status WHEN 'known' THEN 'STRING' WHEN 'new' THEN 'OBJECT<row: BIGINT>' END AS type, rows, status FROM (
    SELECT unnest(['product_id', 'name', 'current_price']) AS field, count(*) AS rows, 'known' AS status FROM {_LINES} WHERE problem IS NULL
    UNION ALL SELECT 'shelf', count(*), 'new' FROM {_LINES} WHERE problem IS NULL AND n % 17 = 0
    UNION ALL SELECT unnest([{", ".join(f"'{c}'" for c in RAW_TABLES["raw_pos.products"].columns if c not in ("product_id", "name", "current_price"))}]), 0, 'missing'))""",
        "i06_unregistered_fields": f"""
SELECT 'P' || n AS product_id, n AS shelf_row FROM {_LINES} WHERE problem IS NULL AND n % 17 = 0""",
        "i06_create_or_recreate": """
SELECT action, department_id, name FROM (SELECT department_id, department_name AS name FROM b_departments), (VALUES ('create'), ('recreate'), ('keep')) v(action)""",
        "i07_first_rows": f"""
SELECT transaction_id, member_id, {f8("total")} AS total FROM b_transactions""",
        "i07_late_stream": f"""
SELECT transaction_id, member_id, {f8("total")} AS total FROM b_transactions""",
        "i11_row_freshness": "SELECT *, CASE WHEN age_hours IS NULL OR age_hours > 48 THEN 'error' WHEN age_hours > 24 THEN 'warn' ELSE 'pass' END AS status FROM ("
        + " UNION ALL ".join(
            f"SELECT '{t.schema_name}' AS source, '{t.table_name}' AS \"table\", newest AS max_loaded_at,"
            f" CAST(epoch_us(TIMESTAMP '2001-08-03 09:00:00') - epoch_us(newest) AS DOUBLE) / 3.6e9 AS age_hours"
            f" FROM (SELECT CAST(max({t.watermark}) AS TIMESTAMP) AS newest FROM {RAW_AS[t.name]})"
            for t in RAW_TABLES.values() if t.watermark
        )
        + ")",
        "i11_source_freshness": " UNION ALL ".join(
            f"SELECT '{t.schema_name}' AS source, '{t.table_name}' AS \"table\", {STAMP} AS max_loaded_at, CAST(36 AS DOUBLE) AS age_hours,"
            f" 'warn' AS status FROM {RAW_AS[t.name]} HAVING count(*) > 0"
            for t in RAW_TABLES.values()
        ),
    }


SPINE_SQL = """
SELECT CAST(d AS DATE) AS date_day
FROM (SELECT unnest(generate_series(min(transaction_date), max(transaction_date) + INTERVAL 24 MONTH, INTERVAL 1 DAY)) AS d FROM b_transactions)
"""
