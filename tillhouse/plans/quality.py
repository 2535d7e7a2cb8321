"""Data-quality checks over raw, staging and mart tables; every result row counts failures.

Checks that look at single rows of a table share one scan of it. Key checks aggregate the key
first, so a key with very many rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.ranking import previous_by_piece
from tillhouse.plans.day_tables import LAYOUT, on_range
from tillhouse.sources.raw_tables import EXTRACTED_AT, RAW_TABLES, RawTable

WARN, ERROR = "warn", "error"

# Fixed values, one table per line. `between` without an upper bound is open, `fk` is column=table.column.
_MODEL_RULES = """
stg_locations | rows 1 20 | unique location_id | not_null location_id location_name location_type | in location_type: store warehouse
stg_employees | rows 10 500 | unique employee_id | not_null employee_id location_id | in department: bakery deli management meat produce store transport warehouse | in status: active terminated | fk location_id=stg_locations.location_id
stg_hr_schedules | unique schedule_id | not_null schedule_id employee_id location_id scheduled_date | in status: called_out completed no_show scheduled | pair shift_end > shift_start | fk employee_id=stg_employees.employee_id location_id=stg_locations.location_id
stg_pos_departments | unique department_id | not_null department_id department_name
stg_pos_products | rows 100 5000 | unique product_id sku | not_null product_id sku department_id unit_price unit_cost | fk department_id=stg_pos_departments.department_id
stg_pos_transactions | rows 50000 10000000 | unique transaction_id | not_null transaction_id transaction_dt location_id employee_id total | in payment_method: cash credit debit ebt loyalty_points mobile_pay | in scenario_tag: normal rush_hour memorial_day_weekend memorial_day_weekend+rush_hour independence_day independence_day+rush_hour | pair total >= subtotal | fk location_id=stg_locations.location_id employee_id=stg_employees.employee_id
stg_pos_transaction_items | rows 500000 50000000 | unique item_id | not_null item_id transaction_id product_id quantity unit_price line_total | fk transaction_id=stg_pos_transactions.transaction_id product_id=stg_pos_products.product_id
stg_pos_loyalty_members | unique member_id email | not_null member_id email
stg_pos_loyalty_point_transactions | unique pt_id | not_null pt_id member_id transaction_id | fk member_id=stg_pos_loyalty_members.member_id transaction_id=stg_pos_transactions.transaction_id
stg_pos_price_history | unique price_history_id | not_null price_history_id product_id
stg_pos_coupons | unique coupon_id | not_null coupon_id valid_from valid_until
stg_pos_combo_deals | unique deal_id | not_null deal_id valid_from valid_until
stg_timeclock_events | unique event_id | not_null event_id employee_id location_id event_type event_dt | in event_type: clock_in clock_out break_start break_end | fk employee_id=stg_employees.employee_id location_id=stg_locations.location_id
stg_ordering_store_orders | unique order_id | not_null order_id store_location_id warehouse_location_id order_dt status | fk store_location_id=stg_locations.location_id warehouse_location_id=stg_locations.location_id
stg_ordering_store_order_items | unique item_id | not_null item_id order_id product_id quantity_requested | fk order_id=stg_ordering_store_orders.order_id product_id=stg_pos_products.product_id
stg_fulfillment_orders | unique fulfillment_id | not_null fulfillment_id store_order_id warehouse_location_id | pair completed_at >= started_at | fk store_order_id=stg_ordering_store_orders.order_id warehouse_location_id=stg_locations.location_id
stg_fulfillment_items | unique item_id | not_null item_id fulfillment_id product_id | in pick_status: picked short | fk fulfillment_id=stg_fulfillment_orders.fulfillment_id product_id=stg_pos_products.product_id
stg_transport_trucks | rows 1 50 | unique truck_id license_plate | not_null truck_id license_plate
stg_transport_loads | unique load_id | not_null load_id truck_id driver_id warehouse_location_id destination_location_id | fk truck_id=stg_transport_trucks.truck_id driver_id=stg_employees.employee_id warehouse_location_id=stg_locations.location_id destination_location_id=stg_locations.location_id
stg_transport_load_items | unique item_id | not_null item_id load_id fulfillment_id store_order_id | fk load_id=stg_transport_loads.load_id fulfillment_id=stg_fulfillment_orders.fulfillment_id store_order_id=stg_ordering_store_orders.order_id
stg_inv_products | unique inv_product_id | not_null inv_product_id product_id | fk product_id=stg_pos_products.product_id
stg_inv_stock_levels | unique stock_id | not_null stock_id product_id location_id | fk product_id=stg_pos_products.product_id location_id=stg_locations.location_id
stg_inv_receipts | unique receipt_id | not_null receipt_id location_id | fk location_id=stg_locations.location_id
stg_inv_receipt_items | unique receipt_item_id | not_null receipt_item_id receipt_id product_id | fk receipt_id=stg_inv_receipts.receipt_id product_id=stg_pos_products.product_id
stg_inv_shrinkage_events | unique event_id | not_null event_id product_id location_id | in shrinkage_type: damaged expired spoilage theft | fk product_id=stg_pos_products.product_id location_id=stg_locations.location_id
stg_pricing_weekly_ads | unique ad_id | not_null ad_id start_date end_date
stg_pricing_ad_items | unique ad_item_id | not_null ad_item_id ad_id product_id promoted_price | fk ad_id=stg_pricing_weekly_ads.ad_id product_id=stg_pos_products.product_id
mart_daily_revenue | rows 7 730 | not_null transaction_date location_id pos_transaction_count pos_revenue total_revenue | between total_revenue 0
mart_department_performance | rows 10 10000 | not_null transaction_date location_id department_id gross_revenue net_revenue transaction_count units_sold
mart_department_labor | not_null report_date location_id department total_shifts scheduled_hours | between scheduled_hours 0 | between hours_utilization_pct 0 300
mart_department_shrinkage | not_null report_date location_id department_id total_value_lost
mart_employee_cost | not_null scheduled_date employee_id location_id scheduled_hours scheduled_labor_cost
mart_employee_productivity | not_null sale_date employee_id location_id transaction_count total_revenue_processed
mart_inventory_summary | rows 100 10000 | unique stock_id | not_null stock_id product_id location_id quantity_on_hand quantity_available | between quantity_on_hand 0
mart_labor_efficiency | not_null scheduled_date location_id department shifts_scheduled
mart_location_performance | unique location_id | not_null location_id total_pos_transactions total_revenue days_with_sales
mart_loyalty_cohort | rows 1 100000 | unique member_id | not_null member_id loyalty_tier points_balance
mart_product_performance | rows 100 500000 | not_null transaction_date location_id product_id units_sold gross_revenue net_revenue | between gross_revenue 0 | between units_sold 0
int_pos_sales_enriched | rows 1000 5000000 | unique item_id | not_null item_id transaction_id transaction_date location_id product_id line_total
mart_category_sales_performance | rows 100 100000 | not_null transaction_date location_id category category_revenue category_units
mart_product_price_elasticity | rows 50 100000 | not_null product_id sale_month units_sold
mart_promotion_redemption | rows 1 1000 | not_null promotion_id promotion_type | in promotion_type: coupon combo_deal
mart_promotion_effectiveness | rows 1 200000 | not_null ad_week_start product_id is_ad_item total_units_sold total_revenue
mart_shrink_analysis | rows 1 200000 | not_null event_date location_id product_id shrinkage_type total_value_lost | in shrinkage_type: damaged expired spoilage theft
int_inventory_daily_snapshot | rows 100 1000000 | not_null product_id location_id snapshot_date quantity_on_hand
int_shrinkage_attributed | rows 1 300000 | unique event_id | not_null event_id product_id location_id event_date shrinkage_type
mart_inventory_valuation | rows 1 10000 | not_null location_id department_id value_on_hand_cost | between value_on_hand_cost 0
mart_shrinkage_analysis | rows 1 300000 | not_null event_date location_id department_id category shrinkage_type total_value_lost | in shrinkage_type: damaged expired spoilage theft
mart_inventory_turnover | rows 100 10000 | not_null product_id location_id location_name quantity_on_hand quantity_available units_sold_30d stock_aging_category | in stock_aging_category: OUT_OF_STOCK DEAD_STOCK OVERSTOCKED REORDER_NEEDED NO_RECEIPT_HISTORY HEALTHY
mart_supply_chain_summary | rows 10 10000 | unique order_id | not_null order_id order_date store_location_id order_status
mart_hourly_sales_pattern | rows 24 10000 | not_null hour_of_day day_of_week day_name location_id transaction_count total_revenue revenue_rank
mart_delivery_performance | rows 1 52 | not_null report_week_start warehouse_location_id total_orders fulfilled_count delivered_count
mart_store_weekly_summary | rows 1 500 | not_null week_start location_id location_name transaction_count total_revenue below_reorder_count out_of_stock_count
mart_transport_load_summary | unique load_id | not_null load_id truck_id driver warehouse_name store_name load_date status | in status: scheduled in_transit delivered cancelled
mart_fleet_utilization | rows 1 50 | unique truck_id license_plate | not_null truck_id license_plate total_loads utilization_status | in utilization_status: ACTIVE IDLE INACTIVE
mart_transport_daily_metrics | not_null load_date warehouse_location_id total_loads completed_loads
mart_attendance_summary | rows 1 100000 | not_null employee_id event_date location_id
mart_daily_attendance_stats | rows 1 10000 | not_null event_date location_id employees_present total_net_hours
mart_employee_hours_vs_schedule | not_null report_date employee_id full_name attendance_status | in attendance_status: ATTENDED SHORT PARTIAL NO_SHOW UNSCHEDULED UNKNOWN
mart_fulfillment_operations | unique fulfillment_id | not_null fulfillment_id store_order_id warehouse_location_id fulfillment_status total_qty_requested total_qty_picked
mart_fulfillment_pick_accuracy | rows 1 10000 | unique fulfillment_id | not_null fulfillment_id total_line_items total_qty_requested total_qty_picked
mart_daily_fulfillment_summary | rows 1 10000 | not_null report_date warehouse_location_id total_orders total_items_picked
mart_order_fulfillment_funnel | unique order_id | not_null order_id order_date store_location_id order_status pipeline_stage
int_hr_labor_enriched | rows 1 100000 | not_null employee_id scheduled_date location_id
mart_labor_cost_by_department | rows 1 10000 | not_null report_date location_id department actual_cost
mart_attendance_compliance | rows 1 10000 | not_null report_date location_id department scheduled_shifts | between no_show_rate_pct 0 100 | between late_arrival_rate_pct 0 100
int_fulfillment_enriched | rows 1 10000 | not_null order_id order_date store_location_id warehouse_location_id
mart_supply_chain_kpis | rows 1 10000 | not_null report_date warehouse_location_id store_location_id
mart_order_cycle_time | rows 1 100000 | not_null order_id order_date store_location_id
"""

# The source tables.
_SOURCE_RULES = """
raw_hr.locations | unique location_id | not_null location_id location_type is_active
raw_hr.employees | unique employee_id | not_null employee_id location_id
raw_hr.schedules | unique schedule_id | not_null schedule_id employee_id scheduled_date
raw_pos.departments | unique department_id | not_null department_id
raw_pos.products | unique product_id | not_null product_id
raw_pos.price_history | unique price_history_id | not_null price_history_id
raw_pos.coupons | unique coupon_id | not_null coupon_id
raw_pos.combo_deals | unique deal_id | not_null deal_id
raw_pos.loyalty_members | unique member_id | not_null member_id
raw_pos.loyalty_point_transactions | unique pt_id | not_null pt_id member_id transaction_id
raw_pos.transactions | unique transaction_id | not_null transaction_id transaction_dt
raw_pos.transaction_items | unique item_id | not_null item_id transaction_id
raw_timeclock.events | unique event_id | not_null event_id employee_id
raw_ordering.store_orders | unique order_id | not_null order_id store_location_id
raw_ordering.store_order_items | unique item_id | not_null item_id order_id
raw_fulfillment.orders | unique fulfillment_id | not_null fulfillment_id store_order_id
raw_fulfillment.items | unique item_id | not_null item_id fulfillment_id
raw_transport.trucks | unique truck_id | not_null truck_id
raw_transport.loads | unique load_id | not_null load_id truck_id
raw_transport.load_items | unique item_id | not_null item_id load_id
raw_inv.products | unique inv_product_id | not_null inv_product_id product_id
raw_inv.stock_levels | unique stock_id | not_null stock_id product_id location_id
raw_inv.receipts | unique receipt_id | not_null receipt_id location_id
raw_inv.receipt_items | unique receipt_item_id | not_null receipt_item_id receipt_id
raw_inv.shrinkage_events | unique shrinkage_id | not_null shrinkage_id product_id location_id
raw_pricing.weekly_ads | unique ad_id | not_null ad_id start_date end_date
raw_pricing.ad_items | unique ad_item_id | not_null ad_item_id ad_id product_id
"""

# The foreign keys of the orphan report, child.column -> parent.column.
_ORPHAN_KEYS = """
stg_employees.location_id -> stg_locations.location_id
stg_hr_schedules.employee_id -> stg_employees.employee_id
stg_hr_schedules.location_id -> stg_locations.location_id
stg_pos_products.department_id -> stg_pos_departments.department_id
stg_pos_transactions.location_id -> stg_locations.location_id
stg_pos_transactions.employee_id -> stg_employees.employee_id
stg_pos_transaction_items.transaction_id -> stg_pos_transactions.transaction_id
stg_pos_transaction_items.product_id -> stg_pos_products.product_id
stg_pos_loyalty_point_transactions.member_id -> stg_pos_loyalty_members.member_id
stg_pos_loyalty_point_transactions.transaction_id -> stg_pos_transactions.transaction_id
stg_timeclock_events.employee_id -> stg_employees.employee_id
stg_timeclock_events.location_id -> stg_locations.location_id
stg_ordering_store_orders.store_location_id -> stg_locations.location_id
stg_ordering_store_order_items.order_id -> stg_ordering_store_orders.order_id
stg_ordering_store_order_items.product_id -> stg_pos_products.product_id
stg_fulfillment_orders.store_order_id -> stg_ordering_store_orders.order_id
stg_inv_stock_levels.product_id -> stg_pos_products.product_id
stg_inv_stock_levels.location_id -> stg_locations.location_id
stg_inv_receipts.location_id -> stg_locations.location_id
stg_pricing_ad_items.ad_id -> stg_pricing_weekly_ads.ad_id
"""

# Entity -> raw and staging table whose row counts must agree.
PROPAGATED = {
    "locations": ("raw_hr.locations", "stg_locations"),
    "employees": ("raw_hr.employees", "stg_employees"),
    "departments": ("raw_pos.departments", "stg_pos_departments"),
    "products": ("raw_pos.products", "stg_pos_products"),
    "transactions": ("raw_pos.transactions", "stg_pos_transactions"),
    "transaction_items": ("raw_pos.transaction_items", "stg_pos_transaction_items"),
    "timeclock_events": ("raw_timeclock.events", "stg_timeclock_events"),
    "store_orders": ("raw_ordering.store_orders", "stg_ordering_store_orders"),
    "store_order_items": ("raw_ordering.store_order_items", "stg_ordering_store_order_items"),
    "fulfillment_orders": ("raw_fulfillment.orders", "stg_fulfillment_orders"),
    "inv_stock_levels": ("raw_inv.stock_levels", "stg_inv_stock_levels"),
    "pricing_weekly_ads": ("raw_pricing.weekly_ads", "stg_pricing_weekly_ads"),
}

Table = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Rule:
    table: str
    check: str  # unique, not_null, relationships, accepted_values, row_count, between, pair
    column: str
    args: tuple[str, ...] = ()
    severity: str = WARN

    @property
    def layer(self) -> str:
        if self.table.startswith("raw_"):
            return "source"
        return "staging" if self.table.startswith("stg_") else "mart"


def _rules(line: str) -> list[Rule]:
    table, *segments = (part.strip() for part in line.split("|"))
    found = []
    for segment in segments:
        kind, _, rest = segment.partition(" ")
        words = rest.split()
        if kind in ("unique", "not_null"):
            found += [Rule(table, kind, column) for column in words]
        elif kind == "fk":
            found += [Rule(table, "relationships", *_split_key(word)) for word in words]
        elif kind == "in":
            found.append(Rule(table, "accepted_values", words[0].rstrip(":"), tuple(words[1:])))
        elif kind == "rows":
            found.append(Rule(table, "row_count", "*", tuple(words)))
        else:
            found.append(Rule(table, kind, words[0], tuple(words[1:])))
    return found


def _split_key(word: str) -> tuple[str, tuple[str, str]]:
    column, _, parent = word.partition("=")
    table, _, key = parent.rpartition(".")
    return column, (table, key)


RULES: list[Rule] = [
    rule for text in (_SOURCE_RULES, _MODEL_RULES) for line in text.strip().splitlines() for rule in _rules(line)
]
ORPHAN_KEYS: list[tuple[str, str, str, str]] = [
    (*child.rsplit(".", 1), *parent.rsplit(".", 1))
    for child, parent in (line.split(" -> ") for line in _ORPHAN_KEYS.strip().splitlines())
]


# ---- declarative rules


def _row_failures(rule: Rule) -> Column:
    """Failures of a rule that one scan can count. Unknown values only fail not_null."""
    if rule.check == "row_count":
        low, high = map(int, rule.args)
        return F.when(F.count("*").between(low, high), 0).otherwise(1)
    value = F.col(rule.column)
    if rule.check == "not_null":
        return F.count_if(value.isNull())
    if rule.check == "accepted_values":
        return F.count_if(~value.isin(*rule.args))
    if rule.check == "between":
        bad = value < F.lit(int(rule.args[0]))
        if len(rule.args) > 1:
            bad = bad | (value > F.lit(int(rule.args[1])))
        return F.count_if(bad)
    if rule.check == "pair":
        operator, other = rule.args
        holds = value > F.col(other) if operator == ">" else value >= F.col(other)
        return F.count_if(~holds)
    raise ValueError(f"{rule.check} needs more than one scan")


def _line(rule: Rule, failures: Column) -> Column:
    column = f"{rule.column} {' '.join(rule.args)}" if rule.check == "pair" else rule.column
    return F.struct(
        F.lit(rule.check).alias("check"),
        F.lit(rule.table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(rule.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
    )


def scan_table(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    """All single-scan rules of one table in one aggregation."""
    counted = frame.agg(*[_row_failures(rule).alias(f"_{i}") for i, rule in enumerate(rules)])
    lines = F.array(*[_line(rule, F.col(f"_{i}")) for i, rule in enumerate(rules)])
    return counted.select(F.explode(lines).alias("line")).select("line.*")


def check_unique(frame: DataFrame, rule: Rule) -> DataFrame:
    """Counts the values that occur more than once."""
    repeated = frame.groupBy(F.col(rule.column).alias("_key")).agg(F.count("*").alias("_n"))
    failures = F.count_if((F.col("_n") > 1) & F.col("_key").isNotNull())
    return repeated.agg(failures.alias("_f")).select(_line(rule, F.col("_f")).alias("line")).select("line.*")


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str, count_null: bool = False) -> DataFrame:
    """One row with the number of child rows that have no parent; child keys are counted before the join."""
    keys = child.groupBy(F.col(column).alias("_child")).agg(F.count("*").alias("_n"))
    if not count_null:
        keys = keys.filter("_child IS NOT NULL")
    known = parent.select(F.col(key).alias("_parent"))
    missing = keys.join(known, F.col("_child") == F.col("_parent"), "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_count"))


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    key: str


#: How many foreign keys of one parent are counted beside its values at a time: as many counters, and one, per value.
COUNTED_AT_ONCE = 3


@dataclass(frozen=True)
class KeyFindings:
    """Of each unique column, how many of its values occur more than once; of each foreign key, how many child rows have
    a key that no parent has, and how many have none. All in one row of `found`, a map from the column whose values are
    checked, and which of its children are, to (repeated, orphans by child, missing by child)."""

    found: DataFrame
    domains: dict[tuple[str, str], list[ForeignKey]]

    def of_unique(self, table: str, column: str) -> Column:
        return F.coalesce(self._domain(table, column)["repeated"], F.lit(0))

    def of_key(self, key: ForeignKey, count_null: bool = False) -> Column:
        turn, place = divmod(self.domains[key.parent, key.key].index(key), COUNTED_AT_ONCE)
        domain = self._domain(key.parent, key.key, turn)
        orphans, missing = (F.coalesce(F.get(domain[side], F.lit(place)), F.lit(0)) for side in ("orphans", "missing"))
        return (orphans + missing if count_null else orphans).cast("bigint")

    def _domain(self, table: str, column: str, turn: int = 0) -> Column:
        return F.col("found")[f"{table}.{column} {turn}"]


def check_keys(table: Table, unique: Iterable[tuple[str, str]], keys: Iterable[ForeignKey]) -> KeyFindings:
    """All uniqueness and foreign-key checks from one scan per table and one shuffle.

    The values of a unique or parent column and of all columns that refer to it are one domain. Every table gives its key
    values once, each with its domain and its part in it (0: the column itself, then the children); values are counted
    by part, in the tasks first, so a key with very many rows costs no more than any other. A column that many refer to
    makes several domains, of a few children each, so that no value takes more than a few counters.
    """
    domains: dict[tuple[str, str], list[ForeignKey]] = {name: [] for name in unique}
    for key in keys:
        children = domains.setdefault((key.parent, key.key), [])
        if key not in children:
            children.append(key)
    counted_together = [
        (name, turn, children[start : start + COUNTED_AT_ONCE])
        for name, children in domains.items()
        for turn, start in enumerate(range(0, max(1, len(children)), COUNTED_AT_ONCE))
    ]
    values: dict[str, list[Column]] = {}
    for number, ((name, column), _, children) in enumerate(counted_together):
        for part, (source, value) in enumerate([(name, column), *[(c.child, c.column) for c in children]]):
            entry = F.struct(F.lit(number).alias("domain"), F.lit(part).alias("part"), F.col(value).cast("string").alias("value"))
            values.setdefault(source, []).append(entry)
    stacked = reduce(DataFrame.unionByName, [table(name).select(F.explode(F.array(*entries)).alias("k")).select("k.*") for name, entries in values.items()])
    parts = range(1 + max(len(children) for _, _, children in counted_together))
    counted = stacked.groupBy("domain", "value").agg(*[F.count_if(F.col("part") == i).alias(f"n{i}") for i in parts])
    known = F.col("value").isNotNull()
    alone = known & (F.col("n0") == 0)
    per_domain = counted.groupBy("domain").agg(
        F.count_if(known & (F.col("n0") > 1)).alias("repeated"),
        F.array(*[F.coalesce(F.sum(F.when(alone, F.col(f"n{i}"))), F.lit(0)) for i in parts[1:]]).alias("orphans"),
        F.array(*[F.coalesce(F.sum(F.when(~known, F.col(f"n{i}"))), F.lit(0)) for i in parts[1:]]).alias("missing"),
    )
    names = F.array(*[F.lit(f"{name}.{column} {turn}") for (name, column), turn, _ in counted_together])
    # One row per domain, so a map of as many entries.
    entry = F.struct(F.get(names, F.col("domain")).alias("name"), F.struct("repeated", "orphans", "missing").alias("of"))
    found = per_domain.agg(F.map_from_entries(F.collect_list(entry)).alias("found"))
    return KeyFindings(found, domains)


def run(table: Table, rules: Iterable[Rule]) -> DataFrame:
    """Rows of (check, table, column, severity, failures), one per rule."""
    rules = list(rules)
    scanned: dict[str, list[Rule]] = {}
    for rule in rules:
        if rule.check not in ("unique", "relationships"):
            scanned.setdefault(rule.table, []).append(rule)
    parts = [scan_table(table(name), group) for name, group in scanned.items()]
    unique = [r for r in rules if r.check == "unique"]
    keys = {r: ForeignKey(r.table, r.column, *r.args) for r in rules if r.check == "relationships"}
    if unique or keys:
        findings = check_keys(table, [(r.table, r.column) for r in unique], keys.values())
        lines = [_line(r, findings.of_unique(r.table, r.column)) for r in unique] + [_line(r, findings.of_key(k)) for r, k in keys.items()]
        parts.append(findings.found.select(F.explode(F.array(*lines)).alias("line")).select("line.*"))
    return reduce(DataFrame.unionByName, parts)


def select_rules(check: str, layer: str | None = None) -> list[Rule]:
    return [r for r in RULES if r.check == check and (layer is None or r.layer == layer)]


# ---- assertions across tables


def orphan_report(table: Table, failing_only: bool = True) -> DataFrame:
    """Orphans per foreign key; a missing child key is an orphan here."""
    keys = [ForeignKey(*key) for key in ORPHAN_KEYS]
    findings = check_keys(table, [], keys)
    lines = [
        F.struct(F.lit(f"{k.child}.{k.column} -> {k.parent}.{k.key}").alias("fk_name"), findings.of_key(k, count_null=True).alias("orphan_count"))
        for k in keys
    ]
    report = findings.found.select(F.explode(F.array(*lines)).alias("line")).select("line.*")
    return report.filter("orphan_count > 0") if failing_only else report


def key_report(table: Table) -> DataFrame:
    """Every unique column and foreign key of the warehouse at once, with what fails of each."""
    unique = [r for r in RULES if r.check == "unique"]
    keys = list(dict.fromkeys([ForeignKey(r.table, r.column, *r.args) for r in RULES if r.check == "relationships"] + [ForeignKey(*k) for k in ORPHAN_KEYS]))
    findings = check_keys(table, [(r.table, r.column) for r in unique], keys)

    def line(kind: str, name: str, failures: Column) -> Column:
        return F.struct(F.lit(kind).alias("check"), F.lit(name).alias("name"), failures.cast("bigint").alias("failures"))

    lines = [line("unique", f"{r.table}.{r.column}", findings.of_unique(r.table, r.column)) for r in unique]
    for k in keys:
        name = f"{k.child}.{k.column} -> {k.parent}.{k.key}"
        lines += [line("orphan", name, findings.of_key(k)), line("missing", name, findings.of_key(k, count_null=True) - findings.of_key(k))]
    return findings.found.select(F.explode(F.array(*lines)).alias("line")).select("line.*")


def revenue_by_layer(table: Table) -> DataFrame:
    def total(layer: str, name: str, column: str) -> DataFrame:
        amount = F.coalesce(F.sum(F.col(column).cast("decimal(28,4)")), F.lit(0)).cast("decimal(28,4)")
        return table(name).agg(amount.alias("total_revenue")).select(F.lit(layer).alias("layer"), "total_revenue")

    return reduce(
        DataFrame.unionByName,
        [
            total("raw_pos.transactions", "raw_pos.transactions", "total"),
            total("staging.stg_pos_transactions", "stg_pos_transactions", "total"),
            total("mart.mart_daily_revenue(pos_revenue)", "mart_daily_revenue", "pos_revenue"),
            total("mart.mart_daily_revenue(total_revenue)", "mart_daily_revenue", "total_revenue"),
        ],
    )


def revenue_consistency(table: Table) -> DataFrame:
    """Layers whose revenue differs by more than 1.00, and rows that break a total formula by more than 0.01."""
    layers = revenue_by_layer(table).agg(
        *[
            F.max(F.when(F.col("layer") == layer, F.col("total_revenue"))).alias(name)
            for name, layer in {
                "raw": "raw_pos.transactions",
                "staging": "staging.stg_pos_transactions",
                "mart": "mart.mart_daily_revenue(pos_revenue)",
            }.items()
        ]
    )

    def pair(name: str, expected: str, actual: str) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            F.col(expected).alias("expected"),
            F.col(actual).alias("actual"),
            F.abs(F.col(expected) - F.col(actual)).alias("difference"),
        )

    pairs = F.array(
        pair("raw_vs_staging_total_mismatch", "raw", "staging"),
        pair("mart_vs_staging_revenue_mismatch", "staging", "mart"),
    )
    differing = (
        layers.select(F.explode(pairs).alias("p")).select("p.*").filter("difference > 1.00")
        .withColumn("bad_count", F.lit(None).cast("bigint"))
    )
    zero = F.lit(0)
    formula = F.col("subtotal") + F.col("tax") - F.coalesce("coupon_savings", zero) - F.coalesce("deal_savings", zero)
    line = (F.col("unit_price") - F.coalesce("discount", zero)) * F.col("quantity")

    def broken(name: str, frame: DataFrame, stated: str, expected: Column) -> DataFrame:
        bad = frame.agg(F.count_if(F.abs(F.col(stated) - expected) > 0.01).alias("bad_count")).filter("bad_count > 0")
        return bad.withColumn("check_name", F.lit(name))

    return (
        differing.unionByName(
            broken("total_formula_mismatch", table("stg_pos_transactions"), "total", formula), allowMissingColumns=True
        )
        .unionByName(
            broken("line_total_formula_mismatch", table("stg_pos_transaction_items"), "line_total", line),
            allowMissingColumns=True,
        )
    )


def count_propagation(table: Table) -> DataFrame:
    """Row counts of every propagated entity, and receipts counted by the revenue mart."""

    def rows(name: str, alias: str) -> DataFrame:
        return table(name).agg(F.count("*").alias(alias))

    parts = []
    for entity, (raw, staged) in PROPAGATED.items():
        both = rows(raw, "expected_count").unionByName(rows(staged, "actual_count"), allowMissingColumns=True)
        parts.append(
            both.agg(F.max("expected_count").alias("expected_count"), F.max("actual_count").alias("actual_count"))
            .withColumn("entity", F.lit(entity))
            .withColumn("failure_type", F.lit("raw_staging_mismatch"))
        )
    receipts = table("mart_daily_revenue").agg(
        F.coalesce(F.sum("pos_transaction_count"), F.lit(0)).alias("actual_count")
    )
    both = rows("stg_pos_transactions", "expected_count").unionByName(receipts, allowMissingColumns=True)
    parts.append(
        both.agg(F.max("expected_count").alias("expected_count"), F.max("actual_count").alias("actual_count"))
        .withColumn("entity", F.lit("mart_daily_revenue_transaction_sum"))
        .withColumn("failure_type", F.lit("mart_aggregation_mismatch"))
    )
    counts = reduce(DataFrame.unionByName, parts)
    return counts.select("entity", "expected_count", "actual_count", "failure_type")


def count_mismatches(table: Table) -> DataFrame:
    """Failing rows of `count_propagation` in text form, raw and mart checks in their own columns."""
    raw = F.col("failure_type") == "raw_staging_mismatch"
    expected, actual = F.col("expected_count").cast("string"), F.col("actual_count").cast("string")
    return count_propagation(table).filter("expected_count <> actual_count").select(
        "entity",
        F.when(raw, expected).alias("raw_count"),
        F.when(raw, actual).alias("staging_count"),
        F.when(~raw, expected).alias("expected_count"),
        F.when(~raw, actual).alias("actual_count"),
        "failure_type",
    )


# ---- assertions on rows


def line_total_balance(items: DataFrame) -> DataFrame:
    expected = (F.col("unit_price") - F.col("discount")) * F.col("quantity")
    return items.filter(F.abs(F.col("line_total") - expected) > 0.01).select(
        "item_id",
        "transaction_id",
        "product_id",
        "unit_price",
        "discount",
        "quantity",
        "line_total",
        expected.cast("decimal(18,4)").alias("expected_line_total"),
    )


def transaction_total_balance(transactions: DataFrame) -> DataFrame:
    expected = F.col("subtotal") + F.col("tax") - F.col("coupon_savings") - F.col("deal_savings")
    return transactions.filter(F.abs(F.col("total") - expected) > 0.01).select(
        "transaction_id", "subtotal", "tax", "coupon_savings", "deal_savings", "total", expected.alias("expected_total")
    )


def loyalty_balance(points: DataFrame, transactions: DataFrame) -> DataFrame:
    """Point events whose balance does not follow from the member's previous one.

    A shared card may hold a large part of all events, so the previous event is found day by day.
    """
    receipts = transactions.select(F.col("transaction_id").alias("_txn"), "transaction_dt")
    dated = points.join(receipts, F.col("transaction_id") == F.col("_txn")).select(
        "pt_id", "member_id", "transaction_dt", "points_earned", "points_redeemed", "points_balance_after"
    )
    dated = dated.withColumn("_day", F.to_date("transaction_dt"))
    chained = previous_by_piece(
        dated, "member_id", "_day", ["transaction_dt", "points_balance_after", "pt_id"], "points_balance_after", "prev_balance"
    )
    expected = F.col("prev_balance") + F.col("points_earned") - F.col("points_redeemed")
    return (
        chained.select(
            "pt_id",
            "member_id",
            "transaction_dt",
            "points_earned",
            "points_redeemed",
            "points_balance_after",
            "prev_balance",
            expected.alias("expected_balance"),
        )
        .filter("points_balance_after <> expected_balance")
    )


def negative_stock(stock: DataFrame) -> DataFrame:
    return stock.filter("quantity_on_hand < 0 OR quantity_available < 0").select(
        "stock_id", "product_id", "location_id", "quantity_on_hand", "quantity_reserved", "quantity_available"
    )


def unpaired_clock_events(events: DataFrame, today: date) -> DataFrame:
    """Employee days before today with unequal starts and ends of work or breaks."""
    counts = {
        f"{kind}s": F.count_if(F.col("event_type") == kind)
        for kind in ("clock_in", "clock_out", "break_start", "break_end")
    }
    return (
        on_range(events, "event_date", before=today)
        .groupBy("employee_id", "event_date")
        .agg(*[value.alias(name) for name, value in counts.items()])
        .filter("clock_ins <> clock_outs OR break_starts <> break_ends")
    )


def promotion_dates(items: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """Lines that used a coupon or deal outside its validity; empty while the source has no such ids."""
    terms = catalogue.select(F.col(key).alias("_promo"), "valid_from", "valid_until")
    used = items.filter(F.col(key).isNotNull()).withColumn("used_on", F.to_date("transaction_dt"))
    return used.join(terms, F.col(key) == F.col("_promo")).filter(
        "used_on < valid_from OR used_on > valid_until"
    ).select("item_id", "transaction_id", F.col(key).alias("promotion_id"), "used_on", "valid_from", "valid_until")


# ---- catalogue


def table_counts(table: Table, names: Iterable[str]) -> DataFrame:
    parts = [
        table(name).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name in names
    ]
    return reduce(DataFrame.unionByName, parts)


def empty_tables(table: Table, names: Iterable[str]) -> DataFrame:
    return table_counts(table, names).filter("row_count = 0").select("table_name")


def table_columns(frame: DataFrame) -> Column:
    """Name, type and position of a table's columns, as one array; the layout's column is no part of it."""
    fields = [f for f in frame.schema if f.name not in LAYOUT.values()]
    return F.array(
        *[
            F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.lit(i).alias("ordinal_position"))
            for i, f in enumerate(fields, start=1)
        ]
    )


def catalogue(table: Table, names: Iterable[str]) -> DataFrame:
    """The columns of every table, with the number of values each has."""
    parts = []
    for name in names:
        frame = table(name)
        fields = [f.name for f in frame.schema if f.name not in LAYOUT.values()]
        filled = frame.agg(F.array(*[F.count(f"`{c}`") for c in fields]).alias("filled"))
        column = F.explode(F.arrays_zip(table_columns(frame).alias("column"), F.col("filled"))).alias("c")
        parts.append(filled.select(F.lit(name).alias("table_name"), column).select("table_name", "c.column.*", F.col("c.filled").alias("values")))
    return reduce(DataFrame.unionByName, parts)


def rows_by_month(table: Table, names: Iterable[str]) -> DataFrame:
    """Rows in each month of the tables laid out by month."""
    parts = [table(name).groupBy(F.col(LAYOUT["month"]).alias("month")).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "month", "row_count") for name in names]
    return reduce(DataFrame.unionByName, parts)


def negative_values(table: Table) -> DataFrame:
    # Reported name, table and column.
    checks = [
        ("raw_pos.transactions_total", "raw_pos.transactions", "total"),
        ("raw_pos.transaction_items_line_total", "raw_pos.transaction_items", "line_total"),
        ("raw_inv.stock_levels_qty", "raw_inv.stock_levels", "quantity_on_hand"),
        ("mart.mart_inventory_summary_qty", "mart_inventory_summary", "quantity_on_hand"),
    ]
    parts = []
    for label, name, column in checks:
        bad = F.count_if(F.col(column).cast("decimal(18,4)") < 0).alias("bad_count")
        parts.append(table(name).agg(bad).select(F.lit(label).alias("check_name"), "bad_count"))
    return reduce(DataFrame.unionByName, parts)


def freshness(raw: Table, now: datetime, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """Age of the newest extract of every source table."""
    return _ages(raw, {entry: EXTRACTED_AT for entry in RAW_TABLES.values()}, now, warn_hours, error_hours)


def row_freshness(raw: Table, now: datetime, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    """Age of the newest row, by its watermark, of every source table that has one. Tables without rows are in error."""
    return _ages(raw, {entry: entry.watermark for entry in RAW_TABLES.values() if entry.watermark}, now, warn_hours, error_hours)


def _ages(raw: Table, moments: dict[RawTable, str], now: datetime, warn_hours: int, error_hours: int) -> DataFrame:
    parts = [
        raw(entry.name)
        .agg(F.max(F.col(moment).cast("timestamp")).alias("max_loaded_at"))
        .select(F.lit(entry.schema_name).alias("source"), F.lit(entry.table_name).alias("table"), "max_loaded_at")
        for entry, moment in moments.items()
    ]
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros("max_loaded_at")) / F.lit(3.6e9)
    status = (
        F.when(F.col("max_loaded_at").isNull() | (F.col("age_hours") > error_hours), ERROR)
        .when(F.col("age_hours") > warn_hours, WARN)
        .otherwise("pass")
    )
    return reduce(DataFrame.unionByName, parts).withColumn("age_hours", age).withColumn("status", status)
