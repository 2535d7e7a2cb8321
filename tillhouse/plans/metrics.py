"""Metrics over the marts: simple, ratio, running to-date and offset, by dimension and time grain.

A metric is defined once and can be asked for with any dimension of its mart and at any calendar
grain. Results are named after the metric; the time column is `metric_time`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.functions import divide

TIME = "metric_time"

# Fixed values, one mart per line:
# mart | entity=column ... | time_column:grain ... (first is the default) | dimensions | aggregate measure[=column] ... ; ...
# `flags` sums one for every true row.
_MARTS = """
attendance_summary | attendance_summary=employee_id location=location_id | event_date:day |  | sum attendance_summary_total_clocked_hours=total_clocked_hours attendance_summary_total_break_hours=total_break_hours attendance_summary_net_hours_worked=net_hours_worked ; flags complete_pairs=has_complete_pair
daily_attendance_stats | daily_attendance_stats=location_id | event_date:day | location_name | sum employees_present daily_attendance_stats_total_clocked_hours=total_clocked_hours total_net_hours daily_attendance_stats_total_break_hours=total_break_hours
daily_fulfillment_summary | daily_fulfillment_summary=warehouse_location_id | report_date:day | warehouse_name | sum daily_fulfillment_summary_total_orders=total_orders completed_orders cancelled_orders total_items_picked fully_picked_lines shorted_lines daily_fulfillment_summary_total_qty_requested=total_qty_requested daily_fulfillment_summary_total_qty_picked=total_qty_picked ; average daily_fulfillment_summary_avg_hours_to_fulfill=avg_hours_to_fulfill
daily_revenue | daily_revenue=location_id | transaction_date:day | location_name city state location_type | sum pos_transaction_count pos_revenue daily_revenue_total_revenue=total_revenue loyalty_transactions coupon_savings_total deal_savings_total total_discount_savings
delivery_performance | delivery_performance=warehouse_location_id | report_week_start:week | warehouse_name | sum delivery_performance_total_orders=total_orders total_fulfillments delivery_performance_total_loads=total_loads fulfilled_count fulfilled_within_24h delivered_count ; average delivery_performance_avg_hours_to_fulfill=avg_hours_to_fulfill avg_hours_in_transit
department_labor | department_labor=location_id | report_date:day | department location_name city state | sum total_shifts completed_shifts no_show_shifts called_out_shifts department_labor_scheduled_hours=scheduled_hours actual_hours scheduled_cost actual_cost cost_variance
department_performance | department_performance=location_id dept=department_id | transaction_date:day | location_name department_name | sum department_performance_transaction_count=transaction_count department_performance_units_sold=units_sold department_performance_gross_revenue=gross_revenue department_performance_total_discounts=total_discounts department_performance_net_revenue=net_revenue
department_shrinkage | department_shrinkage=location_id dept=department_id | report_date:day | location_name department_name | sum department_shrinkage_net_revenue=net_revenue department_shrinkage_units_sold=units_sold department_shrinkage_shrink_event_count=shrink_event_count total_qty_lost department_shrinkage_total_value_lost=total_value_lost expired_value_lost spoilage_value_lost damaged_value_lost theft_value_lost
employee_cost | employee_cost=employee_id location=location_id | scheduled_date:day | full_name department job_title location_name | sum employee_cost_scheduled_hours=scheduled_hours scheduled_labor_cost actual_hours_worked actual_labor_cost employee_cost_shifts_scheduled=shifts_scheduled employee_cost_shifts_completed=shifts_completed employee_cost_shifts_no_show=shifts_no_show
employee_hours_vs_schedule | employee_hours_vs_schedule=employee_id location=location_id | report_date:day | full_name department job_title attendance_status | sum employee_hours_vs_schedule_scheduled_hours=scheduled_hours employee_hours_vs_schedule_net_hours_worked=net_hours_worked employee_hours_vs_schedule_estimated_labor_cost=estimated_labor_cost
employee_productivity | employee_productivity=employee_id location=location_id | sale_date:day | full_name department job_title location_name | sum employee_productivity_transaction_count=transaction_count total_revenue_processed employee_productivity_estimated_labor_cost=estimated_labor_cost
fleet_utilization | fleet_utilization=truck_id |  | license_plate utilization_status | 
fulfillment_operations | fulfillment_operations=fulfillment_id warehouse=warehouse_location_id | order_received_at:day | fulfillment_status warehouse_name picker_name | sum total_items fulfillment_operations_total_qty_requested=total_qty_requested fulfillment_operations_total_qty_picked=total_qty_picked shorted_items fully_picked_items ; average fulfillment_operations_hours_to_fulfill=hours_to_fulfill
fulfillment_pick_accuracy | fulfillment_pick_accuracy=fulfillment_id |  | picker_name fulfillment_status | 
hourly_sales_pattern | hourly_sales_pattern=location_id |  | hour_of_day day_of_week day_name location_name | 
inventory_summary | inventory_summary=stock_id location=location_id product=product_id | last_updated:day | product_name category sku location_name is_below_reorder | sum inventory_summary_quantity_on_hand=quantity_on_hand inventory_summary_quantity_available=quantity_available
inventory_turnover | inventory_turnover=location_id product=product_id | last_updated:day | product_name category location_name stock_aging_category | sum inventory_turnover_quantity_on_hand=quantity_on_hand inventory_turnover_quantity_available=quantity_available units_sold_30d estimated_annual_turnover
labor_efficiency | labor_efficiency=location_id | scheduled_date:day | department location_name city state | sum labor_efficiency_shifts_scheduled=shifts_scheduled labor_efficiency_shifts_completed=shifts_completed shifts_called_out labor_efficiency_shifts_no_show=shifts_no_show
location_performance | location_performance=location_id |  | location_name city state location_type | 
loyalty_cohort | loyalty_cohort=member_id | signup_date:day first_purchase_date:day | loyalty_tier first_name last_name email | sum points_balance total_spend total_transactions lifetime_points_earned tier_upgrades ; average avg_transaction_value ; count member_count=member_id
order_fulfillment_funnel | order_fulfillment_funnel=order_id warehouse=warehouse_location_id store=store_location_id | order_date:day | order_status fulfillment_status load_status pipeline_stage store_name | sum order_line_items total_qty_ordered total_qty_approved ; average days_order_to_fulfill days_order_to_delivery
product_performance | product_performance=location_id product=product_id | transaction_date:day | location_name product_name department_name category subcategory | sum product_performance_units_sold=units_sold product_performance_gross_revenue=gross_revenue product_performance_total_discounts=total_discounts product_performance_net_revenue=net_revenue product_performance_transaction_count=transaction_count total_cost gross_profit
promotion_effectiveness | promotion_effectiveness=product_id | ad_week_start:week | ad_name product_name category is_ad_item | sum days_active total_units_sold promotion_effectiveness_total_revenue=total_revenue
shrink_analysis | shrink_analysis=location_id product=product_id | event_date:day | location_name city state product_name category shrinkage_type | sum event_count total_quantity_lost shrink_analysis_total_value_lost=total_value_lost
store_weekly_summary | store_weekly_summary=location_id | week_start:week | location_name city state | sum store_weekly_summary_transaction_count=transaction_count store_weekly_summary_total_revenue=total_revenue loyalty_transaction_count store_weekly_summary_shrink_event_count=shrink_event_count shrink_qty_lost shrink_value_lost below_reorder_count out_of_stock_count orders_placed orders_delivered total_labor_hours total_labor_cost
supply_chain_summary | supply_chain_summary=order_id warehouse=warehouse_location_id store=store_location_id | order_date:day | order_status fulfillment_status load_status store_name | average supply_chain_summary_hours_to_fulfill=hours_to_fulfill supply_chain_summary_hours_in_transit=hours_in_transit
transport_daily_metrics | transport_daily_metrics=warehouse_location_id | load_date:day | warehouse_name | sum transport_daily_metrics_total_loads=total_loads completed_loads cancelled_loads pending_loads on_time_loads active_trucks total_transit_hours ; average avg_transit_hours
transport_load_summary | transport_load_summary=load_id truck=truck_id warehouse=warehouse_location_id store=store_location_id | load_date:day | status truck_id license_plate truck_model driver warehouse_name store_name | average transport_load_summary_hours_in_transit=hours_in_transit ; flags has_departed has_arrived is_on_time
"""

# Domain | metric | kind | measure, or numerator / denominator metrics, or the offset metric
_METRICS = """
fulfillment_sc | fulfillment_volume | simple | daily_fulfillment_summary_total_orders
fulfillment_sc | completed_fulfillments | simple | completed_orders
fulfillment_sc | cancelled_fulfillments | simple | cancelled_orders
fulfillment_sc | total_qty_requested | simple | daily_fulfillment_summary_total_qty_requested
fulfillment_sc | total_qty_picked | simple | daily_fulfillment_summary_total_qty_picked
fulfillment_sc | shorted_lines | simple | shorted_lines
fulfillment_sc | avg_fulfillment_cycle_time | simple | fulfillment_operations_hours_to_fulfill
fulfillment_sc | delivered_orders | simple | delivered_count
fulfillment_sc | fill_rate | ratio | total_qty_picked / total_qty_requested
fulfillment_sc | fulfillment_completion_rate | ratio | completed_fulfillments / fulfillment_volume
fulfillment_sc | ytd_fulfillment_volume | to_date year | daily_fulfillment_summary_total_orders
inventory_shrink | current_stock_on_hand | simple | inventory_summary_quantity_on_hand
inventory_shrink | current_stock_available | simple | inventory_summary_quantity_available
inventory_shrink | units_sold_30d | simple | units_sold_30d
inventory_shrink | shrink_value | simple | shrink_analysis_total_value_lost
inventory_shrink | shrink_quantity | simple | total_quantity_lost
inventory_shrink | shrink_events | simple | event_count
inventory_shrink | expired_shrink_value | simple | expired_value_lost
inventory_shrink | spoilage_shrink_value | simple | spoilage_value_lost
inventory_shrink | damaged_shrink_value | simple | damaged_value_lost
inventory_shrink | theft_shrink_value | simple | theft_value_lost
inventory_shrink | ytd_shrink_value | to_date year | shrink_analysis_total_value_lost
labor_attendance | total_labor_cost | simple | actual_cost
labor_attendance | total_scheduled_labor_cost | simple | scheduled_cost
labor_attendance | total_hours_worked | simple | employee_hours_vs_schedule_net_hours_worked
labor_attendance | total_scheduled_hours | simple | employee_hours_vs_schedule_scheduled_hours
labor_attendance | employees_present | simple | employees_present
labor_attendance | total_shifts | simple | total_shifts
labor_attendance | completed_shifts | simple | completed_shifts
labor_attendance | no_show_shifts | simple | no_show_shifts
labor_attendance | revenue_processed | simple | total_revenue_processed
labor_attendance | attendance_rate | ratio | completed_shifts / total_shifts
labor_attendance | no_show_rate | ratio | no_show_shifts / total_shifts
labor_attendance | schedule_attainment_rate | ratio | total_hours_worked / total_scheduled_hours
labor_attendance | labor_cost_variance | ratio | total_labor_cost / total_scheduled_labor_cost
labor_attendance | ytd_labor_cost | to_date year | actual_cost
loyalty | total_members | simple | member_count
loyalty | total_lifetime_spend | simple | total_spend
loyalty | total_points_balance | simple | points_balance
loyalty | total_lifetime_points_earned | simple | lifetime_points_earned
loyalty | loyalty_transactions | simple | total_transactions
loyalty | avg_lifetime_value | ratio | total_lifetime_spend / total_members
loyalty | avg_points_per_member | ratio | total_points_balance / total_members
loyalty | avg_loyalty_transaction_value | ratio | total_lifetime_spend / loyalty_transactions
sales_revenue | total_revenue | simple | daily_revenue_total_revenue
sales_revenue | pos_revenue | simple | pos_revenue
sales_revenue | total_transactions | simple | pos_transaction_count
sales_revenue | total_units_sold | simple | product_performance_units_sold
sales_revenue | gross_revenue | simple | product_performance_gross_revenue
sales_revenue | net_revenue | simple | product_performance_net_revenue
sales_revenue | gross_profit | simple | gross_profit
sales_revenue | total_discount_savings | simple | total_discount_savings
sales_revenue | coupon_savings | simple | coupon_savings_total
sales_revenue | deal_savings | simple | deal_savings_total
sales_revenue | total_cost | simple | total_cost
sales_revenue | total_discounts | simple | product_performance_total_discounts
sales_revenue | avg_transaction_value | ratio | total_revenue / total_transactions
sales_revenue | gross_margin_pct | ratio | gross_profit / net_revenue
sales_revenue | discount_rate_pct | ratio | total_discounts / gross_revenue
sales_revenue | revenue_wow_growth | offset 7 | total_revenue
sales_revenue | revenue_dod_growth | offset 1 | total_revenue
sales_revenue | ytd_revenue | to_date year | daily_revenue_total_revenue
sales_revenue | mtd_revenue | to_date month | daily_revenue_total_revenue
transport | total_transport_loads | simple | transport_daily_metrics_total_loads
transport | completed_transport_loads | simple | completed_loads
transport | on_time_loads | simple | on_time_loads
transport | avg_transit_hours | simple | avg_transit_hours
transport | active_trucks_count | simple | active_trucks
transport | on_time_delivery_pct | ratio | on_time_loads / completed_transport_loads
transport | transport_completion_rate | ratio | completed_transport_loads / total_transport_loads
"""


@dataclass(frozen=True)
class Measure:
    mart: str
    name: str
    aggregate: str
    column: str


@dataclass(frozen=True)
class SemanticMart:
    mart: str
    entities: dict[str, str]
    time_columns: dict[str, str]
    dimensions: tuple[str, ...]
    measures: dict[str, Measure] = field(repr=False)

    @property
    def time_column(self) -> str | None:
        return next(iter(self.time_columns), None)


@dataclass(frozen=True)
class Metric:
    domain: str
    name: str
    kind: str  # simple, ratio, to_date, offset
    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    base: str | None = None
    period: str | None = None
    days: int | None = None


def _pairs(text: str, separator: str = "=") -> dict[str, str]:
    return {left: right or left for left, _, right in (item.partition(separator) for item in text.split())}


def _mart(line: str) -> SemanticMart:
    name, entities, times, dimensions, groups = (part.strip() for part in line.split("|"))
    mart = f"mart_{name}"
    measures = {}
    for group in filter(None, (g.strip() for g in groups.split(";"))):
        aggregate, _, names = group.partition(" ")
        for measure, column in _pairs(names).items():
            measures[measure] = Measure(mart, measure, aggregate, column)
    return SemanticMart(mart, _pairs(entities), _pairs(times, ":"), tuple(dimensions.split()), measures)


def _metric(line: str) -> Metric:
    domain, name, kind, source = (part.strip() for part in line.split("|"))
    kind, _, argument = kind.partition(" ")
    if kind == "ratio":
        numerator, denominator = source.split(" / ")
        return Metric(domain, name, kind, numerator=numerator, denominator=denominator)
    if kind == "offset":
        return Metric(domain, name, kind, base=source, days=int(argument))
    return Metric(domain, name, kind, measure=source, period=argument or None)


MARTS: dict[str, SemanticMart] = {m.mart: m for m in map(_mart, _MARTS.strip().splitlines())}
METRICS: dict[str, Metric] = {m.name: m for m in map(_metric, _METRICS.strip().splitlines())}
MEASURES: dict[str, Measure] = {name: m for mart in MARTS.values() for name, m in mart.measures.items()}


def exact(frame: DataFrame, column: str) -> Column:
    """A floating column as decimal, so that its sum does not depend on task order."""
    kind = dict(frame.dtypes)[column]
    return F.col(column).cast("decimal(28,10)") if kind in ("double", "float") else F.col(column)


def aggregate(frame: DataFrame, kind: str, column: str) -> Column:
    if kind == "count":
        return F.count(column)
    if kind == "flags":
        return F.count_if(column)
    value = exact(frame, column)
    return F.sum(value) if kind == "sum" else divide(F.sum(value), F.count(value))


class MetricLayer:
    """`table` resolves a mart name to its DataFrame."""

    def __init__(self, table: Callable[[str], DataFrame]):
        self.table = table

    def query(
        self,
        metrics: Iterable[str],
        group_by: Iterable[str] = (),
        grain: str | None = "day",
        where: Column | None = None,
    ) -> DataFrame:
        """Metrics side by side; a group missing from one mart gives NULL there.

        `group_by` takes dimensions or entity names of the marts; `grain=None` leaves time out.
        """
        metrics, group_by = list(metrics), list(group_by)
        keys = ([TIME] if grain else []) + group_by
        plain = [m for m in metrics if METRICS[m].kind in ("simple", "ratio")]
        parts = [self._measures(plain, group_by, grain, where)] if plain else []
        for name in metrics:
            kind = METRICS[name].kind
            if kind in ("to_date", "offset"):
                if not grain:
                    raise ValueError(f"{name} is a series; ask for a grain")
                build = self._to_date if kind == "to_date" else self._offset
                parts.append(build(METRICS[name], group_by, where, grain))
        return self._merge(parts, keys).select(*keys, *metrics)

    def measures(
        self, names: Iterable[str], group_by: Iterable[str] = (), grain: str | None = "day", time_column: str | None = None
    ) -> DataFrame:
        """Raw measures of one mart, including those no metric uses, by any of its time columns."""
        wanted = {name: MEASURES[name] for name in names}
        (mart,) = {m.mart for m in wanted.values()}
        return self._group(mart, wanted, list(group_by), grain, None, time_column)

    # ---- simple and ratio

    def _measures(self, metrics: list[str], group_by: list[str], grain: str | None, where: Column | None) -> DataFrame:
        simple: dict[str, Measure] = {}
        for name in metrics:
            metric = METRICS[name]
            for source in [name] if metric.kind == "simple" else [metric.numerator, metric.denominator]:
                simple[source] = MEASURES[METRICS[source].measure]
        by_mart: dict[str, dict[str, Measure]] = {}
        for name, measure in simple.items():
            by_mart.setdefault(measure.mart, {})[name] = measure
        keys = ([TIME] if grain else []) + group_by
        parts = [self._group(mart, wanted, group_by, grain, where) for mart, wanted in by_mart.items()]
        merged = self._merge(parts, keys)
        ratios = {
            m: divide(METRICS[m].numerator, METRICS[m].denominator) for m in metrics if METRICS[m].kind == "ratio"
        }
        return merged.withColumns(ratios).select(*keys, *metrics) if ratios else merged.select(*keys, *metrics)

    def _group(
        self,
        mart: str,
        wanted: dict[str, Measure],
        group_by: list[str],
        grain: str | None,
        where: Column | None,
        time_column: str | None = None,
    ) -> DataFrame:
        spec, frame = MARTS[mart], self.table(mart)
        if where is not None:
            frame = frame.filter(where)
        keys = [F.col(self._column(spec, name)).alias(name) for name in group_by]
        if grain:
            if spec.time_column is None or time_column and time_column not in spec.time_columns:
                raise ValueError(f"{mart} has no time dimension {time_column or ''}")
            keys.insert(0, F.to_date(F.date_trunc(grain, F.col(time_column or spec.time_column))).alias(TIME))
        return frame.groupBy(*keys).agg(
            *[aggregate(frame, m.aggregate, m.column).alias(name) for name, m in wanted.items()]
        )

    @staticmethod
    def _column(spec: SemanticMart, name: str) -> str:
        if name in spec.entities:
            return spec.entities[name]
        if name in spec.dimensions or name in spec.entities.values():
            return name
        raise ValueError(f"{name} is neither a dimension nor an entity of {spec.mart}")

    @staticmethod
    def _merge(parts: list[DataFrame], keys: list[str]) -> DataFrame:
        """Every part has one row per key, so a union and one small aggregation line them up, null keys too."""
        if len(parts) == 1:
            return parts[0]
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        values = [c for c in stacked.columns if c not in keys]
        return stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in values])

    # ---- series

    def _daily(self, metric: str, measure: str, group_by: list[str], where: Column | None) -> DataFrame:
        m = MEASURES[measure]
        daily = self._group(m.mart, {metric: m}, group_by, "day", where)
        return daily.filter(F.col(TIME).isNotNull())

    def _to_date(self, metric: Metric, group_by: list[str], where: Column | None, grain: str = "day") -> DataFrame:
        """Running total that restarts every period; a day without data repeats the total so far.

        Each total is stretched over the days up to the next one instead of joining a calendar. A coarser
        grain shows the total at the end of each of its periods.
        """
        daily = self._daily(metric.name, metric.measure, group_by, where).withColumn(
            "_period", F.trunc(TIME, metric.period)
        )
        last_day = daily.agg(F.max(TIME)).scalar()
        series = Window.partitionBy("_period", *group_by).orderBy(TIME)
        so_far = F.sum(metric.name).over(series.rowsBetween(Window.unboundedPreceding, 0))
        step = F.expr("interval 1 year" if metric.period == "year" else "interval 1 month")
        period_end = F.date_sub((F.col("_period") + step).cast("date"), 1)
        until = F.coalesce(F.date_sub(F.lead(TIME).over(series), 1), F.least(period_end, last_day))
        days = (
            daily.withColumns({"_total": so_far, "_until": until})
            .withColumn(TIME, F.explode(F.sequence(TIME, "_until")))
            .select(TIME, *group_by, F.col("_total").alias(metric.name))
        )
        if grain == "day":
            return days
        shown = F.to_date(F.date_trunc(grain, TIME))
        return days.groupBy(shown.alias("_shown"), *group_by).agg(F.max_by(metric.name, TIME).alias(metric.name)).withColumnRenamed("_shown", TIME)

    def _offset(self, metric: Metric, group_by: list[str], where: Column | None, grain: str = "day") -> DataFrame:
        """Today minus the same metric N days ago, for days where both exist.

        At a coarser grain: a period's total minus the total of its days moved N days back.
        """
        daily = self._daily(metric.name, METRICS[metric.base].measure, group_by, where)
        earlier = daily.select(
            F.date_add(TIME, metric.days).alias("_then"),
            *[F.col(g).alias(f"_then_{g}") for g in group_by],
            F.col(metric.name).alias("_before"),
        )
        if grain != "day":
            shown = lambda day: F.to_date(F.date_trunc(grain, day))
            daily = daily.groupBy(shown(TIME).alias(TIME), *group_by).agg(F.sum(metric.name).alias(metric.name))
            earlier = earlier.groupBy(shown("_then").alias("_then"), *[f"_then_{g}" for g in group_by]).agg(F.sum("_before").alias("_before"))
        same = F.col(TIME) == F.col("_then")
        for name in group_by:
            same = same & F.col(name).eqNullSafe(F.col(f"_then_{name}"))
        return daily.join(earlier, same).select(
            TIME, *group_by, (F.col(metric.name) - F.col("_before")).alias(metric.name)
        )
