"""Attendance, schedule and labour-cost marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.functions import clock_seconds, hours_elapsed, lookup, percent, ratio
from tillhouse.operators.intermediate import attendance_status
from tillhouse.plans.registry import Params, model

CENTS = "decimal(18,2)"


def _count(status: str) -> Column:
    return F.count_if(F.col("status") == status)


@model("M-01", "int_hr_labor_enriched")
def mart_attendance_compliance(p: Params, labor: DataFrame) -> DataFrame:
    status = F.col("attendance_status")
    sums = (
        labor.filter("schedule_status IS NOT NULL")
        .groupBy(F.col("scheduled_date").alias("report_date"), "location_id", "department")
        .agg(
            F.count("*").alias("scheduled_shifts"),
            F.count_if(status == "NO_SHOW").alias("no_show_shifts"),
            F.count_if("is_late_arrival").alias("late_arrival_shifts"),
            F.count_if("is_overtime").alias("overtime_shifts"),
            F.count_if(status.isin("ATTENDED", "PARTIAL", "SHORT")).alias("worked_shifts"),
            F.count_if("is_break_compliant").alias("break_compliant_shifts"),
        )
    )
    return sums.select(
        "*",
        percent("no_show_shifts", "scheduled_shifts", 2).alias("no_show_rate_pct"),
        percent("late_arrival_shifts", "scheduled_shifts", 2).alias("late_arrival_rate_pct"),
        percent("overtime_shifts", "worked_shifts", 2).alias("overtime_rate_pct"),
        percent("break_compliant_shifts", "worked_shifts", 2).alias("break_compliance_rate_pct"),
    )


@model("M-02", "stg_timeclock_events")
def mart_attendance_summary(p: Params, events: DataFrame) -> DataFrame:
    """Clocked and net hours; a break counts when a start is directly followed by an end that day."""
    kind = F.col("event_type")
    days = events.groupBy("employee_id", "location_id", "event_date").agg(
        F.min(F.when(kind == "clock_in", F.col("event_dt"))).alias("clock_in_at"),
        F.max(F.when(kind == "clock_out", F.col("event_dt"))).alias("clock_out_at"),
        *[
            F.count_if(kind == k).alias(f"{k}_count")
            for k in ("clock_in", "clock_out", "break_start", "break_end")
        ],
    )
    # Moments with equal time are ordered by event id, so a rerun pairs them alike.
    following = Window.partitionBy("employee_id", "event_date").orderBy("event_dt", "event_id")
    breaks = (
        events.filter(kind.isin("break_start", "break_end"))
        .withColumns({"_end": F.lead("event_dt").over(following), "_next": F.lead("event_type").over(following)})
        .filter((kind == "break_start") & (F.col("_next") == "break_end"))
        .groupBy("employee_id", "event_date")
        .agg(
            F.count("*").alias("completed_break_pairs"),
            F.sum(hours_elapsed("event_dt", "_end")).cast(CENTS).alias("total_break_hours"),
        )
    )
    overnight = F.when(clock_seconds("clock_out_at") <= clock_seconds("clock_in_at"), 24).otherwise(0)
    clocked = F.coalesce(hours_elapsed("clock_in_at", "clock_out_at") + overnight, F.lit(0)).cast(CENTS)
    paused = F.coalesce("total_break_hours", F.lit(0)).cast(CENTS)
    return (
        days.join(breaks, ["employee_id", "event_date"], "left")
        .withColumns({"total_clocked_hours": clocked, "total_break_hours": paused})
        .select(
            "employee_id",
            "event_date",
            "location_id",
            "clock_in_at",
            "clock_out_at",
            "total_clocked_hours",
            "total_break_hours",
            F.when(
                F.col("total_clocked_hours") > 0,
                (F.col("total_clocked_hours") - F.col("total_break_hours")).cast(CENTS),
            ).alias("net_hours_worked"),
            "clock_in_count",
            "clock_out_count",
            "break_start_count",
            "break_end_count",
            F.coalesce("completed_break_pairs", F.lit(0)).alias("completed_break_pairs"),
            ((F.col("clock_in_count") > 0) & (F.col("clock_out_count") > 0)).alias("has_complete_pair"),
            (
                (F.col("clock_in_count") != F.col("clock_out_count"))
                | (F.col("break_start_count") != F.col("break_end_count"))
            ).alias("has_unpaired_events"),
        )
    )


@model("M-04", "mart_attendance_summary", "stg_locations", "stg_employees")
def mart_daily_attendance_stats(
    p: Params, attendance: DataFrame, locations: DataFrame, employees: DataFrame
) -> DataFrame:
    """The input has one row per employee, day and site, so counting rows counts employees."""
    staffed = lookup(attendance, employees, "employee_id", _department="department")
    known = F.col("employee_id").isNotNull()
    sums = staffed.groupBy("event_date", "location_id").agg(
        F.count("employee_id").alias("employees_present"),
        F.count_if(known & F.col("has_complete_pair")).alias("employees_with_complete_pair"),
        F.count_if(known & F.col("has_unpaired_events")).alias("employees_with_unpaired_events"),
        F.count_if(known & F.col("_department").isNotNull()).alias("employees_with_dept"),
        F.sum("total_clocked_hours").alias("total_clocked_hours"),
        F.sum("total_break_hours").alias("total_break_hours"),
        F.sum("net_hours_worked").alias("total_net_hours"),
        F.count_if(F.col("clock_in_count") > 1).alias("multi_clock_in_count"),
        F.count_if(F.col("clock_out_count") > 1).alias("multi_clock_out_count"),
    )
    named = lookup(sums, locations, "location_id", location_name="location_name")
    return named.select(
        "event_date",
        "location_id",
        "location_name",
        "employees_present",
        "employees_with_complete_pair",
        "employees_with_unpaired_events",
        "employees_with_dept",
        "total_clocked_hours",
        "total_break_hours",
        "total_net_hours",
        ratio("total_clocked_hours", "employees_present", 2).alias("avg_hours_per_employee"),
        "multi_clock_in_count",
        "multi_clock_out_count",
        ratio("total_break_hours", "employees_present", 2).alias("avg_break_hours_per_employee"),
        F.when(F.col("total_clocked_hours") > 0, percent("total_break_hours", "total_clocked_hours", 1)).alias(
            "break_pct_of_clocked"
        ),
    )


@model("M-08", "stg_hr_schedules", "stg_employees", "stg_locations")
def mart_department_labor(p: Params, schedules: DataFrame, employees: DataFrame, locations: DataFrame) -> DataFrame:
    shifts = lookup(schedules.filter("status <> 'scheduled'"), employees, "employee_id", _rate="hourly_rate")
    cost = F.col("_rate") * F.col("scheduled_hours")
    sums = shifts.groupBy("scheduled_date", "location_id", "department").agg(
        F.count_distinct("employee_id").alias("employees_scheduled"),
        F.count("*").alias("total_shifts"),
        _count("completed").alias("completed_shifts"),
        _count("called_out").alias("called_out_shifts"),
        _count("no_show").alias("no_show_shifts"),
        F.sum("scheduled_hours").cast(CENTS).alias("scheduled_hours"),
        F.sum("actual_hours").cast(CENTS).alias("actual_hours"),
        F.sum(cost).cast(CENTS).alias("scheduled_cost"),
        F.sum(F.when(F.col("status") == "completed", cost).otherwise(0)).cast(CENTS).alias("actual_cost"),
    )
    named = lookup(sums, locations, "location_id", location_name="location_name", city="city", state="state")
    return named.select(
        F.col("scheduled_date").alias("report_date"),
        "location_id",
        "location_name",
        "city",
        "state",
        "department",
        "employees_scheduled",
        "total_shifts",
        "completed_shifts",
        "called_out_shifts",
        "no_show_shifts",
        percent("completed_shifts", "total_shifts", 1).alias("attendance_rate_pct"),
        "scheduled_hours",
        "actual_hours",
        percent("actual_hours", "scheduled_hours", 1).alias("hours_utilization_pct"),
        "scheduled_cost",
        "actual_cost",
        (F.col("actual_cost") - F.col("scheduled_cost")).cast(CENTS).alias("cost_variance"),
    )


@model("M-11", "stg_hr_schedules", "stg_employees", "stg_locations", "stg_pos_transactions")
def mart_employee_cost(
    p: Params, schedules: DataFrame, employees: DataFrame, locations: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Pay depends on the employee alone, so shifts are summed before the employee is joined."""
    sums = (
        schedules.filter("status <> 'scheduled'")
        .groupBy("scheduled_date", "employee_id", "location_id", "department")
        .agg(
            F.count("*").alias("shifts_scheduled"),
            _count("completed").alias("shifts_completed"),
            _count("called_out").alias("shifts_called_out"),
            _count("no_show").alias("shifts_no_show"),
            F.sum("scheduled_hours").cast(CENTS).alias("scheduled_hours"),
            F.sum("actual_hours").cast(CENTS).alias("actual_hours_worked"),
        )
    )
    revenue = transactions.groupBy("transaction_date", F.col("location_id").alias("_site")).agg(
        F.sum("total").cast(CENTS).alias("daily_revenue")
    )
    paid = lookup(
        sums, employees, "employee_id",
        full_name="full_name", job_title="job_title", hourly_rate="hourly_rate", status="status",
    )
    paid = lookup(paid, locations, "location_id", location_name="location_name", city="city", state="state")
    same = (F.col("_site") == F.col("location_id")) & (F.col("transaction_date") == F.col("scheduled_date"))
    rate = F.col("hourly_rate")
    costed = paid.join(revenue, same, "left").withColumns(
        {
            "scheduled_labor_cost": (F.col("scheduled_hours") * rate).cast(CENTS),
            "actual_labor_cost": (F.col("actual_hours_worked") * rate).cast(CENTS),
        }
    )
    return costed.select(
        "scheduled_date",
        "employee_id",
        "full_name",
        "job_title",
        "department",
        "hourly_rate",
        "status",
        "location_id",
        "location_name",
        "city",
        "state",
        "shifts_scheduled",
        "shifts_completed",
        "shifts_called_out",
        "shifts_no_show",
        "scheduled_hours",
        "scheduled_labor_cost",
        "actual_hours_worked",
        "actual_labor_cost",
        (F.col("actual_labor_cost") - F.col("scheduled_labor_cost")).cast(CENTS).alias("cost_variance"),
        "daily_revenue",
        F.when(F.col("daily_revenue") > 0, percent("actual_labor_cost", "daily_revenue", 3)).alias(
            "labor_pct_of_revenue"
        ),
    )


@model("M-12", "mart_attendance_summary", "stg_hr_schedules", "stg_employees")
def mart_employee_hours_vs_schedule(
    p: Params, attendance: DataFrame, schedules: DataFrame, employees: DataFrame
) -> DataFrame:
    planned = schedules.select(
        F.col("employee_id").alias("_emp"),
        F.col("scheduled_date").alias("_day"),
        F.col("location_id").alias("_site"),
        "scheduled_hours",
        F.col("actual_hours").alias("schedule_actual_hours"),
        F.col("status").alias("schedule_status"),
    )
    worked = attendance.withColumnRenamed("employee_id", "_a_emp").withColumnRenamed("location_id", "_a_site")
    same = (
        (F.col("_emp") == F.col("_a_emp")) & (F.col("_day") == F.col("event_date")) & (F.col("_site") == F.col("_a_site"))
    )
    both = worked.join(planned, same, "full").withColumns(
        {
            "report_date": F.coalesce("event_date", "_day"),
            "employee_id": F.coalesce("_a_emp", "_emp"),
            "location_id": F.coalesce("_a_site", "_site"),
        }
    )
    both = lookup(
        both, employees, "employee_id",
        full_name="full_name", department="department", job_title="job_title",
        hourly_rate="hourly_rate", is_active="is_active",
    )
    net, plan = F.col("net_hours_worked"), F.col("scheduled_hours")
    return both.select(
        "report_date",
        "employee_id",
        "location_id",
        "full_name",
        "department",
        "job_title",
        "hourly_rate",
        "is_active",
        "scheduled_hours",
        "schedule_actual_hours",
        "schedule_status",
        "total_clocked_hours",
        "net_hours_worked",
        "total_break_hours",
        "clock_in_at",
        "clock_out_at",
        "has_complete_pair",
        "has_unpaired_events",
        attendance_status(F.col("_emp").isNotNull(), F.col("_a_emp").isNotNull(), net, plan).alias("attendance_status"),
        percent(net, plan, 1).alias("hours_attainment_pct"),
        F.round(net * F.col("hourly_rate"), 2).cast(CENTS).alias("estimated_labor_cost"),
    )


@model("M-13", "stg_pos_transactions", "stg_employees", "stg_locations", "stg_timeclock_events")
def mart_employee_productivity(
    p: Params, transactions: DataFrame, employees: DataFrame, locations: DataFrame, events: DataFrame
) -> DataFrame:
    """Hours are last clock-out minus first clock-in, less half an hour when any break was started."""
    kind = F.col("event_type")
    clock = events.groupBy(F.col("employee_id").alias("_emp"), "event_date").agg(
        F.min(F.when(kind == "clock_in", F.col("event_dt"))).alias("_in"),
        F.max(F.when(kind == "clock_out", F.col("event_dt"))).alias("_out"),
        F.count_if(kind == "break_start").alias("_breaks"),
    )
    pause = F.when(F.col("_breaks") > 0, 0.5).otherwise(0.0).cast("decimal(2,1)")
    worked = clock.filter("_out > _in").select(
        "_emp", "event_date", F.round(hours_elapsed("_in", "_out") - pause, 2).cast(CENTS).alias("hours_worked")
    )
    sums = (
        transactions.filter("employee_id IS NOT NULL")
        .groupBy(F.col("transaction_date").alias("sale_date"), "employee_id", "location_id")
        .agg(F.count("*").alias("transaction_count"), F.sum("total").cast(CENTS).alias("total_revenue_processed"))
    )
    named = lookup(
        sums, employees, "employee_id",
        full_name="full_name", department="department", job_title="job_title", hourly_rate="hourly_rate", status="status",
    )
    named = lookup(named, locations, "location_id", location_name="location_name", city="city", state="state")
    same = (F.col("_emp") == F.col("employee_id")) & (F.col("event_date") == F.col("sale_date"))
    pay = F.col("hourly_rate") * F.coalesce("hours_worked", F.lit(0))
    busy = F.col("hours_worked") > 0
    return named.join(worked, same, "left").select(
        "sale_date",
        "employee_id",
        "full_name",
        "department",
        "job_title",
        "hourly_rate",
        "status",
        "location_id",
        "location_name",
        "city",
        "state",
        "transaction_count",
        "total_revenue_processed",
        "hours_worked",
        F.when(busy, ratio("total_revenue_processed", "hours_worked", 2)).alias("revenue_per_hour"),
        F.when(busy, ratio("transaction_count", "hours_worked", 2)).alias("transactions_per_hour"),
        F.round(pay, 2).cast(CENTS).alias("estimated_labor_cost"),
        F.when(F.col("total_revenue_processed") > 0, percent(pay, "total_revenue_processed", 2)).alias(
            "labor_cost_pct_revenue"
        ),
    )


@model("M-22", "mart_department_labor", "stg_pos_departments", "mart_department_performance")
def mart_labor_cost_by_department(
    p: Params, labor: DataFrame, departments: DataFrame, performance: DataFrame
) -> DataFrame:
    """Labour and sales departments meet on the lower-case name."""
    ids = departments.select(F.lower("department_name").alias("_name"), F.col("department_id").alias("_dept"))
    sold = performance.select(
        "transaction_date",
        F.col("location_id").alias("_site"),
        F.col("department_id").alias("_sold_dept"),
        "net_revenue",
    )
    same = (
        (F.col("transaction_date") == F.col("report_date"))
        & (F.col("_site") == F.col("location_id"))
        & (F.col("_sold_dept") == F.col("_dept"))
    )
    joined = labor.join(ids, F.col("_name") == F.lower("department"), "left").join(sold, same, "left")
    return joined.select(
        "report_date",
        "location_id",
        "location_name",
        "department",
        "scheduled_hours",
        "actual_hours",
        "scheduled_cost",
        "actual_cost",
        "cost_variance",
        "attendance_rate_pct",
        F.coalesce("net_revenue", F.lit(0)).cast("decimal(28,6)").alias("revenue_proxy"),
        F.when(F.col("net_revenue") > 0, percent("actual_cost", "net_revenue", 2)).alias("labor_cost_pct_of_revenue"),
    )


@model("M-23", "stg_hr_schedules", "stg_locations")
def mart_labor_efficiency(p: Params, schedules: DataFrame, locations: DataFrame) -> DataFrame:
    """Resolved shifts only, so `shifts_pending` is always zero."""
    sums = (
        schedules.filter("status <> 'scheduled'")
        .groupBy("scheduled_date", "location_id", "department")
        .agg(
            F.count("*").alias("shifts_scheduled"),
            _count("completed").alias("shifts_completed"),
            _count("called_out").alias("shifts_called_out"),
            _count("no_show").alias("shifts_no_show"),
            _count("scheduled").alias("shifts_pending"),
        )
    )
    named = lookup(sums, locations, "location_id", location_name="location_name", city="city", state="state")
    return named.select(
        "scheduled_date",
        "location_id",
        "location_name",
        "city",
        "state",
        "department",
        "shifts_scheduled",
        "shifts_completed",
        "shifts_called_out",
        "shifts_no_show",
        "shifts_pending",
        percent("shifts_completed", "shifts_scheduled", 1).alias("completion_rate_pct"),
        percent("shifts_no_show", "shifts_scheduled", 1).alias("no_show_rate_pct"),
    )
