"""Derives the 27 raw tables from a star schema of orders, parts and events.

The rules are listed in FIXTURES.md part 2. Keys drive everything through integer arithmetic, so
another engine can reproduce the rows. Columns are typed already; staging casts become no-ops.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.functions import MONEY, money, rounded, week_start
from tillhouse.sources.raw_tables import BATCHED_AT, EXTRACTED_AT

# Lookup lists indexed by a key modulo their length.
STAFF_DEPARTMENTS = ["bakery", "deli", "management", "meat", "produce", "store", "transport", "warehouse"]
PART_DEPARTMENTS = {
    "ECONOMY": ("D1", "Bakery"),
    "LARGE": ("D2", "Deli"),
    "MEDIUM": ("D3", "Meat"),
    "PROMO": ("D4", "Produce"),
    "SMALL": ("D5", "Dairy"),
    "STANDARD": ("D6", "Frozen"),
}
TIERS = ["bronze", "silver", "gold", "platinum"]
PAYMENT_METHODS = ["cash", "credit", "debit", "ebt", "loyalty_points", "mobile_pay"]
SCENARIOS = [
    "normal",
    "rush_hour",
    "memorial_day_weekend",
    "memorial_day_weekend+rush_hour",
    "independence_day",
    "independence_day+rush_hour",
]
CLOCK_EVENTS = {"click": "clock_in", "purchase": "clock_out", "view": "break_start", "signup": "break_end", "error": "clock_out"}
SHIFT_STATUSES = ["completed", "completed", "no_show", "called_out", "scheduled"]
ORDER_STATUSES = ["pending", "approved", "delivered", "delivered"]
SHRINK_REASONS = ["damaged", "expired", "spoilage", "theft"]
EXTRACT_STAMP = "2024-02-01 00:00:00"
AD_EPOCH = "1995-01-02"
# Events are one month of January 2024; they move to the last full month of sales, so that labour meets revenue.
EVENT_SHIFT_DAYS = 8219
CLOCK_EPOCH = "2001-07-01"


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def _id(prefix: str, value: Column | str) -> Column:
    return F.concat(F.lit(prefix), (F.col(value) if isinstance(value, str) else value).cast("string"))


def _div(value: Column, by: int) -> Column:
    return F.floor(value / F.lit(by)).cast("bigint")


def _plus_seconds(moment: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(moment) + seconds.cast("bigint"))


def _day(text: str, plus: Column) -> Column:
    return F.date_add(F.lit(text).cast("date"), plus.cast("int"))


class OrderBookSource:
    """Callable `source("raw_pos.transactions") -> DataFrame`."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def __call__(self, name: str) -> DataFrame:
        frame = getattr(self, name.replace("raw_", "", 1).replace(".", "_"))
        stamp = F.lit(EXTRACT_STAMP).cast("timestamp")
        return frame.withColumn(EXTRACTED_AT, stamp).withColumn(BATCHED_AT, stamp)

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{table}.parquet")

    # ---- shared derivations

    @cached_property
    def _staff_count(self) -> Column:
        return self._read("supplier").agg(F.count("*")).scalar()

    @cached_property
    def _lines(self) -> DataFrame:
        """Order lines with an id. (order, line number) is not unique, so equal parts of one order are numbered.

        Lines are dealt by order, whose lines are few by their meaning: the numbering and the joins with orders that follow
        share that one exchange and its sort. Queries that need no id read `_amounts`.
        """
        alike = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
        order = Window.partitionBy(*alike).orderBy(
            "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"
        )
        numbered = self._read("lineitem").repartition("l_orderkey").withColumn("rn", F.row_number().over(order))
        return self._priced(numbered, F.concat_ws("-", *alike, "rn").alias("line_id"))

    @cached_property
    def _amounts(self) -> DataFrame:
        """Order lines without an id, as they lie in the file."""
        return self._priced(self._read("lineitem"))

    @staticmethod
    def _priced(lines: DataFrame, *more: Column) -> DataFrame:
        unit_price = money(F.col("l_extendedprice") / F.col("l_quantity"))
        return lines.select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_returnflag",
            F.col("l_linenumber").cast("bigint").alias("ln"),
            F.col("l_quantity").cast(MONEY).alias("quantity"),
            unit_price.alias("unit_price"),
            money(unit_price.cast("double") * F.col("l_discount")).alias("discount"),
            money(F.col("l_extendedprice") * 0.6 / F.col("l_quantity")).alias("unit_cost"),
            *more,
        )

    @cached_property
    def _store_sales(self) -> DataFrame:
        """Orders of customers in store nations, as till receipts without amounts. Who is in debt shows no card."""
        customers = self._read("customer").select("c_custkey", "c_nationkey", "c_acctbal").filter("c_nationkey % 5 <> 0")
        orders = self._read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        key = F.col("o_orderkey")
        return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey",
            "o_custkey",
            _id("L", "c_nationkey").alias("location_id"),
            F.when(F.col("c_acctbal") >= 0, _id("M", "o_custkey")).alias("member_id"),
            _plus_seconds(F.col("o_orderdate").cast("timestamp"), key * 37 % 86400).alias("transaction_dt"),
        )

    # ---- people and places

    @cached_property
    def hr_locations(self) -> DataFrame:
        n = F.col("n_nationkey")
        return (
            self._read("nation")
            .join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                _id("L", "n_nationkey").alias("location_id"),
                F.col("n_name").alias("name"),
                F.concat(n.cast("string"), F.lit(" Market Street")).alias("address"),
                F.concat(F.col("n_name"), F.lit(" City")).alias("city"),
                F.col("r_name").alias("state"),
                (n * 37 + 10000).cast("string").alias("zip"),
                _id("555-01", n + 10).alias("phone"),
                _day("1990-01-01", n * 30).alias("opened_date"),
                F.when(n % 5 == 0, "warehouse").otherwise("store").alias("location_type"),
                (n * 500 + 20000).alias("store_sqft"),
                (n % 8 + 10).alias("num_aisles"),
                F.lit(True).alias("is_active"),
            )
        )

    @cached_property
    def hr_employees(self) -> DataFrame:
        s = F.col("s_suppkey")
        return self._read("supplier").select(
            _id("E", s).alias("employee_id"),
            _id("L", "s_nationkey").alias("location_id"),
            _id("Given", s % 50).alias("first_name"),
            F.col("s_name").alias("last_name"),
            F.concat(_id("e", s), F.lit("@staff.example")).alias("email"),
            _day("1990-01-01", s % 2000).alias("hire_date"),
            F.when(s % 11 == 0, F.lit("2001-01-01").cast("date")).alias("termination_date"),
            _pick(STAFF_DEPARTMENTS, s).alias("department"),
            F.when(s % 3 == 0, "Lead").otherwise("Clerk").alias("job_title"),
            (s % 20 + 12).cast(MONEY).alias("hourly_rate"),
            F.when(s % 11 == 0, "terminated").otherwise("active").alias("status"),
        )

    @cached_property
    def _clock(self) -> DataFrame:
        kind = F.col("event_type")
        event = F.coalesce(*[F.when(kind == k, v) for k, v in CLOCK_EVENTS.items()])
        return (
            self._read("events")
            .filter(kind.isin(*CLOCK_EVENTS))
            .select(
                "event_id",
                (F.col("user_id") % self._staff_count).alias("emp_no"),
                event.alias("clock_type"),
                _plus_seconds(F.col("ts").cast("timestamp"), F.lit(-EVENT_SHIFT_DAYS * 86400)).alias("event_dt"),
            )
        )

    @cached_property
    def timeclock_events(self) -> DataFrame:
        return self._clock.select(
            _id("T", "event_id").alias("event_id"),
            _id("E", "emp_no").alias("employee_id"),
            _id("L", F.col("emp_no") % 25).alias("location_id"),
            F.col("clock_type").alias("event_type"),
            "event_dt",
            F.lit(None).cast("string").alias("notes"),
        )

    @cached_property
    def hr_schedules(self) -> DataFrame:
        """Most worked days get a shift; some also get one at another site that nobody works."""
        emp, day_no = F.col("emp_no"), F.col("day_no")
        days = (
            self._clock.select("emp_no", F.to_date("event_dt").alias("day"))
            .distinct()
            .withColumn("day_no", F.datediff("day", F.lit(CLOCK_EPOCH).cast("date")))
            .withColumn("seq", F.explode(F.array(F.lit(0), F.lit(1))))
        )
        phase = (emp + day_no) % 6
        night = (emp + day_no) % 4 == 0
        return days.filter(((F.col("seq") == 0) & (phase != 0)) | ((F.col("seq") == 1) & (phase == 1))).select(
            F.concat(F.lit("SC"), F.concat_ws("-", emp, day_no, "seq")).alias("schedule_id"),
            _id("L", (emp + F.col("seq")) % 25).alias("location_id"),
            _id("E", emp).alias("employee_id"),
            F.col("day").alias("scheduled_date"),
            _pick(STAFF_DEPARTMENTS, emp).alias("department"),
            F.when(night, "22:00:00").otherwise("08:00:00").alias("shift_start"),
            F.when(night, "06:00:00").otherwise("16:00:00").alias("shift_end"),
            _pick(SHIFT_STATUSES, emp * 3 + day_no + F.col("seq")).alias("status"),
            F.date_sub("day", 7).cast("timestamp").alias("created_at"),
        )

    # ---- catalogue

    @cached_property
    def pos_departments(self) -> DataFrame:
        kind = F.col("p_type")
        return (
            self._read("part")
            .select("p_type")
            .distinct()
            .select(
                self._department(kind, 0).alias("department_id"),
                self._department(kind, 1).alias("name"),
                F.substring(kind, 1, 3).alias("code"),
                F.lit("true").alias("is_active"),
            )
        )

    @staticmethod
    def _department(kind: Column, part: int) -> Column:
        return F.coalesce(*[F.when(kind == k, v[part]) for k, v in PART_DEPARTMENTS.items()])

    @cached_property
    def pos_products(self) -> DataFrame:
        k = F.col("p_partkey")
        return self._read("part").select(
            _id("P", k).alias("product_id"),
            _id("SKU", k).alias("sku"),
            F.lpad(k.cast("string"), 12, "0").alias("upc"),
            F.concat("p_name", F.lit(" #"), k.cast("string")).alias("name"),
            F.col("p_brand").alias("brand"),
            self._department(F.col("p_type"), 1).alias("department"),
            _id("C", F.col("p_size") % 10).alias("category"),
            _id("S", F.col("p_size") % 25).alias("subcategory"),
            F.lit("1").alias("unit_size"),
            F.lit("each").alias("unit_of_measure"),
            money(F.col("p_retailprice") * 0.6).alias("cost"),
            money("p_retailprice").alias("current_price"),
            (k % 4 == 0).alias("is_organic"),
            (k % 6 == 0).alias("is_local"),
            (k % 13 != 0).alias("is_active"),
        )

    @cached_property
    def pos_price_history(self) -> DataFrame:
        k, i = F.col("p_partkey"), F.col("step")

        def price(step: Column) -> Column:
            factor = ((step * 5 + 100) / F.lit(100.0)).cast("decimal(6,2)")
            return F.round(money("p_retailprice") * factor, 2).cast(MONEY)

        steps = self._read("part").withColumn("step", F.explode(F.array(*[F.lit(n) for n in range(4)])))
        changed = _day("1995-01-01", k % 90 + i * 500).cast("timestamp")
        return steps.select(
            F.concat(F.lit("PH"), F.concat_ws("-", k, i)).alias("price_history_id"),
            F.concat("p_name", F.lit(" #"), k.cast("string")).alias("product_name"),
            price(i - 1).alias("old_price"),
            price(i).alias("new_price"),
            _plus_seconds(changed, F.lit(21600)).alias("changed_at"),
        )

    @cached_property
    def pos_coupons(self) -> DataFrame:
        k = F.col("p_partkey")
        start = _day("1996-01-01", k % 300)
        return (
            self._read("part")
            .select(
                _id("CP", k).alias("coupon_id"),
                _id("SAVE", k).alias("code"),
                F.concat(F.lit("Save on "), "p_name").alias("description"),
                F.when(k % 4 == 0, "percent").otherwise("fixed").alias("coupon_type"),
                (k % 10 + 5).cast(MONEY).alias("discount_value"),
                F.lit(20).cast(MONEY).alias("min_purchase"),
                self._department(F.col("p_type"), 1).alias("department"),
                F.when(k % 100 == 0, 0).otherwise(k % 200 + 100).cast("int").alias("max_uses"),
                (k % 90).cast("int").alias("uses_count"),
                start.alias("valid_from"),
                F.date_add(start, 60).alias("valid_until"),
                (_div(k, 50) % 3 != 0).alias("is_active"),
            )
        )

    @cached_property
    def pos_combo_deals(self) -> DataFrame:
        k = F.col("p_partkey")
        start = _day("1996-01-01", k % 300)
        return (
            self._read("part")
            .select(
                _id("CD", k).alias("deal_id"),
                _id("Deal ", k).alias("name"),
                F.concat(F.lit("Bundle of "), "p_name").alias("description"),
                F.when(k % 4 == 1, "bundle").otherwise("bogo").alias("deal_type"),
                (k % 3 + 2).cast("int").alias("trigger_qty"),
                self._department(F.col("p_type"), 1).alias("trigger_department"),
                money(F.col("p_retailprice") * 0.8).alias("deal_price"),
                start.alias("valid_from"),
                F.date_add(start, 60).alias("valid_until"),
            )
        )

    # ---- sales

    @cached_property
    def pos_transactions(self) -> DataFrame:
        key = F.col("o_orderkey")
        line = ((F.col("unit_price") - F.col("discount")) * F.col("quantity")).cast(MONEY)
        sums = self._amounts.groupBy("l_orderkey").agg(F.sum(line).cast(MONEY).alias("subtotal"))
        amounts = self._store_sales.join(sums, key == F.col("l_orderkey")).select(
            _id("T", key).alias("transaction_id"),
            "location_id",
            _id("E", key % self._staff_count).alias("employee_id"),
            "member_id",
            "transaction_dt",
            "subtotal",
            F.when(key % 5 == 0, money(F.col("subtotal") * 0.05)).otherwise(F.lit(0).cast(MONEY)).alias("coupon_savings"),
            F.when(key % 7 == 0, money(F.col("subtotal") * 0.03)).otherwise(F.lit(0).cast(MONEY)).alias("deal_savings"),
            money(F.col("subtotal") * 0.08).alias("tax"),
            _pick(PAYMENT_METHODS, key).alias("payment_method"),
            _pick(SCENARIOS, _div(key, 6)).alias("scenario_tag"),
        )
        # Some receipts state a total that is half a unit off, for the balance checks to find.
        off = F.when(F.substring("transaction_id", 2, 20).cast("bigint") % 101 == 5, F.lit("0.5")).otherwise(F.lit("0")).cast(MONEY)
        total = (F.expr("subtotal + tax - coupon_savings - deal_savings") + off).cast(MONEY)
        return amounts.withColumn("total", total)

    @cached_property
    def pos_transaction_items(self) -> DataFrame:
        joined = self._lines.join(self._store_sales, F.col("l_orderkey") == F.col("o_orderkey"))
        return joined.select(
            _id("I", "line_id").alias("item_id"),
            _id("T", "o_orderkey").alias("transaction_id"),
            _id("P", "l_partkey").alias("product_id"),
            _id("Item ", "l_partkey").alias("product_name"),
            _id("C", F.col("l_partkey") % 10).alias("category"),
            "location_id",
            "quantity",
            "unit_price",
            "discount",
            ((F.col("unit_price") - F.col("discount")) * F.col("quantity")).cast(MONEY).alias("line_total"),
            "transaction_dt",
        )

    @cached_property
    def pos_loyalty_members(self) -> DataFrame:
        k = F.col("c_custkey")
        return (
            self._read("customer")
            .select(
                _id("M", k).alias("member_id"),
                _id("Given", k % 50).alias("first_name"),
                F.col("c_name").alias("last_name"),
                F.concat(_id("m", k), F.lit("@member.example")).alias("email"),
                _day("1995-01-01", k % 700).alias("signup_date"),
                (k % 500).cast("int").alias("points_balance"),
                _pick(TIERS, k).alias("tier"),
            )
        )

    @cached_property
    def pos_loyalty_point_transactions(self) -> DataFrame:
        key = F.substring("transaction_id", 2, 20).cast("bigint")
        earned = self.pos_transactions.filter("member_id IS NOT NULL").select(
            key.alias("k"),
            "member_id",
            "transaction_id",
            (F.floor(F.col("total").cast("double") / 10) % 1000).cast("int").alias("points_earned"),
            F.col("transaction_dt").alias("created_at"),
        )
        k = F.col("k")
        spent = F.when(k % 4 == 0, _div(F.col("points_earned"), 4)).otherwise(0).cast("int")
        change = F.col("points_earned") - F.col("points_redeemed")
        moved = earned.withColumn("points_redeemed", spent).withColumn("day", F.to_date("created_at"))
        # A shared card may hold a large part of all events, so the balance runs over days first, then within a day.
        before = Window.partitionBy("member_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
        opening = (
            moved.groupBy("member_id", "day")
            .agg(F.sum(change).alias("_moved"))
            .select("member_id", "day", F.coalesce(F.sum("_moved").over(before), F.lit(0)).alias("_opening"))
        )
        today = Window.partitionBy("member_id", "day").orderBy("created_at", "k")
        running = F.sum(change).over(today.rowsBetween(Window.unboundedPreceding, 0))
        moved = moved.withColumn("_today", running).join(opening, ["member_id", "day"])
        running = F.col("_opening") + F.col("_today")
        return moved.select(
            _id("PT", k).alias("pt_id"),
            "member_id",
            "transaction_id",
            "points_earned",
            "points_redeemed",
            F.when(k % 50 == 0, "tier_upgrade").when(k % 4 == 0, "redeem").otherwise("purchase").alias("reason"),
            (running + F.when(k % 97 == 0, 7).otherwise(0)).cast("int").alias("balance_after"),
            "created_at",
        )

    # ---- ordering and fulfilment

    @cached_property
    def _store_orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        customers = self._read("customer").select("c_custkey", "c_nationkey")
        orders = self._read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        nation = F.col("c_nationkey")
        return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            "o_orderkey",
            _div(key, 4).alias("k"),
            F.when(nation % 5 == 0, nation + 1).otherwise(nation).alias("store_no"),
            (_div(key, 4) % 5 * 5).alias("warehouse_no"),
            F.to_date("o_orderdate").alias("order_day"),
            _plus_seconds(F.col("o_orderdate").cast("timestamp"), key * 53 % 86400).alias("order_dt"),
        )

    @cached_property
    def ordering_store_orders(self) -> DataFrame:
        k = F.col("k")
        approved = k % 9 != 0
        return self._store_orders.select(
            _id("O", "o_orderkey").alias("order_id"),
            _id("L", "store_no").alias("store_location_id"),
            _id("L", "warehouse_no").alias("warehouse_location_id"),
            _id("E", k % self._staff_count).alias("created_by"),
            "order_dt",
            F.date_add("order_day", (k % 5 + 1).cast("int")).alias("requested_delivery_dt"),
            F.when(approved, _id("E", (k + 1) % self._staff_count)).alias("approved_by"),
            F.when(approved, _plus_seconds(F.col("order_dt"), (k % 30 + 1) * 3600)).alias("approved_dt"),
            F.when(k % 17 == 0, "cancelled").otherwise(_pick(ORDER_STATUSES, k)).alias("status"),
            F.lit(None).cast("string").alias("notes"),
        )

    @cached_property
    def ordering_store_order_items(self) -> DataFrame:
        ln = F.col("ln")
        asked = F.col("quantity").cast("int")
        cut = F.when(ln % 3 == 0, asked - 1).otherwise(asked)
        return self._lines.select(
            _id("OI", "line_id").alias("item_id"),
            _id("O", "l_orderkey").alias("order_id"),
            _id("P", "l_partkey").alias("product_id"),
            asked.alias("quantity_requested"),
            F.when((_div(F.col("l_orderkey"), 4) + ln) % 9 != 0, cut).alias("quantity_approved"),
        )

    @cached_property
    def _fulfilments(self) -> DataFrame:
        """One fulfilment for most orders, a second one for every 25th."""
        k, part = F.col("k"), F.col("part")
        parts = self._store_orders.filter(k % 6 != 0).withColumn("part", F.explode(F.array(F.lit(0), F.lit(1))))
        started = _plus_seconds(F.col("order_dt"), (k % 40 + 2 + part * 30) * 3600)
        finished = _plus_seconds(F.col("started_at"), (k % 30 + 1) * 3600 + part * 1800)
        return (
            parts.filter((part == 0) | (k % 25 == 1))
            .withColumn("fulfillment_id", F.concat(_id("F", "o_orderkey"), F.when(part == 1, "b").otherwise("a")))
            .withColumn("started_at", F.when(k % 13 != 0, started))
            .withColumn("completed_at", F.when(k % 7 != 0, finished))
        )

    @cached_property
    def fulfillment_orders(self) -> DataFrame:
        k = F.col("k")
        picker = k % self._staff_count
        status = (
            F.when(k % 17 == 0, "cancelled")
            .when(F.col("completed_at").isNotNull(), "completed")
            .otherwise("in_progress")
        )
        return self._fulfilments.select(
            "fulfillment_id",
            _id("O", "o_orderkey").alias("store_order_id"),
            _id("L", "warehouse_no").alias("warehouse_location_id"),
            _id("E", picker).alias("assigned_to"),
            _id("Picker ", picker).alias("assigned_to_name"),
            status.alias("status"),
            "started_at",
            "completed_at",
            _plus_seconds(F.col("order_dt"), F.lit(1800)).alias("created_at"),
        )

    @cached_property
    def fulfillment_items(self) -> DataFrame:
        k = _div(F.col("l_orderkey"), 4)
        short = (k + F.col("ln")) % 10 == 0
        asked = F.col("quantity").cast("int")
        return self._lines.filter(k % 6 != 0).select(
            _id("FI", "line_id").alias("item_id"),
            F.concat(_id("F", "l_orderkey"), F.lit("a")).alias("fulfillment_id"),
            _id("P", "l_partkey").alias("product_id"),
            asked.alias("quantity_requested"),
            F.when(short, asked - 1).otherwise(asked).alias("quantity_picked"),
            F.when(short, "short").otherwise("picked").alias("pick_status"),
        )

    # ---- transport

    @cached_property
    def transport_trucks(self) -> DataFrame:
        n = F.col("n_nationkey")
        return self._read("nation").select(
            _id("TR", n).alias("truck_id"),
            _id("PLT-", n).alias("license_plate"),
            _id("Make", n % 4).alias("make"),
            _id("Model", n % 6).alias("model"),
            (n % 8 + 2015).cast("int").alias("year"),
            (n % 15 + 10).cast("int").alias("capacity_pallets"),
            F.when(n % 5 == 4, "false").otherwise("true").alias("is_active"),
        )

    @cached_property
    def _shipments(self) -> DataFrame:
        """Completed fulfilments with the load of their completion day and warehouse."""
        day = F.to_date("completed_at")
        return self._fulfilments.filter("completed_at IS NOT NULL").select(
            "fulfillment_id",
            "o_orderkey",
            "warehouse_no",
            day.alias("day"),
            F.datediff(day, F.lit("1995-01-01").cast("date")).cast("bigint").alias("day_no"),
            F.concat(F.lit("LD"), F.date_format(day, "yyyyMMdd"), F.lit("-"), F.col("warehouse_no").cast("string")).alias("load_id"),
        )

    @cached_property
    def transport_loads(self) -> DataFrame:
        loads = self._shipments.select("load_id", "warehouse_no", "day", "day_no").distinct()
        d, w = F.col("day_no"), F.col("warehouse_no")
        truck = (d + w) % 18
        target = (d * 3 + w) % 4 + 1 + d % 5 * 5
        driver = (d * 7 + w) % self._staff_count
        left = F.when((d + w) % 11 != 0, _plus_seconds(F.date_add("day", 1).cast("timestamp"), F.lit(21600)))
        came = F.when((d + w) % 7 != 0, _plus_seconds(F.col("departed_at"), (d * 5 + w) % 60 * 3600 + 10800))
        status = (
            F.when((d + w) % 23 == 0, "cancelled")
            .when((d + w) % 29 == 0, "cancelled_missing_stock")
            .when(F.col("arrived_at").isNotNull(), "delivered")
            .when(F.col("departed_at").isNotNull(), "in_transit")
            .otherwise("scheduled")
        )
        return (
            loads.withColumn("departed_at", left)
            .withColumn("arrived_at", came)
            .select(
                "load_id",
                _id("TR", truck).alias("truck_id"),
                _id("E", driver).alias("driver_id"),
                _id("L", w).alias("warehouse_location_id"),
                _id("L", target).alias("destination_location_id"),
                "departed_at",
                "arrived_at",
                status.alias("status"),
                _id("PLT-", truck).alias("license_plate"),
                _id("Driver ", driver).alias("driver"),
                _id("Warehouse ", w).alias("from_warehouse"),
                _id("Store ", target).alias("to_store"),
            )
        )

    @cached_property
    def transport_load_items(self) -> DataFrame:
        return self._shipments.select(
            _id("LI", "fulfillment_id").alias("item_id"),
            "load_id",
            "fulfillment_id",
            _id("O", "o_orderkey").alias("store_order_id"),
        )

    # ---- stock

    @cached_property
    def inv_products(self) -> DataFrame:
        k = F.col("p_partkey")
        return self._read("part").select(
            _id("IP", k).alias("inv_product_id"),
            _id("P", k).alias("product_id"),
            (k % 20 + 10).cast("int").alias("reorder_point"),
            F.lit(50).alias("reorder_qty"),
            F.lit("each").alias("unit_of_measure"),
            _id("Supplier ", k % 10).alias("supplier_name"),
            (k % 14 + 1).cast("int").alias("lead_time_days"),
        )

    @cached_property
    def inv_stock_levels(self) -> DataFrame:
        k, n = F.col("p_partkey"), F.col("n")
        sites = self._read("part").withColumn("n", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
        counted = F.date_sub(F.lit("2001-08-01").cast("date"), ((k * 11 + n) % 700).cast("int"))
        return sites.select(
            F.concat(F.lit("ST"), F.concat_ws("-", k, n)).alias("stock_id"),
            _id("P", k).alias("product_id"),
            F.concat("p_name", F.lit(" #"), k.cast("string")).alias("product_name"),
            _id("C", F.col("p_size") % 10).alias("category"),
            _id("L", (k * 3 + n * 8) % 25).alias("location_id"),
            ((k * 7 + n) % 60).cast("int").alias("quantity_on_hand"),
            ((k + n) % 5).cast("int").alias("quantity_reserved"),
            (k % 20 + 10).cast("int").alias("reorder_point"),
            F.lit(50).alias("reorder_qty"),
            _plus_seconds(counted.cast("timestamp"), (k + n) % 20 * 3600).alias("last_updated"),
        )

    def _dated(self, lines: DataFrame) -> DataFrame:
        orders = self._read("orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
        site = (F.col("l_partkey") * 3 + F.col("ln") % 3 * 8) % 25
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("site", site)

    def _received(self, lines: DataFrame) -> DataFrame:
        day = F.date_format("day", "yyyyMMdd")
        return (
            self._dated(lines).filter("l_returnflag = 'A'")
            .withColumn("receipt_id", F.concat(F.lit("R"), F.concat_ws("-", day, "site", "l_suppkey")))
            .withColumn("received_dt", _plus_seconds(F.col("day").cast("timestamp"), F.lit(32400)))
            .withColumn("line_total", (F.col("quantity") * F.col("unit_cost")).cast(MONEY))
        )

    @cached_property
    def inv_receipts(self) -> DataFrame:
        return (
            self._received(self._amounts).groupBy("receipt_id", "site", "l_suppkey", "received_dt")
            .agg(F.sum("line_total").cast(MONEY).alias("total_cost"), F.count("*").cast("int").alias("line_items"))
            .select(
                "receipt_id",
                _id("L", "site").alias("location_id"),
                "received_dt",
                _id("Supplier ", F.col("l_suppkey") % 10).alias("supplier_name"),
                F.concat(F.lit("PO-"), F.col("receipt_id")).alias("po_number"),
                "total_cost",
                "line_items",
            )
        )

    @cached_property
    def inv_receipt_items(self) -> DataFrame:
        return self._received(self._lines).select(
            _id("RI", "line_id").alias("receipt_item_id"),
            "receipt_id",
            _id("P", "l_partkey").alias("product_id"),
            _id("Item ", "l_partkey").alias("product_name"),
            _id("C", F.col("l_partkey") % 10).alias("category"),
            "quantity",
            "unit_cost",
            "line_total",
            "received_dt",
        )

    @cached_property
    def inv_shrinkage_events(self) -> DataFrame:
        key = F.col("l_orderkey") + F.col("ln")
        store = F.when(F.col("site") % 5 == 0, F.col("site") + 1).otherwise(F.col("site"))
        lost = (F.col("quantity").cast("int") % 5 + 1).cast(MONEY)
        return (
            self._dated(self._lines).filter("l_returnflag = 'R'")
            .select(
                _id("SH", "line_id").alias("shrinkage_id"),
                _id("P", "l_partkey").alias("product_id"),
                _id("L", store).alias("location_id"),
                _plus_seconds(F.col("day").cast("timestamp"), F.lit(72000)).alias("recorded_at"),
                _pick(SHRINK_REASONS, _div(key, 5)).alias("reason"),
                lost.alias("quantity"),
                (lost * F.col("unit_cost")).cast(MONEY).alias("estimated_cost"),
            )
        )

    # ---- pricing

    @cached_property
    def _ad_weeks(self) -> DataFrame:
        weeks = self._read("orders").select(week_start(F.to_date("o_orderdate")).alias("week")).distinct()
        number = F.datediff("week", F.lit(AD_EPOCH).cast("date")) / 7
        return weeks.select(
            "week", F.floor(number).alias("w"), F.concat(F.lit("AD"), F.date_format("week", "yyyyMMdd")).alias("ad_id")
        )

    @cached_property
    def pricing_weekly_ads(self) -> DataFrame:
        return self._ad_weeks.select(
            "ad_id",
            F.concat(F.lit("Week of "), F.date_format("week", "yyyy-MM-dd")).alias("ad_name"),
            F.col("week").alias("start_date"),
            F.date_add("week", 6).alias("end_date"),
            F.date_sub("week", 3).cast("timestamp").alias("created_at"),
        )

    @cached_property
    def pricing_ad_items(self) -> DataFrame:
        k, w = F.col("p_partkey"), F.col("w")
        off = (k + w) % 21 + 10
        factor = ((F.lit(100) - off) / F.lit(100.0)).cast("decimal(6,2)")
        parts = self._read("part").select("p_partkey", "p_retailprice")
        return parts.join(self._ad_weeks, k % 20 == F.pmod(w, F.lit(20))).select(
            F.concat(F.lit("AI"), F.concat_ws("-", "ad_id", k)).alias("ad_item_id"),
            "ad_id",
            _id("P", k).alias("product_id"),
            F.round(money("p_retailprice") * factor, 2).cast(MONEY).alias("promoted_price"),
            off.cast("int").alias("discount_pct"),
            F.date_sub("week", 3).cast("timestamp").alias("created_at"),
        )
