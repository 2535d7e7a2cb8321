"""Revenue, basket and product marts, and the calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.functions import LINE, divide, lookup, mean, percent, ratio
from tillhouse.plans.registry import Params, model

# extract(dow) numbering.
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]


@model("M-06", "stg_pos_transactions", "stg_locations")
def mart_daily_revenue(p: Params, transactions: DataFrame, locations: DataFrame) -> DataFrame:
    daily = transactions.groupBy("transaction_date", "location_id").agg(
        F.count("*").alias("pos_transaction_count"),
        F.sum("total").alias("pos_revenue"),
        mean("total").alias("pos_avg_transaction"),
        F.count_if("has_loyalty_member").alias("loyalty_transactions"),
        F.sum("coupon_savings").alias("coupon_savings_total"),
        F.sum("deal_savings").alias("deal_savings_total"),
    )
    named = lookup(
        daily, locations, "location_id", location_name="location_name", city="city", state="state", location_type="location_type"
    )
    return named.select(
        "transaction_date",
        "location_id",
        "location_name",
        "city",
        "state",
        "location_type",
        "pos_transaction_count",
        "pos_revenue",
        "pos_avg_transaction",
        "loyalty_transactions",
        "coupon_savings_total",
        "deal_savings_total",
        (F.col("coupon_savings_total") + F.col("deal_savings_total")).alias("total_discount_savings"),
        F.col("pos_revenue").alias("total_revenue"),
    )


@model("M-24", "mart_daily_revenue")
def mart_location_performance(p: Params, daily: DataFrame) -> DataFrame:
    place = ["location_id", "location_name", "city", "state", "location_type"]
    sums = daily.groupBy(*place).agg(
        F.min("transaction_date").alias("first_sale_date"),
        F.max("transaction_date").alias("last_sale_date"),
        F.count_distinct("transaction_date").alias("days_with_sales"),
        F.sum("pos_transaction_count").alias("total_pos_transactions"),
        F.sum("pos_revenue").alias("total_pos_revenue"),
        F.sum("loyalty_transactions").alias("total_loyalty_transactions"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("coupon_savings_total").alias("total_coupon_savings"),
        F.sum("deal_savings_total").alias("total_deal_savings"),
    )
    return sums.select(
        *place,
        "first_sale_date",
        "last_sale_date",
        "days_with_sales",
        "total_pos_transactions",
        "total_pos_revenue",
        "total_loyalty_transactions",
        "total_revenue",
        ratio("total_revenue", "days_with_sales", 2).alias("avg_daily_revenue"),
        percent("total_loyalty_transactions", "total_pos_transactions", 1).alias("loyalty_attach_rate_pct"),
        "total_coupon_savings",
        "total_deal_savings",
    )


@model("M-18", "stg_pos_transactions", "stg_locations")
def mart_hourly_sales_pattern(p: Params, transactions: DataFrame, locations: DataFrame) -> DataFrame:
    """Days are pre-aggregated, so counting active days needs no distinct over receipts."""
    slot = ["hour_of_day", "day_of_week", "location_id"]
    hourly = (
        transactions.groupBy(*slot, "transaction_date")
        .agg(F.count("transaction_id").alias("_n"), F.sum("total").alias("_total"), F.count("total").alias("_priced"))
        .groupBy(*slot)
        .agg(
            F.sum("_n").alias("transaction_count"),
            F.count("transaction_date").alias("days_active"),
            F.sum("_total").alias("total_revenue"),
            F.sum("_priced").alias("_priced"),
        )
    )
    place = locations.select(F.col("location_id").alias("_site"), "location_name", "city", "state")
    revenue = F.col("total_revenue")
    store = Window.partitionBy("location_id")
    day_name = F.coalesce(*[F.when(F.col("day_of_week") == i, name) for i, name in enumerate(DAY_NAMES)])
    return hourly.join(place, F.col("location_id") == F.col("_site")).select(
        "hour_of_day",
        "day_of_week",
        day_name.alias("day_name"),
        "location_id",
        "location_name",
        "city",
        "state",
        "transaction_count",
        "days_active",
        "total_revenue",
        divide(revenue, "_priced").alias("avg_transaction_value"),
        divide(revenue, "days_active").alias("avg_daily_revenue_at_hour"),
        percent(revenue, F.sum(revenue).over(store), 2).alias("pct_of_store_revenue"),
        F.rank().over(store.orderBy(revenue.desc())).alias("revenue_rank"),
        F.lit(p.as_of).alias("as_of_date"),
    )


def sold_by(items: DataFrame, transactions: DataFrame, key: str, **sums: Column) -> DataFrame:
    """Line sums per (day, store, key) with the number of distinct receipts.

    Lines are first summed per receipt and key. That level is partitioned by transaction_id like
    the join before it, so receipts are counted with one shuffle of already reduced rows.
    """
    receipts = transactions.select(F.col("transaction_id").alias("_txn"), "transaction_date", "location_id")
    joined = items.drop("location_id").join(receipts, F.col("transaction_id") == F.col("_txn"))
    per_receipt = joined.groupBy("transaction_id", "transaction_date", "location_id", key).agg(
        *[F.sum(value).alias(name) for name, value in sums.items()]
    )
    return per_receipt.groupBy("transaction_date", "location_id", key).agg(
        F.count("transaction_id").alias("transaction_count"), *[F.sum(name).alias(name) for name in sums]
    )


def _gross() -> Column:
    return (F.col("quantity") * F.col("unit_price")).cast(LINE)


@model("M-09", "stg_pos_transaction_items", "stg_pos_transactions", "stg_pos_departments", "stg_locations")
def mart_department_performance(
    p: Params, items: DataFrame, transactions: DataFrame, departments: DataFrame, locations: DataFrame
) -> DataFrame:
    """Basket size uses gross revenue; discounts are per-unit amounts summed without quantity."""
    sums = sold_by(
        items,
        transactions,
        "department_id",
        units_sold=F.col("quantity"),
        gross_revenue=_gross(),
        total_discounts=F.col("discount"),
        net_revenue=F.col("line_total"),
    )
    named = lookup(sums, locations, "location_id", location_name="location_name")
    named = lookup(named, departments, "department_id", department_name="department_name")
    return named.select(
        "transaction_date",
        "location_id",
        "location_name",
        "department_id",
        "department_name",
        "transaction_count",
        "units_sold",
        "gross_revenue",
        "total_discounts",
        "net_revenue",
        ratio("gross_revenue", "transaction_count", 2).alias("avg_basket_size"),
    )


@model("M-03", "int_pos_sales_enriched")
def mart_category_sales_performance(p: Params, sales: DataFrame) -> DataFrame:
    """Basket size uses net revenue. Receipts are counted as in `sold_by`."""
    day = ["transaction_date", "location_id", "category"]
    sums = (
        sales.groupBy("transaction_id", *day)
        .agg(F.sum("line_total").alias("line_total"), F.sum("quantity").alias("quantity"))
        .groupBy(*day)
        .agg(
            F.sum("line_total").alias("category_revenue"),
            F.sum("quantity").alias("category_units"),
            F.count("transaction_id").alias("transaction_count"),
        )
    )
    return sums.select("*", ratio("category_revenue", "transaction_count", 2).alias("avg_basket_size"))


@model(
    "M-30",
    "stg_pos_transaction_items",
    "stg_pos_transactions",
    "stg_pos_products",
    "stg_pos_departments",
    "stg_locations",
)
def mart_product_performance(
    p: Params,
    items: DataFrame,
    transactions: DataFrame,
    products: DataFrame,
    departments: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Product attributes depend on product_id alone, so they are joined after the aggregation."""
    sums = sold_by(
        items,
        transactions,
        "product_id",
        units_sold=F.col("quantity"),
        gross_revenue=_gross(),
        total_discounts=F.col("discount"),
        net_revenue=F.col("line_total"),
    )
    named = lookup(
        sums, products, "product_id",
        product_name="product_name", _department="department_id", category="category",
        subcategory="subcategory", _unit_cost="unit_cost",
    )
    named = lookup(named, departments, "_department", "department_id", department_name="department_name")
    named = lookup(named, locations, "location_id", location_name="location_name")
    cost = (F.col("units_sold").cast("decimal(18,4)") * F.col("_unit_cost")).cast("decimal(28,6)")
    profit = (F.col("net_revenue") - F.col("total_cost")).cast("decimal(28,6)")
    return named.withColumn("total_cost", cost).select(
        "transaction_date",
        "location_id",
        "location_name",
        "product_id",
        "product_name",
        "department_name",
        "category",
        "subcategory",
        "units_sold",
        "gross_revenue",
        "total_discounts",
        "net_revenue",
        "transaction_count",
        "total_cost",
        profit.alias("gross_profit"),
        percent(profit, "net_revenue", 2).alias("margin_pct"),
    )


# ---- calendar


def time_spine(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return days_between(bounds)


def days_between(bounds: DataFrame) -> DataFrame:
    """Expand rows of (first, last) into days."""
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date_day"))


def default_spine(spark: SparkSession, p: Params) -> DataFrame:
    end = p.as_of.replace(year=p.as_of.year + p.spine_years_ahead)
    return time_spine(spark, min(p.spine_start, end), end)
