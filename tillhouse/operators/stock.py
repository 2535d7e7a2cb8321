"""Stock, shrinkage and weekly store marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.functions import divide, lookup, percent, rounded, week_start
from tillhouse.plans.day_tables import on_range
from tillhouse.plans.registry import Params, model

CENTS = "decimal(18,2)"


def _received(items: DataFrame, receipts: DataFrame) -> DataFrame:
    head = receipts.select("receipt_id", "location_id", "received_dt")
    return items.select("receipt_id", "product_id", "quantity").join(head, "receipt_id")


@model("M-19", "stg_inv_stock_levels", "stg_locations", "stg_inv_receipt_items", "stg_inv_receipts")
def mart_inventory_summary(
    p: Params, stock: DataFrame, locations: DataFrame, receipt_items: DataFrame, receipts: DataFrame
) -> DataFrame:
    last = (
        _received(receipt_items, receipts)
        .groupBy("product_id", "location_id")
        .agg(F.max("received_dt").alias("last_receipt_dt"), F.sum("quantity").alias("total_units_received"))
    )
    named = lookup(stock, locations, "location_id", location_name="location_name", city="city", state="state")
    status = (
        F.when(F.col("quantity_on_hand") == 0, "OUT_OF_STOCK").when(F.col("is_below_reorder"), "REORDER").otherwise("OK")
    )
    return named.join(last, ["product_id", "location_id"], "left").select(
        "stock_id",
        "product_id",
        "sku",
        "product_name",
        "category",
        "location_id",
        "location_name",
        "city",
        "state",
        "quantity_on_hand",
        "quantity_reserved",
        "quantity_available",
        "reorder_point",
        "reorder_qty",
        "supplier_name",
        "is_below_reorder",
        status.alias("stock_status"),
        "last_receipt_dt",
        "total_units_received",
        "last_updated",
    )


@model(
    "M-20",
    "stg_inv_stock_levels",
    "stg_locations",
    "stg_inv_receipt_items",
    "stg_inv_receipts",
    "stg_pos_transaction_items",
    "stg_pos_products",
)
def mart_inventory_turnover(
    p: Params,
    stock: DataFrame,
    locations: DataFrame,
    receipt_items: DataFrame,
    receipts: DataFrame,
    items: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """Stock against 30 days of sales and 60 days of receipts before `as_of`."""
    as_of = F.lit(p.as_of).cast("timestamp")
    site = ["product_id", "location_id"]
    recent = F.col("received_dt") >= as_of - F.expr("interval 60 days")
    received = (
        _received(receipt_items, receipts)
        .groupBy(*site, "receipt_id", "received_dt")
        .agg(F.sum("quantity").alias("quantity"))
        .groupBy(*site)
        .agg(
            F.max("received_dt").alias("last_receipt_dt"),
            F.sum(F.when(recent, F.col("quantity"))).alias("_received"),
            F.count_if(recent).alias("_receipts"),
        )
    )
    sold = (
        on_range(items, "transaction_dt", start=as_of - F.expr("interval 30 days"))
        .groupBy(*site, F.to_date("transaction_dt").alias("_day"))
        .agg(F.sum("quantity").alias("quantity"))
        .groupBy(*site)
        .agg(F.sum("quantity").alias("_sold"), F.count("_day").alias("_days"))
    )
    stores = locations.filter("location_type = 'store'").select("location_id", "location_name", "city", "state")
    joined = lookup(
        stock.join(stores, "location_id").join(received, site, "left").join(sold, site, "left"),
        products, "product_id", unit_cost="unit_cost", unit_price="unit_price", margin_pct="margin_pct",
    )
    on_hand, units = F.col("quantity_on_hand"), F.col("units_sold_30d")
    daily = F.greatest(units.cast("double") / 30.0, F.lit(0.01))
    idle = (F.unix_micros(F.lit(p.moment).cast("timestamp")) - F.unix_micros("last_receipt_dt")) / F.lit(8.64e10)
    margin = F.coalesce("unit_price", F.lit(0)) - F.coalesce("unit_cost", F.lit(0))
    category = (
        F.when(on_hand == 0, "OUT_OF_STOCK")
        .when((units == 0) & (on_hand > 0), "DEAD_STOCK")
        .when((on_hand > units * 2) & (units > 0), "OVERSTOCKED")
        .when(F.col("is_below_reorder"), "REORDER_NEEDED")
        .when(F.col("last_receipt_dt").isNull() & (on_hand > 0), "NO_RECEIPT_HISTORY")
        .otherwise("HEALTHY")
    )
    return joined.withColumn("units_sold_30d", F.coalesce("_sold", F.lit(0)).cast("decimal(18,4)")).select(
        "product_id",
        "location_id",
        "location_name",
        "city",
        "state",
        "quantity_on_hand",
        "quantity_available",
        "reorder_point",
        "is_below_reorder",
        "last_receipt_dt",
        idle.cast("int").alias("days_since_last_receipt"),
        "units_sold_30d",
        F.coalesce("_days", F.lit(0)).alias("days_with_sales_30d"),
        F.coalesce("_received", F.lit(0)).cast("decimal(18,4)").alias("total_units_received_60d"),
        F.coalesce("_receipts", F.lit(0)).alias("receipt_count_60d"),
        "unit_cost",
        "unit_price",
        "margin_pct",
        (units * margin).cast("decimal(28,6)").alias("gross_margin_proxy"),
        daily.alias("daily_sell_rate"),
        F.when(on_hand > 0, rounded(on_hand / daily, 1)).alias("days_of_supply"),
        F.when((on_hand > 0) & (units > 0), rounded(divide(units.cast("double") * 12, on_hand), 1))
        .otherwise(F.lit(0))
        .alias("estimated_annual_turnover"),
        category.alias("stock_aging_category"),
        "last_updated",
    )


@model("M-21", "stg_inv_stock_levels", "stg_pos_products", "stg_locations")
def mart_inventory_valuation(p: Params, stock: DataFrame, products: DataFrame, locations: DataFrame) -> DataFrame:
    priced = lookup(
        stock, products, "product_id",
        department_id="department_id", department_name="department_name", _cost="unit_cost",
    )
    cost = F.coalesce("_cost", F.lit(0))
    sums = priced.groupBy("location_id", "department_id", "department_name").agg(
        F.sum("quantity_on_hand").alias("units_on_hand"),
        F.sum("quantity_available").alias("units_available"),
        F.sum(F.col("quantity_on_hand") * cost).cast(CENTS).alias("value_on_hand_cost"),
        F.sum(F.col("quantity_available") * cost).cast(CENTS).alias("value_available_cost"),
    )
    named = lookup(sums, locations, "location_id", location_name="location_name", location_type="location_type")
    return named.select(
        "location_id",
        "location_name",
        "location_type",
        "department_id",
        "department_name",
        "units_on_hand",
        "units_available",
        "value_on_hand_cost",
        "value_available_cost",
        F.lit(p.as_of).alias("as_of_date"),
    )


# ---- shrinkage


@model("M-35", "stg_inv_shrinkage_events", "stg_pos_products", "stg_locations")
def mart_shrink_analysis(p: Params, shrinkage: DataFrame, products: DataFrame, locations: DataFrame) -> DataFrame:
    sums = shrinkage.groupBy("event_date", "location_id", "product_id", "shrinkage_type").agg(
        F.count("*").alias("event_count"),
        F.sum("quantity_lost").alias("total_quantity_lost"),
        F.sum("estimated_value_lost").cast(CENTS).alias("total_value_lost"),
    )
    named = lookup(sums, locations, "location_id", location_name="location_name", city="city", state="state")
    named = lookup(named, products, "product_id", product_name="product_name", sku="sku", category="category")
    return named.select(
        "event_date",
        "location_id",
        "location_name",
        "city",
        "state",
        "product_id",
        "product_name",
        "sku",
        "category",
        "shrinkage_type",
        "event_count",
        "total_quantity_lost",
        "total_value_lost",
    )


@model("M-36", "int_shrinkage_attributed")
def mart_shrinkage_analysis(p: Params, attributed: DataFrame) -> DataFrame:
    grain = [
        "event_date",
        "location_id",
        "location_name",
        "location_type",
        "department_id",
        "department_name",
        "category",
        "shrinkage_type",
    ]
    sums = attributed.groupBy(*grain).agg(
        F.count("*").alias("event_count"),
        F.sum("quantity_lost").alias("total_quantity_lost"),
        F.sum("estimated_value_lost").alias("total_value_lost"),
    )
    department = F.sum("total_value_lost").over(Window.partitionBy("event_date", "location_id", "department_id"))
    return (
        sums.withColumn("_department", department)
        .select(
            "*",
            F.col("_department").cast(CENTS).alias("dept_value_lost"),
            F.when(F.col("_department") > 0, percent("total_value_lost", "_department", 2))
            .otherwise(F.lit(0))
            .alias("pct_of_dept_value_lost"),
        )
        .drop("_department")
    )


@model(
    "M-10",
    "mart_department_performance",
    "stg_inv_shrinkage_events",
    "stg_pos_transaction_items",
    "stg_locations",
    "stg_pos_departments",
)
def mart_department_shrinkage(
    p: Params,
    revenue: DataFrame,
    shrinkage: DataFrame,
    items: DataFrame,
    locations: DataFrame,
    departments: DataFrame,
) -> DataFrame:
    """Shrink finds its department through the sold lines. Each cause is summed and rounded to cents first."""
    sold_in = items.select(F.col("product_id").alias("_product"), F.col("department_id").alias("_dept")).distinct()
    by_product = shrinkage.groupBy("event_date", "location_id", "product_id", "shrinkage_type").agg(
        F.count("*").alias("events"),
        F.sum("quantity_lost").alias("qty"),
        F.sum("estimated_value_lost").alias("value"),
    )
    by_cause = (
        by_product.join(sold_in, F.col("product_id") == F.col("_product"), "left")
        .groupBy("event_date", "location_id", "_dept", "shrinkage_type")
        .agg(F.sum("events").alias("events"), F.sum("qty").alias("qty"), F.sum("value").cast(CENTS).alias("value"))
    )
    causes = {c: F.sum(F.when(F.col("shrinkage_type") == c, F.col("value"))) for c in ("expired", "spoilage", "damaged", "theft")}
    lost = by_cause.groupBy(
        F.col("event_date").alias("_day"), F.col("location_id").alias("_site"), F.col("_dept")
    ).agg(
        F.sum("events").alias("_events"),
        F.sum("qty").alias("_qty"),
        F.sum("value").alias("_value"),
        *[total.alias(f"_{cause}") for cause, total in causes.items()],
    )
    same = (
        (F.col("_day") == F.col("transaction_date"))
        & (F.col("_site") == F.col("location_id"))
        & (F.col("_dept") == F.col("department_id"))
    )
    both = (
        revenue.join(lost, same, "full")
        .withColumns(
            {
                "report_date": F.coalesce("transaction_date", "_day"),
                "location_id": F.coalesce("location_id", "_site"),
                "department_id": F.coalesce("department_id", "_dept"),
            }
        )
        .withColumnsRenamed({"location_name": "_r_location", "department_name": "_r_department"})
    )
    both = lookup(both, locations, "location_id", _l_location="location_name")
    both = lookup(both, departments, "department_id", _d_department="department_name")
    zero = F.lit(0)
    return both.select(
        "report_date",
        "location_id",
        F.coalesce("_r_location", "_l_location").alias("location_name"),
        "department_id",
        F.coalesce("_r_department", "_d_department").alias("department_name"),
        F.coalesce("net_revenue", zero).cast(CENTS).alias("net_revenue"),
        F.coalesce("units_sold", zero).cast("decimal(28,4)").alias("units_sold"),
        F.coalesce("_events", zero).alias("shrink_event_count"),
        F.coalesce("_qty", zero).cast("decimal(28,4)").alias("total_qty_lost"),
        F.coalesce("_value", zero).cast(CENTS).alias("total_value_lost"),
        *[F.coalesce(f"_{cause}", zero).cast(CENTS).alias(f"{cause}_value_lost") for cause in causes],
        F.when(F.col("net_revenue") > 0, percent("_value", "net_revenue", 3)).alias("shrink_pct_of_revenue"),
    )


# ---- store week


@model(
    "M-37",
    "stg_pos_transactions",
    "stg_locations",
    "stg_inv_shrinkage_events",
    "stg_inv_stock_levels",
    "stg_ordering_store_orders",
    "mart_department_labor",
)
def mart_store_weekly_summary(
    p: Params,
    transactions: DataFrame,
    locations: DataFrame,
    shrinkage: DataFrame,
    stock: DataFrame,
    orders: DataFrame,
    labor: DataFrame,
) -> DataFrame:
    """Every store in every week that has sales anywhere.

    The week list is a bounded calendar array read as a scalar subquery and exploded per store. Stock
    known by the end of a week is a running sum over weekly counts instead of an inequality join.
    """
    key = ["week_start", "location_id"]
    by_day = transactions.groupBy("transaction_date", "location_id", "member_id").agg(
        F.count("transaction_id").alias("n"), F.sum("total").alias("total"), F.count("total").alias("priced")
    )
    week_of_sale = week_start("transaction_date").alias("week_start")
    sales = by_day.groupBy(week_of_sale, "location_id").agg(
        F.sum("n").alias("_txns"),
        F.sum("total").alias("_revenue"),
        divide(F.sum("total"), F.sum("priced")).alias("_avg"),
        F.count_distinct("transaction_date").alias("_days"),
        F.count_distinct("member_id").alias("_members"),
    )
    weeks = transactions.select(week_of_sale).agg(F.collect_set("week_start")).scalar()
    stores = locations.filter("location_type = 'store'").select("location_id", "location_name", "city", "state")
    grid = stores.withColumn("week_start", F.explode(weeks))

    lost = shrinkage.groupBy(week_start("event_date").alias("week_start"), "location_id").agg(
        F.count("*").alias("_events"),
        F.sum("quantity_lost").alias("_qty"),
        F.sum("estimated_value_lost").alias("_value"),
    )

    # A count taken at t is visible in the first week w with t <= w + 7 days.
    first_week = F.trunc(F.col("last_updated") - F.expr("interval 1 microsecond"), "week")
    counted = stock.groupBy(first_week.alias("week_start"), "location_id").agg(
        F.count_if("is_below_reorder").alias("below"), F.count_if(F.col("quantity_on_hand") == 0).alias("out")
    )
    so_far = Window.partitionBy("location_id").orderBy("week_start").rangeBetween(Window.unboundedPreceding, 0)
    on_shelf = (
        counted.withColumn("in_grid", F.lit(False))
        .unionByName(
            grid.select(*key, F.lit(0).cast("bigint").alias("below"), F.lit(0).cast("bigint").alias("out"), F.lit(True).alias("in_grid"))
        )
        .select(*key, "in_grid", F.sum("below").over(so_far).alias("_below"), F.sum("out").over(so_far).alias("_out"))
        .filter("in_grid")
    )

    placed = orders.groupBy(
        week_start("order_date").alias("week_start"), F.col("store_location_id").alias("location_id")
    ).agg(F.count("*").alias("_placed"), F.count_if(F.col("status") == "delivered").alias("_delivered"))
    worked = labor.groupBy(week_start("report_date").alias("week_start"), "location_id").agg(
        F.sum("actual_hours").alias("_hours"), F.sum("actual_cost").alias("_cost")
    )

    joined = grid
    for part in (sales, lost, on_shelf, placed, worked):
        joined = joined.join(part, key, "left")

    def zero(name: str, kind: str = "bigint"):
        return F.coalesce(F.col(name), F.lit(0)).cast(kind)

    revenue, cost, value = zero("_revenue", "decimal(28,4)"), zero("_cost", CENTS), zero("_value", "decimal(28,4)")
    return joined.select(
        "week_start",
        "location_id",
        "location_name",
        "city",
        "state",
        zero("_txns").alias("transaction_count"),
        revenue.alias("total_revenue"),
        F.coalesce("_avg", F.lit(0.0)).alias("avg_transaction_value"),
        zero("_days").alias("days_with_sales"),
        zero("_members").alias("loyalty_transaction_count"),
        zero("_events").alias("shrink_event_count"),
        zero("_qty", "decimal(28,4)").alias("shrink_qty_lost"),
        value.alias("shrink_value_lost"),
        zero("_below").alias("below_reorder_count"),
        zero("_out").alias("out_of_stock_count"),
        zero("_placed").alias("orders_placed"),
        zero("_delivered").alias("orders_delivered"),
        zero("_hours", CENTS).alias("total_labor_hours"),
        cost.alias("total_labor_cost"),
        F.when(cost > 0, percent(cost, revenue, 2)).alias("labor_cost_pct_of_revenue"),
        F.when(revenue > 0, percent(value, revenue, 2)).alias("shrink_pct_of_revenue"),
    )
