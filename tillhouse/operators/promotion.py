"""Promotion lift, redemption and price elasticity marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.functions import divide, lookup, percent, ratio, rounded
from tillhouse.plans.registry import Params, model

CENTS = "decimal(18,2)"


@model(
    "M-32",
    "stg_pricing_weekly_ads",
    "stg_pricing_ad_items",
    "stg_pos_transaction_items",
    "stg_pos_transactions",
    "stg_pos_products",
)
def mart_promotion_effectiveness(
    p: Params,
    ads: DataFrame,
    ad_items: DataFrame,
    items: DataFrame,
    transactions: DataFrame,
    products: DataFrame,
) -> DataFrame:
    """Sales of every product in every ad week, against the product's mean off-ad week.

    Sales are summed per day and product first. Each range of ad dates, however many ads share it, is expanded to its
    days once, which turns the date-range join into an equi join. A product's days of sale in a range are then rows to
    count, and ads meet their range's sums.

    A product's days and offers are dealt by the product once. Ranges, offers, weeks and the baseline of a product are then
    found where its rows lie, without another exchange.
    """
    receipts = transactions.select(F.col("transaction_id").alias("_txn"), F.col("transaction_date").alias("sale_date"))
    daily = (
        items.select("transaction_id", "product_id", "quantity", "unit_price", "line_total")
        .join(receipts, F.col("transaction_id") == F.col("_txn"))
        .groupBy("sale_date", "product_id")
        .agg(
            F.sum("quantity").alias("units"),
            F.sum("line_total").alias("revenue"),
            F.sum("unit_price").alias("prices"),
            F.count("unit_price").alias("priced"),
        )
    )
    span = ["ad_week_start", "ad_week_end"]
    dated = ads.filter("start_date <= end_date").select(
        F.col("ad_id").alias("_ad"), "ad_name", F.col("start_date").alias(span[0]), F.col("end_date").alias(span[1])
    )
    days = dated.select(*span).distinct().withColumn("_day", F.explode(F.sequence(*span)))
    in_span = daily.join(days, F.col("sale_date") == F.col("_day")).select(*span, "product_id", "units", "revenue", "prices", "priced")
    # An offer comes once for each range of its ad, beside the days of sale.
    ranged = dated.select("_ad", *span).distinct()
    offer = F.struct("_ad", "ad_item_id", "discount_pct", "promoted_price")
    offers = (
        ad_items.select(F.col("ad_id").alias("_offer_ad"), "product_id", "ad_item_id", "discount_pct", "promoted_price")
        .filter("product_id IS NOT NULL")
        .join(ranged, F.col("_offer_ad") == F.col("_ad"))
        .select(*span, "product_id", offer.alias("_offer"))
    )
    per_span = (
        in_span.withColumn("_day_of_sale", F.lit(True)).unionByName(offers, allowMissingColumns=True)
        .repartition("product_id")
        .groupBy(*span, "product_id")
        .agg(
            F.count("_day_of_sale").alias("days"),
            F.sum("units").alias("units"),
            F.sum("revenue").alias("revenue"),
            F.sum("prices").alias("prices"),
            F.sum("priced").alias("priced"),
            F.collect_list("_offer").alias("_offers"),
        )
        .filter("days > 0")
    )
    own = F.filter("_offers", lambda offer: offer["_ad"] == F.col("_ad"))
    met = per_span.join(dated.withColumnsRenamed({c: f"_{c}" for c in span}), (F.col("_ad_week_start") == F.col(span[0])) & (F.col("_ad_week_end") == F.col(span[1])))
    weekly = (
        met.withColumn("_offer", F.explode_outer(own))
        .select("*", "_offer.discount_pct", "_offer.promoted_price", F.col("_offer.ad_item_id").isNotNull().alias("is_ad_item"))
        .groupBy("ad_week_start", "ad_week_end", "ad_name", "product_id", "is_ad_item", "discount_pct", "promoted_price")
        .agg(
            F.max("days").alias("days_active"),
            F.sum("units").alias("total_units_sold"),
            F.sum("revenue").cast(CENTS).alias("total_revenue"),
            rounded(divide(F.sum("prices"), F.sum("priced")), 2).cast(CENTS).alias("avg_unit_price"),
        )
    )
    off_ad = F.when(~F.col("is_ad_item") & (F.col("total_units_sold") != 0), F.col("total_units_sold"))
    same_product = Window.partitionBy("product_id")
    baseline = divide(F.sum(off_ad).over(same_product), F.count(off_ad).over(same_product))
    based = lookup(
        weekly.withColumn("_base", baseline), products, "product_id", product_name="product_name", category="category"
    )
    lift = percent(F.col("total_units_sold").cast("double") - F.col("_base"), "_base", 2)
    return based.select(
        "ad_week_start",
        "ad_week_end",
        "ad_name",
        "product_id",
        "product_name",
        "category",
        "is_ad_item",
        "discount_pct",
        "promoted_price",
        "days_active",
        "total_units_sold",
        "total_revenue",
        "avg_unit_price",
        F.coalesce(lift, F.lit(0)).alias("promo_lift_vs_baseline_pct"),
    )


@model(
    "M-33",
    "stg_pos_coupons",
    "stg_pos_combo_deals",
    "stg_pos_transaction_items",
    "stg_pos_transactions",
)
def mart_promotion_redemption(
    p: Params, coupons: DataFrame, deals: DataFrame, items: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Coupons and deals with their attributed lines and the totals of their kind."""
    totals = transactions.agg(
        F.struct(
            F.count_if("has_coupon").alias("coupon_txns"),
            F.coalesce(F.sum("coupon_savings"), F.lit(0)).cast("decimal(28,4)").alias("coupon_savings"),
            F.count_if("has_deal").alias("deal_txns"),
            F.coalesce(F.sum("deal_savings"), F.lit(0)).cast("decimal(28,4)").alias("deal_savings"),
        )
    ).scalar()

    def attributed(key: str) -> DataFrame:
        return (
            items.filter(F.col(key).isNotNull())
            .groupBy(F.col(key).alias("_promo"), "transaction_id")
            .agg(F.count("item_id").alias("lines"), F.sum("line_total").alias("total"))
            .groupBy("_promo")
            .agg(F.count("transaction_id").alias("_txns"), F.sum("lines").alias("_lines"), F.sum("total").alias("_total"))
        )

    def rows(catalogue: DataFrame, key: str, kind: str, **columns) -> DataFrame:
        joined = catalogue.join(attributed(key), F.col(key) == F.col("_promo"), "left")
        return joined.withColumn("_totals", totals).select(
            F.lit(kind).alias("promotion_type"),
            F.col(key).alias("promotion_id"),
            columns["promotion_name"].alias("promotion_name"),
            "description",
            columns["promotion_detail"].alias("promotion_detail"),
            columns["department_name"].alias("department_name"),
            columns.get("uses_count", F.lit(None)).cast("int").alias("uses_count"),
            columns.get("max_uses", F.lit(None)).cast("int").alias("max_uses"),
            columns.get("redemption_rate_pct", F.lit(None)).cast("decimal(28,2)").alias("redemption_rate_pct"),
            F.coalesce("_txns", F.lit(0)).alias("attributed_txn_count"),
            F.coalesce("_lines", F.lit(0)).alias("attributed_item_count"),
            F.coalesce("_total", F.lit(0)).cast("decimal(28,6)").alias("attributed_item_total"),
            "valid_from",
            "valid_until",
            columns.get("is_active", F.lit(True)).alias("is_active"),
            columns.get("coupon_txn_count", F.lit(None)).cast("bigint").alias("coupon_txn_count"),
            columns.get("coupon_total_savings", F.lit(None)).cast("decimal(28,4)").alias("coupon_total_savings"),
            columns.get("combo_txn_count", F.lit(None)).cast("bigint").alias("combo_txn_count"),
            columns.get("combo_total_savings", F.lit(None)).cast("decimal(28,4)").alias("combo_total_savings"),
        )

    total = F.col("_totals")
    coupon_rows = rows(
        coupons,
        "coupon_id",
        "coupon",
        promotion_name=F.col("code"),
        promotion_detail=F.col("coupon_type"),
        department_name=F.col("department_name"),
        uses_count=F.col("uses_count"),
        max_uses=F.col("max_uses"),
        redemption_rate_pct=F.when(F.col("max_uses") > 0, percent("uses_count", "max_uses", 2)),
        is_active=F.col("is_active"),
        coupon_txn_count=total["coupon_txns"],
        coupon_total_savings=total["coupon_savings"],
    )
    deal_rows = rows(
        deals,
        "deal_id",
        "combo_deal",
        promotion_name=F.col("deal_name"),
        promotion_detail=F.col("deal_type"),
        department_name=F.col("trigger_department_name"),
        combo_txn_count=total["deal_txns"],
        combo_total_savings=total["deal_savings"],
    )
    return coupon_rows.unionByName(deal_rows)


@model("M-31", "stg_pos_price_history", "int_pos_sales_enriched")
def mart_product_price_elasticity(p: Params, history: DataFrame, sales: DataFrame) -> DataFrame:
    """Month-on-month elasticity of units to the units-weighted list price.

    The price in force on a day is found by an as-of join in bins: each price is valid until the next change, prices are
    cut at the ends of months, and a day meets the prices of its product and month only, of which there are at most as
    many as days. So a product with very many changes and days gives rows in proportion to both, and its months go to
    different tasks. The weighted price is kept as a decimal, so that an unchanged price compares equal and yields no
    elasticity.
    """
    changes = Window.partitionBy("product_id").orderBy("changed_date")
    # Of several changes on one day the last by (moment, id) holds.
    last_of_day = history.filter("product_id IS NOT NULL AND changed_date IS NOT NULL").groupBy("product_id", "changed_date").agg(
        F.max_by("new_price", F.struct("changed_at", "price_history_id")).alias("new_price")
    )
    daily = (
        sales.groupBy("product_id", "transaction_date")
        .agg(F.sum("quantity").alias("units"), F.sum("line_total").alias("revenue"))
        .withColumn("sale_month", F.trunc("transaction_date", "month"))
    )
    # A product's prices are needed up to its last day of sale.
    sold_until = daily.groupBy(F.col("product_id").alias("_sold")).agg(F.max("transaction_date").alias("_last"))
    valid = last_of_day.select(
        F.col("product_id").alias("_product"),
        "new_price",
        F.col("changed_date").alias("_from"),
        F.lead("changed_date").over(changes).alias("_until"),
    ).join(sold_until, F.col("_product") == F.col("_sold"))
    last_day = F.least(F.date_sub("_until", 1), F.col("_last"))
    prices = valid.filter(F.col("_from") <= F.col("_last")).select(
        "_product",
        "new_price",
        "_from",
        "_until",
        F.explode(F.sequence(F.trunc("_from", "month"), F.trunc(last_day, "month"), F.expr("interval 1 month"))).alias("_month"),
    )
    in_force = (
        (F.col("product_id") == F.col("_product"))
        & (F.col("sale_month") == F.col("_month"))
        & (F.col("transaction_date") >= F.col("_from"))
        & (F.col("_until").isNull() | (F.col("transaction_date") < F.col("_until")))
    )
    units = F.col("units").cast("decimal(18,4)")
    monthly = (
        daily.join(prices, in_force, "left")
        .groupBy("product_id", "sale_month")
        .agg(
            F.sum("units").alias("units_sold"),
            F.sum("revenue").alias("revenue"),
            F.sum(units * F.col("new_price")).alias("_priced"),
        )
        .withColumn("effective_price", F.when(F.col("units_sold") > 0, ratio("_priced", "units_sold", 10)))
    )
    by_month = Window.partitionBy("product_id").orderBy("sale_month")
    lagged = monthly.withColumns(
        {
            "prev_units": F.lag("units_sold").over(by_month),
            "prev_price": F.lag("effective_price").over(by_month),
        }
    )
    now, before = F.col("effective_price"), F.col("prev_price")
    moved = (before > 0) & (F.col("prev_units") > 0) & (now != before)
    unit_change = divide(F.col("units_sold") - F.col("prev_units"), "prev_units")
    price_change = divide(now - before, before)
    return lagged.select(
        "product_id",
        "sale_month",
        "units_sold",
        "revenue",
        "effective_price",
        "prev_units",
        "prev_price",
        F.when(moved, rounded(divide(unit_change, price_change), 4)).alias("price_elasticity"),
    )
