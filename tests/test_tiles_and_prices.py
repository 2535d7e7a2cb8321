"""Tiles from value counts against ntile, and the price in force against a plain interval join."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillhouse.operators.promotion import mart_product_price_elasticity, mart_promotion_effectiveness
from tillhouse.operators.ranking import in_tile, tile_ends


def tiled(frame, tiles):
    return in_tile(frame, tile_ends(frame, tiles, "v", "k").scalar(), "v", "k", "t")


def hot(n):
    """Two thirds share a value, keys share a long beginning."""
    return [(f"member-{i * 7919 % 100_003:07d}", Decimal(0 if i % 3 else i % 50) / 4) for i in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        hot(997),
        [(f"M{i}", Decimal(i)) for i in range(11)],
        [("a", Decimal(5)), ("ab", Decimal(5)), ("b", Decimal(5))],
        [(str(i), Decimal(1)) for i in range(333)],
        [(f"k{i}", Decimal(random.Random(i).randrange(-(10**9), 10**9)) / 100) for i in range(500)],
        [("only", Decimal(-3))],
        [],
    ],
)
def test_tiles_equal_ntile(spark, rows):
    data = spark.createDataFrame(rows, "k string, v decimal(28,4)")
    plain = data.withColumn("t", F.ntile(5).over(Window.orderBy("v", "k")))
    assert sorted(map(tuple, tiled(data, 5).collect())) == sorted(map(tuple, plain.collect()))


def test_tiles_of_long_and_null_keys(spark):
    data = spark.createDataFrame([(None if i == 4 else f"{'x' * i}", i % 4) for i in range(41)], "k string, v long")
    plain = data.withColumn("t", F.ntile(7).over(Window.orderBy("v", "k")))
    assert sorted(map(str, tiled(data, 7).collect())) == sorted(map(str, plain.collect()))


def test_tiles_need_no_sort_of_all_rows(spark):
    data = spark.createDataFrame(hot(50), "k string, v decimal(28,4)")
    plan = tiled(data, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan and "Sort" not in plan


def sales_of(spark, rows):
    return spark.createDataFrame(rows, "product_id string, transaction_date date, quantity decimal(18,4), line_total decimal(18,6)")


def history_of(spark, rows):
    return spark.createDataFrame(rows, "product_id string, changed_date date, changed_at timestamp, price_history_id string, new_price decimal(18,4)")


def test_price_in_force_over_years_gaps_and_months(spark, params):
    """Each month's weighted price equals one found day by day, also where a price holds for years or an hour."""
    draw, first = random.Random(3), date(1999, 1, 1)
    changes = sorted({first + timedelta(days=draw.randrange(1500)) for _ in range(40)})
    history = [("P", d, None, str(i), Decimal(draw.randrange(100, 900)) / 100) for i, d in enumerate(changes)]
    history += [("Q", date(1990, 1, 1), None, "q", Decimal(2)), ("R", date(2030, 1, 1), None, "r", Decimal(9)), (None, first, None, "n", Decimal(1)), ("P", None, None, "u", Decimal(1))]
    days = [first + timedelta(days=i) for i in range(-60, 1700, 3)]
    sold = [(p, d, Decimal(draw.randrange(1, 5)), Decimal(1)) for d in days for p in ("P", "Q", "R", "no history")]
    result = mart_product_price_elasticity(params, history_of(spark, history), sales_of(spark, sold)).collect()

    def price(product, day):
        own = [(d, x) for p, d, _, _, x in history if p == product and d is not None and d <= day]
        return max(own)[1] if own else None

    months = {}
    for product, day, units, _ in sold:
        at = months.setdefault((product, day.replace(day=1)), [Decimal(0), None])
        at[0] += units
        if (now := price(product, day)) is not None:
            at[1] = (at[1] or 0) + now * units
    assert {(r.product_id, r.sale_month): r.units_sold for r in result} == {k: v[0] for k, v in months.items()}
    for r in result:
        units, priced = months[r.product_id, r.sale_month]
        assert (r.effective_price is None) == (priced is None)
        assert priced is None or abs(float(r.effective_price) - float(priced / units)) < 1e-9


def test_a_hot_product_meets_its_months_only(spark, params):
    """One product changes its price and sells every day for eleven years: rows stay in proportion to both."""
    days = spark.range(4000).select(F.date_add(F.lit(date(1990, 1, 1)), F.col("id").cast("int")).alias("d"))
    price = (F.dayofyear("d") % 7 + 1).cast("decimal(18,4)")
    history = days.select(F.lit("P").alias("product_id"), F.col("d").alias("changed_date"), F.col("d").cast("timestamp").alias("changed_at"), F.col("d").cast("string").alias("price_history_id"), price.alias("new_price"))
    sales = days.select(F.lit("P").alias("product_id"), F.col("d").alias("transaction_date"), F.lit(1).cast("decimal(18,4)").alias("quantity"), price.cast("decimal(18,6)").alias("line_total"))
    result = mart_product_price_elasticity(params, history, sales)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert any("Join" in line and "_month" in line for line in plan.splitlines()), plan
    assert all(abs(float(r.effective_price) * float(r.units_sold) - float(r.revenue)) < 1e-6 for r in result.collect())


def test_days_active_of_ads_that_share_dates(spark, params):
    """Ads of equal name and dates fall together: units add up, days do not. Other ads of these dates count alone."""
    week = (date(2001, 1, 1), date(2001, 1, 7))
    ads = spark.createDataFrame([("A1", "one", *week), ("A2", "one", *week), ("A3", "other", *week), ("A4", "none", week[1], week[0])], "ad_id string, ad_name string, start_date date, end_date date")
    offers = spark.createDataFrame([("A1", "P", "i1", None, Decimal(1)), ("A3", "P", "i2", Decimal(5), Decimal(1)), ("A3", "P", "i3", Decimal(5), Decimal(1))], "ad_id string, product_id string, ad_item_id string, discount_pct decimal(18,2), promoted_price decimal(18,4)")
    items = spark.createDataFrame([(f"T{i}", "P", Decimal(2), Decimal(3), Decimal(6)) for i in range(4)] + [("T0", "Q", Decimal(1), Decimal(1), Decimal(1))], "transaction_id string, product_id string, quantity decimal(18,4), unit_price decimal(18,4), line_total decimal(18,6)")
    receipts = spark.createDataFrame([(f"T{i}", date(2001, 1, 1 + 2 * (i // 2))) for i in range(3)] + [("T3", date(2001, 2, 1))], "transaction_id string, transaction_date date")
    products = spark.createDataFrame([("P", "p", "c")], "product_id string, product_name string, category string")
    found = {(r.ad_name, r.product_id, r.is_ad_item): (r.days_active, float(r.total_units_sold)) for r in mart_promotion_effectiveness(params, ads, offers, items, receipts, products).collect()}
    assert found == {
        ("one", "P", True): (2, 6.0),
        ("one", "P", False): (2, 6.0),
        ("one", "Q", False): (1, 2.0),
        ("other", "P", True): (2, 12.0),
        ("other", "Q", False): (1, 1.0),
    }
