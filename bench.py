"""Times the headline queries and the build of the tables they read, and prints one JSON line.

The build writes these models as tables and counts as one entry of the total; queries then only read. Each query is planned and run to completion into a sink that keeps nothing, so all rows and columns
are computed. A first pass over the smallest query warms the JVM and is not counted.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillhouse.plans.charts import CHARTS, HEADLINES  # noqa: E402
from tillhouse.plans.metrics import MEASURES, METRICS  # noqa: E402
from tillhouse.plans.registry import MODELS  # noqa: E402
from tillhouse.plans.suite import METRIC_SLICES, SERIES_SLICES, all_queries, build  # noqa: E402
from tillhouse.session import local_session  # noqa: E402

HEADLINE = [
    "m06_daily_revenue",
    "x01_int_pos_sales_enriched",
    "m03_category_sales_performance",
    "m09_department_performance",
    "m30_product_performance",
    "m10_department_shrinkage",
    "m18_hourly_sales_pattern",
    "x02_int_fulfillment_enriched",
    "m07_delivery_performance",
    "m05_daily_fulfillment_summary",
    "x03_int_hr_labor_enriched",
    "m13_employee_productivity",
    "x04_int_inventory_daily_snapshot",
    "m20_inventory_turnover",
    "m37_store_weekly_summary",
    "m25_loyalty_cohort",
    "m26_loyalty_engagement",
    "m27_loyalty_rfm",
    "m31_product_price_elasticity",
    "m32_promotion_effectiveness",
    "m34_route_efficiency",
    "k02_gross_margin_pct_monthly",
    "k03_ytd_revenue",
    "b07_headline_kpis",
    "d14_loyalty_balance",
    "i04_upsert",
]


def tables_read(names: list[str]) -> list[str]:
    """The models that the queries read as tables."""
    by_key = {entry.query_key: entry for entry in MODELS.values()}
    read = {i for name in names if name in by_key and by_key[name].layer != "staging" for i in by_key[name].inputs}
    read |= {CHARTS[number].mart for name in names if name.startswith("b07") for number in HEADLINES.values()}
    for name in names:
        for metric in METRIC_SLICES.get(name, [[]])[0] or ([SERIES_SLICES[name][0]] if name in SERIES_SLICES else []):
            for part in filter(None, (metric, METRICS[metric].numerator, METRICS[metric].denominator)):
                if METRICS[part].measure:
                    read.add(MEASURES[METRICS[part].measure].mart)
    if "d14_loyalty_balance" in names:
        read |= {"stg_pos_loyalty_point_transactions", "stg_pos_transactions"}
    return sorted(name for name in read if name in MODELS)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = local_session(cores, app="bench")
    queries = all_queries()

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, directory).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    run("s21_stg_pos_transactions")
    start = time.perf_counter()
    headline = [name for name in HEADLINE if not only or name in only]
    build(spark, directory, tables_read(headline))
    timings = {"build": round(time.perf_counter() - start, 3)}
    timings |= {name: round(run(name), 3) for name in headline}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
