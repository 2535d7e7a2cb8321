"""Every registered query: a name and a callable (spark, directory) -> DataFrame."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.operators import sales
from tillhouse.plans import day_tables, quality
from tillhouse.plans.charts import CHARTS, Chart, chart_query, headline_kpis, heatmap
from tillhouse.plans.metrics import MARTS, MEASURES, METRICS, MetricLayer
from tillhouse.plans.registry import MODELS, Model, Params
from tillhouse.plans.warehouse import LAID_OUT, Warehouse
from tillhouse.session import configure, shared_folder
from tillhouse.sources import landing
from tillhouse.sources.export import delivery_complete, export_report
from tillhouse.sources.keyed_store import KeyedStore
from tillhouse.sources.order_book import CLOCK_EVENTS, OrderBookSource
from tillhouse.sources.raw_tables import EXTRACTED_AT, RAW_TABLES
from tillhouse.streaming.first_rows import first_rows, first_rows_stream
from tillhouse.streaming.polling import landing_stream, load_stream

SALES_AS_OF = date(2001, 8, 2)
#: The given tables hold a few hundred receipts a day at most, so tables are laid out by month.
PARAMS = Params(as_of=SALES_AS_OF, grain="month")
CLOCK_AS_OF = date(2001, 7, 31)
FRESHNESS_NOW = datetime(2024, 2, 2, 12)
ROWS_NOW = datetime(2001, 8, 3, 9)
LOADED_UNTIL = datetime(2001, 1, 1)
LOAD_NOW = datetime(2002, 1, 1)

Query = Callable[[SparkSession, str], DataFrame]
Table = Callable[[str], DataFrame]

_open: dict[tuple, Warehouse] = {}
_built: dict[tuple, tuple[str, Warehouse]] = {}


def _state(spark: SparkSession, directory: str) -> tuple:
    """The application, the folder, and the name, size and time of each table in it: new input makes new tables."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    listed = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)
    return spark.sparkContext.applicationId, directory, tuple(listed)


def warehouse(spark: SparkSession, directory: str) -> Warehouse:
    """One warehouse per application and input; its frames are lazy plans and are shared by queries."""
    key = _state(spark, directory)
    if key not in _open:
        configure(spark)
        _open[key] = Warehouse(OrderBookSource(spark, directory), PARAMS)
    return _open[key]


def _tables(spark: SparkSession, directory: str) -> tuple[str, Warehouse]:
    """The warehouse whose models are tables, and the folder under the session's shared one that holds them."""
    key = _state(spark, directory)
    if key not in _built:
        configure(spark)
        root = f"{shared_folder(spark)}/tables/{re.sub(r'[^A-Za-z0-9]+', '_', directory)}-{uuid4().hex[:8]}"
        _built[key] = root, Warehouse(OrderBookSource(spark, directory), PARAMS)
    return _built[key]


def build(spark: SparkSession, directory: str, names: list[str] | None = None) -> None:
    """Writes the models (all by default) as tables. Queries on built tables start no job before they are run."""
    root, house = _tables(spark, directory)
    house.materialise(spark, root, names, again=False)


def stored(spark: SparkSession, directory: str) -> Table:
    """Models as tables, the way models, metrics, charts and checks read each other. What is missing is built first."""
    root, house = _tables(spark, directory)
    return lambda name: house.built(spark, root, name)


def counted(spark: SparkSession, directory: str) -> Table:
    """Built models for counts, which come from the footers of their files."""
    root, house = _tables(spark, directory)
    return lambda name: house.counted(spark, root, name)


def comparable(frame: DataFrame, *as_double: str) -> DataFrame:
    """Decimals (and the named columns) as doubles, so that any reader compares plain numbers."""
    return frame.select(
        *[
            F.col(f"`{field.name}`").cast("double").alias(field.name)
            if isinstance(field.dataType, T.DecimalType) or field.name in as_double
            else F.col(f"`{field.name}`")
            for field in frame.schema
        ]
    )


# ---- models


def _model_query(entry: Model) -> Query:
    """A staging model as one plan from the source files, any other from the tables of its inputs."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        if entry.layer == "staging":
            return comparable(warehouse(spark, directory).table(entry.name))
        table = stored(spark, directory)
        return comparable(entry.build(PARAMS, *map(table, entry.inputs)))

    return query


def _time_spine(spark: SparkSession, directory: str) -> DataFrame:
    """The calendar from the first sale to two years after the last one."""
    sold = warehouse(spark, directory).table("stg_pos_transactions")
    bounds = sold.agg(
        F.min("transaction_date").alias("first"), F.add_months(F.max("transaction_date"), 24).alias("last")
    )
    return sales.days_between(bounds)


def model_queries() -> dict[str, Query]:
    ordered = sorted(MODELS.values(), key=lambda entry: ("SXM".index(entry.op_id[0]), entry.op_id))
    found: dict[str, Query] = {entry.query_key: _model_query(entry) for entry in ordered}
    found["m42_time_spine"] = _time_spine
    return found


# ---- metrics


def simple_metrics_by_mart() -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for metric in METRICS.values():
        if metric.kind == "simple":
            groups.setdefault(MEASURES[metric.measure].mart, []).append(metric.name)
    return groups


# key: metrics, group by, grain
METRIC_SLICES: dict[str, tuple[list[str], list[str], str | None]] = {
    **{f"k01_{mart.removeprefix('mart_')}_daily": (names, [], "day") for mart, names in simple_metrics_by_mart().items()},
    **{f"k02_{m.name}_monthly": ([m.name], [], "month") for m in METRICS.values() if m.kind == "ratio"},
    "k06_revenue_by_state_week": (["total_revenue", "total_transactions", "avg_transaction_value"], ["state"], "week"),
    "k06_shrink_by_product_month": (["shrink_value", "shrink_events"], ["product"], "month"),
    "k06_labor_by_department_quarter": (["attendance_rate", "total_labor_cost"], ["department"], "quarter"),
    "k06_sales_and_shrink_by_location_week": (["total_revenue", "shrink_value"], ["location_name"], "week"),
    "k06_margin_by_category_all_time": (["gross_margin_pct", "net_revenue"], ["category"], None),
}
SERIES_SLICES: dict[str, tuple[str, list[str], str]] = {
    **{f"k03_{m.name}": (m.name, [], "day") for m in METRICS.values() if m.kind == "to_date"},
    "k03_ytd_revenue_by_state": ("ytd_revenue", ["state"], "day"),
    "k03_ytd_revenue_by_month": ("ytd_revenue", [], "month"),
    "k03_ytd_revenue_by_state_quarter": ("ytd_revenue", ["state"], "quarter"),
    **{f"k04_{m.name}": (m.name, [], "day") for m in METRICS.values() if m.kind == "offset"},
    "k04_revenue_wow_growth_by_state": ("revenue_wow_growth", ["state"], "day"),
    "k04_revenue_wow_growth_by_week": ("revenue_wow_growth", [], "week"),
    "k04_revenue_wow_growth_by_state_month": ("revenue_wow_growth", ["state"], "month"),
}


def measures_by_mart() -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for measure in MEASURES.values():
        groups.setdefault(measure.mart, []).append(measure.name)
    return groups


def _finest(mart: str) -> str | None:
    return next(iter(MARTS[mart].time_columns.values()), None)


# key: measures, group by, grain, time column (the mart's first if none is named)
MEASURE_SLICES: dict[str, tuple[list[str], list[str], str | None, str | None]] = {
    "k05_complete_pairs_by_day": (["complete_pairs", "attendance_summary_net_hours_worked"], [], "day", None),
    "k05_load_flags_by_status_month": (["has_departed", "has_arrived", "is_on_time"], ["status"], "month", None),
    **{
        f"k05_measures_{mart.removeprefix('mart_')}": (names, [], _finest(mart), None)
        for mart, names in measures_by_mart().items()
    },
    "k06_cohort_by_first_purchase_month": (measures_by_mart()["mart_loyalty_cohort"], ["loyalty_tier"], "month", "first_purchase_date"),
}


def _metric_query(names: list[str], group_by: list[str], grain: str | None) -> Query:
    return lambda spark, directory: comparable(
        MetricLayer(stored(spark, directory)).query(names, group_by, grain), *names
    )


def _measure_query(names: list[str], group_by: list[str], grain: str | None, time_column: str | None) -> Query:
    return lambda spark, directory: comparable(
        MetricLayer(stored(spark, directory)).measures(names, group_by, grain, time_column), *names
    )


def metric_queries() -> dict[str, Query]:
    return {
        **{key: _metric_query(*spec) for key, spec in METRIC_SLICES.items()},
        **{key: _metric_query([name], groups, grain) for key, (name, groups, grain) in SERIES_SLICES.items()},
        **{key: _measure_query(*spec) for key, spec in MEASURE_SLICES.items()},
    }


# ---- dashboards


def chart_key(chart: Chart) -> str:
    """Charts are filed under the dashboard feature they show most of."""
    if chart.filters:
        feature = "b03"
    elif chart.grain:
        feature = "b04"
    elif chart.group_by and chart.limit:
        feature = "b05"
    elif chart.group_by:
        feature = "b01"
    else:
        feature = "b02"
    return f"{feature}_chart{chart.number:03d}_{chart.slug}"


def _chart_query(chart: Chart) -> Query:
    doubles = [m.name for m in chart.metrics if not m.aggregate.startswith("COUNT")]
    return lambda spark, directory: comparable(chart_query(stored(spark, directory), chart), *doubles)


def _heatmap(spark: SparkSession, directory: str) -> DataFrame:
    chart = CHARTS[79]
    x, y = chart.group_by
    grid = heatmap(stored(spark, directory)(chart.mart), x, y, chart.metrics[0], sales.DAY_NAMES)
    return comparable(grid)


def dashboard_queries() -> dict[str, Query]:
    found: dict[str, Query] = {chart_key(chart): _chart_query(chart) for chart in CHARTS.values()}
    found["b06_peak_hours_heatmap"] = _heatmap
    found["b07_headline_kpis"] = lambda spark, directory: headline_kpis(stored(spark, directory))
    return found


# ---- quality


def _quality(build: Callable[[Table], DataFrame]) -> Query:
    return lambda spark, directory: comparable(build(stored(spark, directory)))


def _damaged(table: Table) -> Table:
    """Staging tables with known faults, so that each check has something to find.

    Rows whose key ends in 3 are missing, those whose key ends in 7 are there twice, those whose key ends in 5 have lost
    their foreign keys, and lines whose id ends in 9 have a total one too high.
    """
    keys = {r.table: r.column for r in reversed(quality.select_rules("unique", "staging"))}

    def damage(name: str) -> DataFrame:
        frame = table(name)
        if name not in keys:
            return frame
        last = F.right(F.col(keys[name]), F.lit(1))
        for child, column, _, _ in quality.ORPHAN_KEYS:
            if child == name:
                frame = frame.withColumn(column, F.when(last != "5", F.col(column)))
        if name == "stg_pos_transaction_items":
            frame = frame.withColumn("line_total", F.col("line_total") + F.when(last == "9", 1).otherwise(0))
        times = F.when(last == "3", 0).when(last == "7", 2).otherwise(1)
        return frame.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times))).drop("_copy")

    return damage


# key: check and layer
RULE_SETS: dict[str, tuple[str, str | None]] = {
    "d01_unique_source": ("unique", "source"),
    "d01_unique_staging": ("unique", "staging"),
    "d01_unique_mart": ("unique", "mart"),
    "d02_not_null_source": ("not_null", "source"),
    "d02_not_null_staging": ("not_null", "staging"),
    "d02_not_null_mart": ("not_null", "mart"),
    "d03_relationships": ("relationships", None),
    "d04_accepted_values_staging": ("accepted_values", "staging"),
    "d04_accepted_values_mart": ("accepted_values", "mart"),
    "d05_row_count_staging": ("row_count", "staging"),
    "d05_row_count_mart": ("row_count", "mart"),
    "d06_values_between": ("between", None),
    "d07_column_pairs": ("pair", None),
}


def _rule_query(check: str, layer: str | None) -> Query:
    if check == "row_count":
        return lambda spark, directory: comparable(quality.run(counted(spark, directory), quality.select_rules(check, layer)))
    return _quality(lambda t: quality.run(t, quality.select_rules(check, layer)))


def quality_queries() -> dict[str, Query]:
    raw_names = list(RAW_TABLES)
    marts = [name for name, entry in MODELS.items() if entry.layer == "mart"]
    return {
        **{key: _rule_query(*spec) for key, spec in RULE_SETS.items()},
        "d08_severities": _quality(
            lambda t: quality.run(t, quality.select_rules("unique", "staging"))
            .groupBy("severity")
            .agg(F.count("*").alias("checks"), F.sum("failures").alias("failures"))
        ),
        "d09_orphans_failing": _quality(quality.orphan_report),
        "d09_orphans_all": _quality(lambda t: quality.orphan_report(t, failing_only=False)),
        "d09_all_keys": _quality(quality.key_report),
        "d09_all_keys_damaged": _quality(lambda t: quality.key_report(_damaged(t))),
        "d09_orphans_failing_damaged": _quality(lambda t: quality.orphan_report(_damaged(t))),
        "d10_revenue_consistency": _quality(quality.revenue_consistency),
        "d10_revenue_consistency_damaged": _quality(lambda t: quality.revenue_consistency(_damaged(t))),
        "d11_count_mismatches": _quality(quality.count_mismatches),
        "d11_count_mismatches_damaged": _quality(lambda t: quality.count_mismatches(_damaged(t))),
        "d12_line_total_balance": _quality(lambda t: quality.line_total_balance(t("stg_pos_transaction_items"))),
        "d12_line_total_balance_damaged": _quality(lambda t: quality.line_total_balance(_damaged(t)("stg_pos_transaction_items"))),
        "d13_transaction_total_balance": _quality(
            lambda t: quality.transaction_total_balance(t("stg_pos_transactions"))
        ),
        "d14_loyalty_balance": _quality(
            lambda t: quality.loyalty_balance(t("stg_pos_loyalty_point_transactions"), t("stg_pos_transactions"))
        ),
        "d15_negative_stock": _quality(lambda t: quality.negative_stock(t("stg_inv_stock_levels"))),
        "d16_unpaired_clock_events": _quality(
            lambda t: quality.unpaired_clock_events(t("stg_timeclock_events"), CLOCK_AS_OF)
        ),
        "d17_coupon_dates": _quality(
            lambda t: quality.promotion_dates(t("stg_pos_transaction_items"), t("stg_pos_coupons"), "coupon_id")
        ),
        "d17_deal_dates": _quality(
            lambda t: quality.promotion_dates(t("stg_pos_transaction_items"), t("stg_pos_combo_deals"), "deal_id")
        ),
        "d18_raw_table_counts": _quality(lambda t: quality.table_counts(t, raw_names)),
        "d18_mart_table_counts": lambda spark, directory: comparable(quality.table_counts(counted(spark, directory), marts)),
        # Types and positions are those of this engine.
        "d18_table_columns": _quality(lambda t: quality.catalogue(t, list(MODELS)).drop("data_type", "ordinal_position")),
        "d18_layout_by_month": lambda spark, directory: comparable(quality.rows_by_month(counted(spark, directory), list(LAID_OUT))),
        "d18_empty_tables": _quality(lambda t: quality.empty_tables(t, raw_names)),
        "d19_negative_values": _quality(quality.negative_values),
        "d20_revenue_by_layer": _quality(quality.revenue_by_layer),
        "d20_count_propagation": _quality(quality.count_propagation),
    }


# ---- ingest and export


def _scratch(spark: SparkSession) -> str:
    """A new folder per run, so that repeated runs never see each other's batches."""
    return f"{shared_folder(spark)}/runs/{uuid4().hex}"


def _receipts(spark: SparkSession, directory: str) -> DataFrame:
    return landing.as_text(warehouse(spark, directory).raw("raw_pos.transactions"))


def _loaded(frame: DataFrame, at: datetime) -> DataFrame:
    columns = list(RAW_TABLES["raw_pos.transactions"].columns)
    return landing.stamp(landing.conform(frame, columns), at)


def _source_scan(spark: SparkSession, directory: str) -> DataFrame:
    """Rows and newest watermark of every registered table."""
    source = warehouse(spark, directory).raw
    parts = []
    for entry in RAW_TABLES.values():
        newest = F.max(F.col(entry.watermark).cast("timestamp")) if entry.watermark else F.lit(None).cast("timestamp")
        parts.append(
            source(entry.name)
            .agg(F.count("*").alias("row_count"), newest.alias("newest"))
            .select(
                F.lit(entry.name).alias("table_name"),
                F.lit("incremental" if entry.incremental else "full").alias("strategy"),
                "row_count",
                "newest",
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _full_refresh(spark: SparkSession, directory: str) -> DataFrame:
    """Two full loads of the product table; only the second one is visible."""
    products = warehouse(spark, directory).raw("raw_pos.products")
    entry = RAW_TABLES["raw_pos.products"]
    store = landing.RawStore(spark, _scratch(spark))
    store.load(entry, products.filter("is_active"), LOADED_UNTIL)
    store.load(entry, products, LOAD_NOW)
    return store.read(entry).select("product_id", "name", "current_price", F.col(EXTRACTED_AT).alias("extracted_at"))


def _incremental(spark: SparkSession, directory: str) -> DataFrame:
    """Receipts a poll would fetch after everything before 2001 is loaded."""
    entry = RAW_TABLES["raw_pos.transactions"]
    source = _receipts(spark, directory)
    current = source.filter(F.col("transaction_dt").cast("timestamp") < F.lit(LOADED_UNTIL))
    newest = current.agg(F.max(F.col("transaction_dt").cast("timestamp"))).scalar()
    fetched = landing.incremental(source, newest, entry, LOAD_NOW)
    return fetched.select("transaction_id", F.col("transaction_dt").cast("timestamp").alias("transaction_dt"))


def _backfill(spark: SparkSession, directory: str) -> DataFrame:
    entry = RAW_TABLES["raw_pos.transactions"]
    fetched = landing.incremental(
        _receipts(spark, directory), None, entry, LOAD_NOW, datetime(1996, 3, 1), datetime(1996, 3, 31)
    )
    return fetched.select("transaction_id", F.col("transaction_dt").cast("timestamp").alias("transaction_dt"))


def _upsert(spark: SparkSession, directory: str) -> DataFrame:
    """Receipts up to mid 2001 loaded first; those of 2001 arrive again with tips added, new ones included."""
    moment = F.col("transaction_dt").cast("timestamp")
    source = _receipts(spark, directory)
    entry = RAW_TABLES["raw_pos.transactions"]
    current = _loaded(source.filter(moment < F.lit(datetime(2001, 6, 1))), LOADED_UNTIL)
    changed = source.filter(moment >= F.lit(LOADED_UNTIL)).withColumn("payment_method", F.lit("corrected"))
    merged = landing.upsert(current, _loaded(changed, LOAD_NOW), entry)
    return merged.select(
        "transaction_id",
        "payment_method",
        F.col("total").cast("double").alias("total"),
        F.col(EXTRACTED_AT).alias("extracted_at"),
    )


def _text_form(spark: SparkSession, directory: str) -> DataFrame:
    """Receipts with their lines nested, as the raw layer would keep them."""
    lines = warehouse(spark, directory).raw("raw_pos.transaction_items")
    nested = lines.select(
        "item_id", F.struct(F.col("product_id"), F.col("category")).alias("product"), F.array("location_id").alias("places")
    )
    return landing.as_text(nested)


def _schema_drift(spark: SparkSession, directory: str) -> DataFrame:
    """Members delivered without a tier and with an unknown extra column."""
    members = landing.as_text(warehouse(spark, directory).raw("raw_pos.loyalty_members"))
    drifted = members.drop("tier").withColumn("favourite_colour", F.lit("green"))
    return landing.conform(drifted, list(RAW_TABLES["raw_pos.loyalty_members"].columns)).drop(
        EXTRACTED_AT, "_sdc_batched_at"
    )


def _event_stream(spark: SparkSession, directory: str) -> DataFrame:
    """The events file streamed into the raw clock table and read back merged."""
    configure(spark)
    entry = RAW_TABLES["raw_timeclock.events"]
    scratch = _scratch(spark)
    schema = spark.read.parquet(f"{directory}/events.parquet").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(directory)
    kind = F.coalesce(*[F.when(F.col("event_type") == k, v) for k, v in CLOCK_EVENTS.items()])
    stream = events.filter(F.col("event_type").isin(*CLOCK_EVENTS)).select(
        F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("event_id"),
        F.concat(F.lit("E"), F.col("user_id").cast("string")).alias("employee_id"),
        kind.alias("event_type"),
        F.col("ts").cast("timestamp").alias("event_dt"),
        F.col("props").alias("notes"),
    )
    store = landing.RawStore(spark, f"{scratch}/raw")
    load_stream(stream, store, entry, f"{scratch}/progress").awaitTermination()
    return store.read(entry).select(
        "event_id", "employee_id", "event_type", F.col("event_dt").cast("timestamp").alias("event_dt"), "notes"
    )


def _export(spark: SparkSession, directory: str) -> DataFrame:
    """Headline marts exported to CSV; rows counted from the written files."""
    root = _scratch(spark)
    files = export_report(spark, stored(spark, directory), root, SALES_AS_OF, LOAD_NOW)
    parts = [
        spark.read.option("header", True).csv(f"{root}/{entry['key']}")
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(entry["key"].rsplit("/", 1)[1]).alias("file"), "row_count")
        for entry in files
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _delivery(spark: SparkSession, directory: str) -> DataFrame:
    """Headline marts exported, then counted against the marts and the manifest."""
    root, table = _scratch(spark), stored(spark, directory)
    export_report(spark, table, root, SALES_AS_OF, LOAD_NOW)
    return delivery_complete(spark, table, root, SALES_AS_OF)


def _repeated_loads(spark: SparkSession, directory: str) -> DataFrame:
    """Receipts loaded up to 2001, then all of them with 2001 corrected, compacted, loaded once more, read."""
    source = _receipts(spark, directory)
    entry = RAW_TABLES["raw_pos.transactions"]
    store = landing.RawStore(spark, _scratch(spark))
    store.load(entry, source, LOADED_UNTIL)
    late = F.col("transaction_dt").cast("timestamp") >= F.lit(LOADED_UNTIL)
    corrected = source.withColumn("payment_method", F.when(late, "corrected").otherwise(F.col("payment_method")))
    store.load(entry, corrected, LOAD_NOW)
    store.compact(entry, LOAD_NOW + timedelta(hours=1))
    store.load(entry, corrected.filter(late), LOAD_NOW + timedelta(hours=2))
    return store.read(entry).select("transaction_id", "payment_method", F.col("total").cast("double").alias("total"))


def _deliver_years(spark: SparkSession, directory: str, scratch: str) -> None:
    """Receipts as files of JSON lines, newest year first, the oldest ones twice."""
    entry = RAW_TABLES["raw_pos.transactions"]
    folder = f"{scratch}/landing/{entry.schema_name}/{entry.table_name}"
    source = landing.conform(_receipts(spark, directory), list(entry.columns))
    year = F.year(F.col("transaction_dt").cast("timestamp"))
    for after, before in ((1998, 9999), (1994, 1998), (0, 1994), (0, 1994)):
        source.filter((year >= after) & (year < before)).write.mode("append").json(folder)


def _late_stream(spark: SparkSession, directory: str) -> DataFrame:
    """Receipts streamed newest year first, one file a batch, the oldest year twice: late rows stay, repeats don't."""
    configure(spark)
    entry = RAW_TABLES["raw_pos.transactions"]
    scratch = _scratch(spark)
    _deliver_years(spark, directory, scratch)
    stream = landing_stream(spark, f"{scratch}/landing", entry, files_per_batch=1)
    store = landing.RawStore(spark, f"{scratch}/raw")
    load_stream(stream, store, entry, f"{scratch}/progress").awaitTermination()
    return store.read(entry).select("transaction_id", "member_id", F.col("total").cast("double").alias("total"))


def _first_rows(spark: SparkSession, directory: str) -> DataFrame:
    """The same files, the keys of four years remembered: older rows come by the second output, and every key once."""
    configure(spark)
    entry = RAW_TABLES["raw_pos.transactions"]
    scratch = _scratch(spark)
    _deliver_years(spark, directory, scratch)
    stream = landing_stream(spark, f"{scratch}/landing", entry, files_per_batch=1)
    first_rows_stream(stream, entry, f"{scratch}/out", f"{scratch}/progress", 4 * 365 * 86400, buckets=64).awaitTermination()
    return first_rows(spark, entry, f"{scratch}/out").select("transaction_id", "member_id", F.col("total").cast("double").alias("total"))


def _landing_scan(spark: SparkSession, directory: str) -> DataFrame:
    """Products delivered as JSON lines and read back as text with the registered columns."""
    entry = RAW_TABLES["raw_pos.products"]
    root = _scratch(spark)
    products = landing.conform(landing.as_text(warehouse(spark, directory).raw(entry.name)), list(entry.columns))
    products.write.json(f"{root}/{entry.schema_name}/{entry.table_name}")
    return landing.read_landing(spark, root, entry).select("product_id", "name", "current_price", "is_active")


def _damaged_lines(spark: SparkSession, directory: str) -> landing.Extract:
    """Products as JSON lines, some cut short, wrapped in a list, without their key, or with a field nobody registered."""
    entry = RAW_TABLES["raw_pos.products"]
    root = _scratch(spark)
    number = F.substring("product_id", 2, 20).cast("bigint")
    products = landing.as_text(warehouse(spark, directory).raw(entry.name)).withColumn("_n", number)
    shelf = F.when(F.col("_n") % 17 == 0, F.struct(F.col("_n").alias("row")))
    key = F.when(F.col("_n") % 13 != 0, F.col("product_id"))
    line = F.when(F.col("_n") % 11 == 0, F.expr("left(line, length(line) - 1)")).when(F.col("_n") % 19 == 0, F.concat(F.lit("["), F.col("line"), F.lit("]"))).otherwise(F.col("line"))
    lines = products.withColumn("line", F.to_json(F.struct(key.alias("product_id"), "name", "current_price", shelf.alias("shelf")))).select(line.alias("value"))
    lines.write.text(f"{root}/{entry.schema_name}/{entry.table_name}")
    return landing.read_extract(spark, root, entry)


def _quarantine(spark: SparkSession, directory: str) -> DataFrame:
    """Every line of the damaged extract, as a row or with what is wrong with it."""
    extract = _damaged_lines(spark, directory)
    good = extract.rows.select(F.lit(None).cast("string").alias("problem"), "product_id", "name", "current_price")
    name = F.regexp_extract("line", '"name":"([^"]*)"', 1)
    bad = extract.bad.select("problem", F.lit(None).cast("string").alias("product_id"), name.alias("name"), F.lit(None).cast("string").alias("current_price"))
    return good.unionByName(bad)


def _unregistered(spark: SparkSession, directory: str) -> DataFrame:
    """The unregistered field of those rows that have it, taken out of their VARIANT."""
    return _damaged_lines(spark, directory).unknown().select("product_id", F.variant_get("fields", "$.shelf.row", "bigint").alias("shelf_row"))


def _create_or_recreate(spark: SparkSession, directory: str) -> DataFrame:
    """Departments loaded into a new table, into one without the key column, and into one that fits."""
    entry = RAW_TABLES["raw_pos.departments"]
    rows = warehouse(spark, directory).raw(entry.name)
    parts = []
    for existing in (None, ["other"], list(entry.columns)):
        store = landing.RawStore(spark, _scratch(spark))
        if existing:
            store.write_batch(entry, rows.select([F.lit("old").alias(c) for c in existing]), landing.batch_name(LOADED_UNTIL))
        action = landing.prepare(store, entry, existing, rows, LOAD_NOW)
        parts.append(store.read(entry).select(F.lit(action).alias("action"), "department_id", "name"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _keyed_merge(spark: SparkSession, directory: str) -> DataFrame:
    """The same two loads as `_upsert`, merged in place into a table that is bucketed by its key."""
    configure(spark)
    moment = F.col("transaction_dt").cast("timestamp")
    source = _receipts(spark, directory)
    entry = RAW_TABLES["raw_pos.transactions"]
    store = KeyedStore(spark, _scratch(spark), slices=64, buckets=16)
    store.replace(entry, landing.stamp(source.filter(moment < F.lit(datetime(2001, 6, 1))), LOADED_UNTIL), "first")
    changed = source.filter(moment >= F.lit(LOADED_UNTIL)).withColumn("payment_method", F.lit("corrected"))
    store.merge(entry, landing.stamp(changed, LOAD_NOW), "second")
    return store.read(entry).select(
        "transaction_id",
        "payment_method",
        F.col("total").cast("double").alias("total"),
        F.col(EXTRACTED_AT).alias("extracted_at"),
    )


def _reloaded_month(spark: SparkSession, directory: str) -> DataFrame:
    """Receipts laid out by month, of which May 1997 is loaded again from corrected sources."""
    receipts = warehouse(spark, directory).table("stg_pos_transactions")
    path = f"{_scratch(spark)}/receipts"
    day_tables.write_laid_out(receipts, path, "transaction_dt", "month")
    corrected = receipts.withColumn("payment_method", F.lit("corrected"))
    day_tables.reload_periods(corrected, path, "transaction_dt", date(1997, 5, 1), date(1997, 5, 31), "month")
    return day_tables.read_laid_out(spark, path, receipts.schema, "month").select(
        "transaction_id", "payment_method", F.col("_month").alias("month")
    )


def ingest_queries() -> dict[str, Query]:
    return {
        "i01_source_scan": _source_scan,
        "i01_landing_scan": _landing_scan,
        "i01_quarantined_lines": _quarantine,
        "i02_full_refresh": _full_refresh,
        "i03_incremental_window": _incremental,
        "i03_backfill_window": _backfill,
        "i04_upsert": _upsert,
        "i04_repeated_loads": _repeated_loads,
        "i04_keyed_merge": _keyed_merge,
        "i05_text_form": _text_form,
        "i06_schema_drift": _schema_drift,
        "i06_drift_report": lambda spark, directory: _damaged_lines(spark, directory).drift(),
        "i06_unregistered_fields": _unregistered,
        "i06_create_or_recreate": _create_or_recreate,
        "i07_event_stream": _event_stream,
        "i07_late_stream": _late_stream,
        "i07_first_rows": _first_rows,
        "i08_materialised_mart": lambda spark, directory: comparable(stored(spark, directory)("mart_daily_revenue")),
        "i08_reloaded_month": _reloaded_month,
        "i09_csv_export": _export,
        "i10_delivery_check": _delivery,
        "i11_row_freshness": lambda spark, directory: quality.row_freshness(warehouse(spark, directory).raw, ROWS_NOW),
        "i11_source_freshness": lambda spark, directory: quality.freshness(
            warehouse(spark, directory).raw, FRESHNESS_NOW
        ),
    }


def all_queries() -> dict[str, Query]:
    return {
        **model_queries(),
        **metric_queries(),
        **dashboard_queries(),
        **quality_queries(),
        **ingest_queries(),
    }
