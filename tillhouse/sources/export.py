"""CSV export of the executive marts with a manifest, and the check that a delivery is complete."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillhouse.plans.charts import CHARTS, HEADLINES

# Fixed value: the folder of a day's report.
FOLDER = "exec-report"
MANIFEST = "manifest.json"


def export_name(position: int, title: str) -> str:
    """Position and title in lower case; a colon cannot be part of a file system path."""
    return f"{position:03d}_{title.replace(':', '').replace(' ', '_').lower()}.csv"


def export_report(
    spark: SparkSession, table: Callable[[str], DataFrame], root: str, day: date, generated_at: datetime
) -> list[dict]:
    """One CSV folder per headline chart under <root>/exec-report/<day>, then the manifest.

    Every row of a mart is exported, in as many files as it has partitions. The manifest has the number
    of rows written and is written last; without it a delivery is not complete.
    """
    target = f"{root}/{FOLDER}/{day.isoformat()}"
    files = []
    for position, number in enumerate(HEADLINES.values(), start=1):
        chart = CHARTS[number]
        name = export_name(position, chart.title)
        written = Observation()
        frame = table(chart.mart).observe(written, F.count(F.lit(1)).alias("rows"))
        frame.write.mode("overwrite").option("header", True).csv(f"{target}/{name}")
        files.append({"chart": chart.title, "rows": written.get.get("rows", 0), "key": f"{FOLDER}/{day.isoformat()}/{name}"})
    manifest = {"generated_at": generated_at.isoformat(), "files": files}
    lines = spark.createDataFrame([(json.dumps(manifest),)], "value string")
    lines.coalesce(1).write.mode("overwrite").text(f"{target}/{MANIFEST}")
    return files


def _found(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def delivery_complete(spark: SparkSession, table: Callable[[str], DataFrame], root: str, day: date) -> DataFrame:
    """One row per headline chart: rows of the mart, of the delivered files and by the manifest, and whether they agree."""
    target = f"{root}/{FOLDER}/{day.isoformat()}"
    listed = "files array<struct<chart: string, rows: bigint, key: string>>"
    manifest = _found(lambda: spark.read.text(f"{target}/{MANIFEST}"))
    if manifest is not None:
        entry = F.explode(F.from_json("value", listed)["files"])
        manifest = manifest.select(entry.alias("entry")).select(
            F.substring_index("entry.key", "/", -1).alias("file"), F.col("entry.rows").alias("manifest_rows")
        )
    else:
        manifest = spark.createDataFrame([], "file string, manifest_rows bigint")
    counts = []
    for position, number in enumerate(HEADLINES.values(), start=1):
        chart = CHARTS[number]
        name = export_name(position, chart.title)
        mart = table(chart.mart).agg(F.count("*").alias("mart_rows")).select(F.lit(name).alias("file"), "mart_rows")
        csv = _found(lambda path=f"{target}/{name}": spark.read.option("header", True).option("multiLine", True).csv(path))
        delivered = csv.agg(F.count("*")).scalar() if csv is not None else F.lit(None).cast("bigint")
        counts.append(mart.withColumn("file_rows", delivered))
    joined = reduce(DataFrame.unionByName, counts).join(manifest, "file", "left")
    agree = (F.col("file_rows") == F.col("mart_rows")) & (F.col("manifest_rows") == F.col("mart_rows"))
    return joined.withColumn("complete", F.coalesce(agree, F.lit(False)))
