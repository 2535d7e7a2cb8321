"""Loading source extracts into the raw layer.

A raw table is a folder of batches, `<root>/<schema>/<table>/_batch=<id>`, and a log beside them with a
row for each complete batch. A batch is written to its own folder, so a retry replaces only itself and
a failed load leaves the table as it was. A full table is its newest batch. An incremental table is the
last write per key; `compact` folds the batches into one, and later reads leave the folded ones out.
A read is one scan of the live batches. Where the catalog has a table format with MERGE, use that instead.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.sources.raw_tables import (
    BATCHED_AT,
    DELETED_AT,
    EXTRACTED_AT,
    METADATA_COLUMNS,
    RawTable,
)

BATCH = "_batch"
LOG = "batch string, newest timestamp, covers array<string>, keyed boolean"
# Batches of a stream are numbered, before those that are named after their time.
STREAM_PREFIX = "0-"


# ---- reading extracts


def read_landing(spark: SparkSession, root: str, table: RawTable) -> DataFrame:
    """JSON lines of one source table; every column is text and nested values keep their JSON text."""
    return spark.read.schema(table.struct(with_metadata=False)).json(f"{root}/{table.schema_name}/{table.table_name}")


def read_extract(spark: SparkSession, root: str, table: RawTable) -> Extract:
    """The lines of one source table's files, sorted out: rows, lines kept aside, and fields that nobody registered.

    A line is put aside if it is no JSON object, or if it has no key: such a row could not be merged, and all of them would
    become one. What the registered columns don't take is kept as a VARIANT beside the row.
    """
    lines = spark.read.text(f"{root}/{table.schema_name}/{table.table_name}").withColumn("_file", F.col("_metadata.file_path"))
    parsed = lines.filter(F.trim("value") != "").withColumn("_line", F.try_parse_json("value"))
    as_object = F.schema_of_variant("_line").startswith("OBJECT<")
    key = F.try_variant_get("_line", f"$['{table.key}']", "string")
    sorted_out = parsed.withColumn(
        "_problem",
        F.when(F.col("_line").isNull(), "not JSON").when(~as_object, "not an object").when(key.isNull(), "no key"),
    )
    # A whole value as text: a text as it is, nested values as JSON.
    def as_value(name: str) -> Column:
        value = F.try_variant_get("_line", f"$['{name}']", "variant")
        return F.when(~F.is_variant_null(value), F.coalesce(F.try_variant_get("_line", f"$['{name}']", "string"), F.to_json(value))).alias(name)

    values = [as_value(c) for c in table.columns]
    rows = sorted_out.filter("_problem IS NULL")
    bad = sorted_out.filter("_problem IS NOT NULL").select(F.col("_problem").alias("problem"), F.col("value").alias("line"), F.col("_file").alias("file"))
    return Extract(rows.select(*values), bad, rows.select(F.col("_line").alias("line")), table)


@dataclass(frozen=True)
class Extract:
    """`rows`: registered columns as text; `bad`: problem, line and file; `lines`: all good lines as VARIANT."""

    rows: DataFrame
    bad: DataFrame
    lines: DataFrame
    table: RawTable

    def drift(self) -> DataFrame:
        """One row per field that came or failed to come: field, type, rows that have it, and 'new', 'missing' or 'known'.

        A field's type is that of all its values, merged by schema_of_variant_agg.
        """
        fields = self.lines.select(F.explode(F.expr("cast(line as map<string, variant>)")).alias("field", "value"))
        came = fields.groupBy("field").agg(F.schema_of_variant_agg("value").alias("type"), F.count("*").alias("rows"))
        names = F.array(*map(F.lit, self.table.columns))
        known = self.lines.sparkSession.range(1).select(F.explode(names).alias("field"), F.lit(True).alias("registered"))
        status = F.when(F.col("registered").isNull(), "new").when(F.col("rows").isNull(), "missing").otherwise("known")
        return came.join(known, "field", "full").select("field", "type", F.coalesce("rows", F.lit(0)).alias("rows"), status.alias("status"))

    def unknown(self) -> DataFrame:
        """The key and, as VARIANT, the fields that nobody registered, of the rows that have some."""
        fields = F.expr("cast(line as map<string, variant>)")
        rest = F.map_filter(fields, lambda name, value: ~name.isin(*self.table.columns))
        key = F.try_variant_get("line", f"$['{self.table.key}']", "string").alias(self.table.key)
        return self.lines.select(key, rest.alias("_rest")).filter(F.size("_rest") > 0).select(self.table.key, F.expr("to_variant_object(_rest)").alias("fields"))


def as_text(frame: DataFrame) -> DataFrame:
    """Raw form of a typed frame: nested values as JSON text, everything else as text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return frame.select(
        *[
            (F.to_json(f.name) if isinstance(f.dataType, nested) else F.col(f.name).cast("string")).alias(f.name)
            for f in frame.schema
        ]
    )


def stamp(frame: DataFrame, extracted_at: datetime | Column) -> DataFrame:
    """Add the load metadata; nothing is ever marked deleted."""
    moment = extracted_at if isinstance(extracted_at, Column) else F.lit(extracted_at)
    return frame.withColumns(
        {
            EXTRACTED_AT: moment.cast("timestamp"),
            BATCHED_AT: moment.cast("timestamp"),
            DELETED_AT: F.lit(None).cast("timestamp"),
        }
    )


def conform(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Keep the table's columns only; a column the extract lacks becomes NULL."""
    present = set(frame.columns)
    return frame.select(
        *[F.col(c) if c in present else F.lit(None).cast("string").alias(c) for c in columns if c not in METADATA_COLUMNS],
        *[c for c in METADATA_COLUMNS if c in present],
    )


# ---- merging


def incremental(
    extract: DataFrame,
    newest: Column | datetime | None,
    table: RawTable,
    now: datetime,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Rows whose watermark lies in [newest loaded, now], or in an explicit window given for a backfill.

    With nothing loaded yet there is no lower bound.
    """
    moment = F.col(table.watermark).cast("timestamp")
    if start and end:
        return extract.filter((moment >= F.lit(start)) & (moment <= F.lit(end)))
    rows = extract.filter(moment <= F.lit(now))
    if newest is None:
        return rows
    low = newest if isinstance(newest, Column) else F.lit(newest)
    return rows.filter(low.isNull() | (moment >= low.cast("timestamp")))


def last_write_wins(frame: DataFrame, key: str, *newest_first: Column) -> DataFrame:
    """One row per key. Ranks are cut before the shuffle too, so repeated keys do not pile up in one task."""
    ranked = Window.partitionBy(key).orderBy(*newest_first)
    return frame.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")


def upsert(current: DataFrame, incoming: DataFrame, table: RawTable) -> DataFrame:
    """Current rows replaced or extended by incoming ones; all non-key columns are replaced.

    The order is load time, incoming before current, watermark, then the row's hash, so that several
    versions of a key in one load give the same winner on every run.
    """
    if table.key not in current.columns:
        current = current.limit(0).select(*[F.lit(None).cast("string").alias(c) for c in incoming.columns])
    columns = current.columns
    both = (
        conform_like(incoming, columns).withColumn("_arrival", F.lit(1))
        .unionByName(current.withColumn("_arrival", F.lit(0)), allowMissingColumns=True)
    )
    order = [F.desc(EXTRACTED_AT), F.desc("_arrival"), *version_order(table, columns)]
    return last_write_wins(both, table.key, *order).select(*columns)


def version_order(table: RawTable, columns: list[str]) -> list[Column]:
    """Of versions loaded together: the newest watermark (one that is no moment comes last), then the greatest hash of the row."""
    moment = [F.col(table.watermark).try_cast("timestamp").desc()] if table.watermark in columns else []
    return [*moment, F.xxhash64(*columns).desc()]


def conform_like(frame: DataFrame, columns: list[str]) -> DataFrame:
    present = set(frame.columns)
    return frame.select(*[F.col(c) for c in columns if c in present])


def schema_action(existing: list[str] | None, table: RawTable) -> str:
    """'create' when there is no table, 'recreate' when it lacks the key column, else 'keep'."""
    if existing is None:
        return "create"
    return "keep" if table.key in existing else "recreate"


# ---- raw tables on disk


class RawStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, table: RawTable) -> str:
        return f"{self.root}/{table.schema_name}/{table.table_name}"

    def log(self, table: RawTable, before: str | None = None) -> list[Row]:
        """One row per complete batch, those older than `before` only. Its length is the number of loads."""
        try:
            rows = self.spark.read.schema(LOG).parquet(f"{self.path(table)}/_log").collect()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return [r for r in rows if before is None or r.batch < before]

    def live(self, table: RawTable, before: str | None = None) -> list[str]:
        """Ids of the batches that make the table, oldest first."""
        rows = self.log(table, before)
        covered = {b for r in rows for b in r.covers}
        ids = sorted({r.batch for r in rows if r.keyed} - covered)
        return ids if table.incremental else ids[-1:]

    def write_batch(self, table: RawTable, frame: DataFrame, batch_id: str, covers: tuple[str, ...] = ()) -> None:
        """Write a batch, then log it with its newest watermark; what isn't logged isn't read."""
        seen = Observation()
        moment = F.col(table.watermark) if table.watermark in frame.columns else F.lit(None)
        frame.observe(seen, F.max(moment.cast("timestamp")).alias("newest")).write.mode("overwrite").parquet(
            f"{self.path(table)}/{BATCH}={batch_id}"
        )
        row = (batch_id, seen.get.get("newest"), list(covers), table.key in frame.columns)
        self.spark.createDataFrame([row], LOG).coalesce(1).write.mode("append").parquet(f"{self.path(table)}/_log")

    def read(self, table: RawTable, before: str | None = None) -> DataFrame | None:
        """The table's current rows, or those of batches older than `before`.

        All batches are read with the registered columns: one that lacks some has NULL there.
        """
        ids = self.live(table, before)
        if not ids:
            return None
        stamps = ", ".join(f"{c} timestamp" for c in METADATA_COLUMNS)
        columns = ", ".join(f"`{c}` string" for c in table.columns)
        rows = self.spark.read.schema(f"{columns}, {stamps}, {BATCH} string").parquet(self.path(table)).filter(F.col(BATCH).isin(ids))
        if not table.incremental:
            return rows.drop(BATCH)
        order = [F.desc(EXTRACTED_AT), F.desc(BATCH), *version_order(table, [c for c in rows.columns if c != BATCH])]
        return last_write_wins(rows, table.key, *order).drop(BATCH)

    def newest(self, table: RawTable, before: str | None = None) -> datetime | None:
        """The newest watermark loaded, from the log."""
        return max((r.newest for r in self.log(table, before) if r.keyed and r.newest), default=None)

    def load(
        self,
        table: RawTable,
        extract: DataFrame,
        now: datetime,
        start: datetime | None = None,
        end: datetime | None = None,
    ) -> None:
        """One load of one table, full or incremental as registered.

        The window starts from older batches only, so running a load again fetches the same rows.
        """
        batch_id = batch_name(now)
        rows = extract
        if table.incremental:
            rows = incremental(extract, self.newest(table, before=batch_id), table, now, start, end)
        self.write_batch(table, stamp(conform(as_text(rows), list(table.columns)), now), batch_id)

    def compact(self, table: RawTable, now: datetime) -> None:
        """Write the merged state as one batch that stands for those it was made of; they may then be removed."""
        ids, merged = self.live(table), self.read(table)
        if merged is not None:
            self.write_batch(table, merged, batch_name(now), tuple(ids))


def batch_name(now: datetime) -> str:
    return now.strftime("%Y%m%dT%H%M%S%f")


def prepare(store: RawStore, table: RawTable, existing: list[str] | None, frame: DataFrame, now: datetime) -> str:
    """Load a frame into a table of `existing` columns: kept, created, or begun anew if it lacks the key.

    A table begun anew holds the new batch alone. Returns what was done.
    """
    action = schema_action(existing, table)
    covers = tuple(r.batch for r in store.log(table)) if action == "recreate" else ()
    store.write_batch(table, stamp(conform(as_text(frame), list(table.columns)), now), batch_name(now), covers)
    return action
