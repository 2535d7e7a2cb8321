"""Raw tables that are merged in place, without moving what is stored.

A table is a folder of slices, `_slice=<hash of the key modulo SLICES>`, whose files are bucketed and sorted by the key. A
load is dealt by the key to as many tasks as there are buckets and meets the stored rows of its key's bucket in a merge
join: the stored side is read bucket by bucket and never shuffled. Only slices that hold a key of the load are read, and
only these are written; the files of all others stay. The slice is the same hash that deals out the buckets, and their
number is a multiple, so a slice is one file.

Rows without a key cannot be merged; those of a load are kept as they came, in a folder of the load beside the table. A
load is written under a name of its own and moved in place slice by slice; one that was cut short is run again and gives
the same table. Use a format with MERGE instead where the catalog has one.
"""

from __future__ import annotations

import hashlib
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.sources.landing import last_write_wins, version_order
from tillhouse.sources.raw_tables import EXTRACTED_AT, METADATA_COLUMNS, RawTable

SLICE = "_slice"
_MODE = "spark.sql.sources.partitionOverwriteMode"


class KeyedStore:
    """`slices`: how finely a load picks what it rewrites; `buckets`: how many tasks a merge has at most."""

    def __init__(self, spark: SparkSession, root: str, slices: int = 1024, buckets: int = 256):
        if slices % buckets:
            raise ValueError("the number of slices has to be a multiple of the number of buckets")
        self.spark, self.root, self.slices, self.buckets = spark, root, slices, buckets

    def path(self, table: RawTable) -> str:
        return f"{self.root}/{table.schema_name}/{table.table_name}"

    def columns(self, table: RawTable) -> list[str]:
        return [*table.columns, *METADATA_COLUMNS]

    def _registered(self, table: RawTable) -> str:
        """The table's name in the session's catalog, which holds its buckets; the files alone make the table."""
        name = f"keyed_{hashlib.md5(self.path(table).encode()).hexdigest()[:16]}"
        if not self.spark.catalog.tableExists(name):
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder)
            columns = [f"`{c}` string" for c in table.columns] + [f"`{c}` timestamp" for c in METADATA_COLUMNS]
            self.spark.sql(
                f"CREATE TABLE {name} ({', '.join(columns)}, {SLICE} int) USING parquet PARTITIONED BY ({SLICE})"
                f" CLUSTERED BY (`{table.key}`) SORTED BY (`{table.key}`) INTO {self.buckets} BUCKETS LOCATION '{self.path(table)}'"
            )
            self.spark.catalog.recoverPartitions(name)
        return name

    def _slice(self, key: str) -> Column:
        return F.pmod(F.hash(key), F.lit(self.slices))

    def _shaped(self, table: RawTable, rows: DataFrame) -> DataFrame:
        """The registered columns only; those that the rows lack are null."""
        types = dict.fromkeys(table.columns, "string") | dict.fromkeys(METADATA_COLUMNS, "timestamp")
        present = set(rows.columns)
        return rows.select(*[(F.col(c) if c in present else F.lit(None)).cast(kind).alias(c) for c, kind in types.items()])

    @contextmanager
    def _replacing_slices(self):
        before = self.spark.conf.get(_MODE)
        self.spark.conf.set(_MODE, "dynamic")
        try:
            yield
        finally:
            self.spark.conf.set(_MODE, before)

    def _split(self, table: RawTable, rows: DataFrame, load: str) -> DataFrame:
        """One row per key, the newest; rows without a key are put aside."""
        shaped = self._shaped(table, rows)
        shaped.filter(F.col(table.key).isNull()).write.mode("overwrite").parquet(f"{self.path(table)}-keyless/_load={load}")
        keyed = shaped.filter(F.col(table.key).isNotNull()).repartition(self.buckets, table.key)
        return last_write_wins(keyed, table.key, F.desc(EXTRACTED_AT), *version_order(table, self.columns(table)))

    def merged(self, table: RawTable, incoming: DataFrame, touched: list[int]) -> DataFrame:
        """The stored rows of the touched slices, replaced or extended by incoming ones. Of two versions the one that was
        extracted later stays, the incoming one if that is equal; all its columns replace the other's."""
        key, columns = table.key, self.columns(table)
        stored = self.spark.table(self._registered(table)).filter(F.col(SLICE).isin(touched))
        old = stored.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
        new = incoming.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"))
        both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")
        newer = F.col("_old_key").isNull() | F.coalesce(
            F.col(f"_new.{EXTRACTED_AT}") >= F.col(f"_old.{EXTRACTED_AT}"), F.col(f"_old.{EXTRACTED_AT}").isNull()
        )
        row = F.when(F.col("_new_key").isNotNull() & newer, F.col("_new")).otherwise(F.col("_old"))
        return both.select(row.alias("_row")).select("_row.*").withColumn(SLICE, self._slice(key))

    def replace(self, table: RawTable, rows: DataFrame, load: str) -> None:
        """The table anew from one full extract: slices without rows become empty."""
        name = self._registered(table)
        self._split(table, rows, load).withColumn(SLICE, self._slice(table.key)).write.insertInto(name, overwrite=True)

    def merge(self, table: RawTable, rows: DataFrame, load: str) -> list[int]:
        """Merge one load, and return the slices that were rewritten."""
        incoming = self._split(table, rows, load)
        # At most one number per slice.
        touched = sorted(r[0] for r in incoming.select(self._slice(table.key)).distinct().collect())
        if touched:
            with self._replacing_slices():
                self.merged(table, incoming, touched).write.insertInto(self._registered(table), overwrite=True)
        return touched

    def read(self, table: RawTable) -> DataFrame:
        return self.spark.table(self._registered(table)).drop(SLICE)

    def keyless(self, table: RawTable) -> DataFrame:
        """Rows that came without a key, with the load they came in."""
        columns = [f"`{c}` string" for c in table.columns] + [f"`{c}` timestamp" for c in METADATA_COLUMNS]
        return self.spark.read.schema(f"{', '.join(columns)}, _load string").parquet(f"{self.path(table)}-keyless")
