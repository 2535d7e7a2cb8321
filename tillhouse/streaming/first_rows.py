"""Each key's first row of a stream, with a bounded state and without loss.

A stream of extracts repeats rows and brings them out of order. The keys seen lately are kept in the state store, in
buckets of the key's hash; a bucket forgets keys that are older than its newest moment by more than `late_by`, so the state
holds that span of keys, however long the stream runs. A row whose key is remembered is a repeat and goes. Any other row
that lies within the span is its key's first and is remembered. A row older than the span cannot be told from a repeat
any more: it goes to a second output, as does one without a readable moment; rows without a key go to a third. The two
outputs together hold every key; `first_rows` reads each once, by a look at the keys of the second output only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tillhouse.functions import first_per
from tillhouse.sources.raw_tables import RawTable

FIRST, LATE, KEYLESS = "first", "late", "keyless"
_STATE = "keys array<string>, moments array<bigint>, newest bigint"


def _sorter(key: str, late_by_micros: int):
    """Sorts a bucket's rows of one batch into first and late ones, given what the bucket remembers."""

    def sort_out(bucket: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        keys, moments, newest = state.get if state.exists else ([], [], None)
        seen = dict(zip(keys, moments))
        low = None if newest is None else newest - late_by_micros
        for rows in parts:
            rows = rows.sort_values(["_micros", "_line"], na_position="last", kind="stable")
            kinds = []
            for name, micros in zip(rows[key], rows["_micros"]):
                readable = not pd.isna(micros)
                if name in seen:
                    kinds.append(None)
                    if readable:
                        seen[name] = max(seen[name], int(micros))
                elif not readable or low is not None and micros < low:
                    kinds.append(LATE)
                else:
                    kinds.append(FIRST)
                    seen[name] = int(micros)
                    newest = seen[name] if newest is None else max(newest, seen[name])
            out = rows.drop(columns=["_bucket", "_line"]).assign(_kind=kinds)
            yield out[out["_kind"].notna()]
        if newest is not None:
            kept = {k: m for k, m in seen.items() if m >= newest - late_by_micros}
            state.update((list(kept), list(kept.values()), newest))

    return sort_out


def sorted_out(stream: DataFrame, table: RawTable, late_by_seconds: int, buckets: int) -> DataFrame:
    """The stream's rows as text, with `_micros` and `_kind`, without the repeats it can tell."""
    micros = F.unix_micros(F.col(table.watermark).try_cast("timestamp"))
    text = stream.select(*[F.col(c).cast("string").alias(c) for c in table.columns])
    rows = text.withColumns({"_micros": micros, "_line": F.xxhash64(*table.columns), "_bucket": F.pmod(F.hash(table.key), F.lit(buckets))})
    columns = ", ".join(f"`{c}` string" for c in table.columns)
    keyed = (
        rows.filter(F.col(table.key).isNotNull())
        .groupBy("_bucket")
        .applyInPandasWithState(_sorter(table.key, late_by_seconds * 1_000_000), f"{columns}, _micros bigint, _kind string", _STATE, "append", GroupStateTimeout.NoTimeout)
    )
    keyless = rows.filter(F.col(table.key).isNull()).select(*table.columns, "_micros", F.lit(KEYLESS).alias("_kind"))
    return keyed.unionByName(keyless)


def first_rows_stream(
    stream: DataFrame, table: RawTable, folder: str, checkpoint: str, late_by_seconds: int, buckets: int = 1024
) -> StreamingQuery:
    """Process all extracts available now, then stop. A batch that is run again replaces its own output."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # Written once: the state is advanced by one pass over the batch.
        batch.write.mode("overwrite").partitionBy("_kind").parquet(f"{folder}/_batch={batch_id:012d}")

    rows = sorted_out(stream, table, late_by_seconds, buckets)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_rows(spark: SparkSession, table: RawTable, folder: str) -> DataFrame:
    """One row per key: its earliest first row, or its earliest late one if the key has no other."""
    columns = ", ".join(f"`{c}` string" for c in table.columns)
    rows = spark.read.schema(f"{columns}, _micros bigint, _batch string, _kind string").parquet(folder).filter(F.col("_kind") != KEYLESS)
    order = [F.col("_kind") == LATE, F.col("_batch"), F.asc_nulls_last("_micros"), F.xxhash64(*table.columns)]
    return first_per(rows, [table.key], *order).select(*table.columns, F.col("_kind").alias("kind"))


def keyless_rows(spark: SparkSession, table: RawTable, folder: str) -> DataFrame:
    columns = ", ".join(f"`{c}` string" for c in table.columns)
    return spark.read.schema(f"{columns}, _micros bigint, _batch string, _kind string").parquet(folder).filter(F.col("_kind") == KEYLESS).select(*table.columns)
