"""The incremental load as a stream: every new extract file is appended as a batch of its raw table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillhouse.sources.landing import STREAM_PREFIX, RawStore, as_text, conform, stamp
from tillhouse.sources.raw_tables import RawTable


def load_stream(stream: DataFrame, store: RawStore, table: RawTable, checkpoint: str) -> StreamingQuery:
    """Process all extracts available now, then stop.

    A batch is named after the batch id, so one that is run again after a failure replaces its own
    output. Every row is kept, however late; reading merges batches by key, which drops repeats exactly
    and needs no state.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = conform(as_text(batch), list(table.columns))
        store.write_batch(table, stamp(rows, F.current_timestamp()), f"{STREAM_PREFIX}{batch_id:012d}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def landing_stream(spark: SparkSession, root: str, table: RawTable, files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(table.struct(with_metadata=False))
        .option("maxFilesPerTrigger", files_per_batch)
        .json(f"{root}/{table.schema_name}/{table.table_name}")
    )
