"""Shards that all hold the same mixture: proportional stratified interleaving.

The rows of each source are shuffled by a seeded hash of their ids and ranked. Row r of a source with n rows stands at
the fraction (r + p) / n, where the source's phase p in [0, 1) is hashed from its name, so that sources of one row don't
all stand in the middle. Sorted by their fractions, the rows of every source are spread evenly over the whole order, and
the order is cut into shards whose row counts differ by one at most (the law `rows`). A shard holds of each source its
share of the rows, up to two rows.

Null texts have no bytes and the checksum 0. A null id counts as empty in the shuffle and comes after an empty one; rows
that share an id are ordered by checksum and size; rows equal in all that is read may take each other's places. Null is a
source like any other and comes first. With fewer rows than shards some shards are empty; no rows give no rows. Copies of
a text are rows like any other: they go where their own ids put them. `assign` reads doc_id, text and source alone;
`write_shards` keeps every column, whatever its name.

All steps are DataFrame expressions. Both ranks are taken over range partitions, so a source may hold any share of the
rows; texts are read once, for their size and checksum.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.ranks import rank_in_groups
from tillhouse.operators.ranking import global_row_number
from tillhouse.session import shared_folder

SHARDS = 40
SEED = 13
ROW_BYTES = 16


def assign(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, keys: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, text_crc32, law, shard, slot, grown_shard.

    `keys`: columns that are passed on and order rows of equal id, checksum and size.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("_draw"),
        *keys,
    )
    order = ["_draw", F.col("doc_id").asc_nulls_last(), "text_crc32", "size", *keys]
    ranked = rank_in_groups(rows, "source", order).drop("_draw")
    phase = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")))), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    spread = ranked.withColumn("_at", (F.col("rank").cast("double") + phase) / F.col("n").cast("double"))
    placed = global_row_number(spread, ["_at", F.col("source").asc_nulls_first(), "rank"], "_row")
    total = placed.agg(F.count("*")).scalar()
    place = F.col("_row") - 1
    # Decimals: the products may pass 64 bits.
    wide = F.lit(shards).cast("decimal(10,0)")
    cut = placed.withColumn("_total", total).withColumn("shard", F.expr(f"({shards} * cast(_row - 1 as decimal(19,0))) div _total").cast("int"))
    begin = F.ceil(F.col("shard") * F.col("_total").cast("decimal(19,0)") / wide).cast("long")
    return cut.select(
        "doc_id",
        "source",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (place - begin).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        *keys,
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes whole rows to `folder`/shard=K, in files that follow each other by slot; many tasks write one shard.

    Rows get a key of their own, written with them once, so each is found again whatever its id.
    """
    path = f"{shared_folder(docs.sparkSession)}/shard-{uuid.uuid4().hex}"
    docs.select(F.struct("*").alias("row")).withColumn("_key", F.monotonically_increasing_id()).write.parquet(path)
    named = docs.sparkSession.read.parquet(path)
    places = assign(named.select("row.doc_id", "row.text", "row.source", "_key"), shards, seed, ("_key",))
    rows = named.join(places.select("_key", "shard", "slot"), "_key").select("row", "slot", "shard")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
