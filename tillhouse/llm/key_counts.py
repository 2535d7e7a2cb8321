"""How often keys occur in the whole corpus, told back to the blocks of documents that hold them.

A corpus has about as many distinct windows as words, so a row for each would cost far more than the text. Documents are
dealt into blocks by their id; a block sends its distinct 64-bit keys, packed, to the part that owns their range; the
part adds up and answers each block with one byte per key, in the block's key order. Every key of every document is
counted. Blocks and parts are as many as the shuffle partitions ask for, so they grow with the cluster, not in size.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS_PER_PARTITION = 4
_ASKED = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_TOLD = pa.schema([("block", pa.int32()), ("part", pa.int32()), ("codes", pa.binary())])


def pack(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as differences, byte by byte: the high bytes are mostly zero and vanish when compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def unpack(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64)


def in_blocks(docs: DataFrame) -> DataFrame:
    """doc_id, text and block, dealt by block. The rows are the same for all that read it."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    dealt_by = F.xxhash64(F.coalesce("doc_id", F.xxhash64("text")))
    block = F.pmod(dealt_by, F.lit(n * BLOCKS_PER_PARTITION)).cast("int")
    return rows.withColumn("block", block).repartition(n, "block")


def counted(
    blocks: DataFrame,
    keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]],
    code_of: Callable[[np.ndarray], np.ndarray],
) -> DataFrame:
    """(block, part, codes): code_of(total count), a byte for each of the block's keys that the part owns.

    keys_of gives a block's distinct keys, ascending, and how often each counts.
    """
    parts = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def ask(table: pa.Table) -> pa.Table:
        keys, counts = keys_of(table)
        owner = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cuts = np.searchsorted(owner, np.arange(parts + 1, dtype=np.uint64))
        used = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
        columns = [
            pa.repeat(table["block"][0], len(used)) if used else pa.array([], pa.int32()),
            pa.array(used, pa.int32()),
            pa.array([pack(keys[cuts[p] : cuts[p + 1]]) for p in used], pa.binary()),
            pa.array([counts[cuts[p] : cuts[p + 1]].astype(np.uint32).tobytes() for p in used], pa.binary()),
        ]
        return pa.Table.from_arrays(columns, schema=_ASKED)

    def tell(table: pa.Table) -> pa.Table:
        sent = [unpack(x.as_buffer()) for x in table["keys"]]
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.uint32) for x in table["counts"]])
        _, place = np.unique(np.concatenate(sent), return_inverse=True)
        codes = code_of(np.bincount(place, weights=counts)).astype(np.uint8)[place]
        ends = np.cumsum([len(x) for x in sent])
        told = [codes[e - len(x) : e].tobytes() for x, e in zip(sent, ends)]
        return pa.Table.from_arrays([table["block"].combine_chunks(), table["part"].combine_chunks(), pa.array(told, pa.binary())], schema=_TOLD)

    asked = blocks.groupBy("block").applyInArrow(ask, "block int, part int, keys binary, counts binary")
    return asked.groupBy("part").applyInArrow(tell, "block int, part int, codes binary")


def codes_in_order(told: pa.Table) -> np.ndarray:
    """A block's codes in its key order."""
    rows = sorted(zip(told["part"].to_pylist(), told["codes"].to_pylist()))
    return np.frombuffer(b"".join(codes for _, codes in rows), np.uint8)
