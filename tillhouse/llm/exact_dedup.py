"""Exact duplicates by sorting contents.

Normalised texts are range-partitioned at sampled splitters and sorted (Spark's sort spills to disk), so equal texts lie
next to each other, and each row's text is compared with its neighbour's in full. The sort key is bounded: the first
64 code points, the SHA-256 of the normalised text, then the order in which copies are preferred. Since the last part
tells copies apart, a large group is cut by the splitters like everything else; the runs that touch a partition's edge
are put together from one row per edge.

Texts are equal when identical after deleting white space; null counts as empty, and empty texts are equal to each
other. Of a group the row with the most code points stays, then the smallest id (null ids last); of fully equal rows one
stays. Other columns of the input are not read, so their names don't matter. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.columns import without_spaces
from tillhouse.session import shared_folder

HEAD_CHARS = 64
_RUNS = "doc_id long, text_sha256 string, n_cp int, keep_id long, size long, part int, head boolean, edge boolean"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows to rows with their run's first id and size. A run waits, as ids only, until its end is known."""
    ids, sha, size, text, first = [], None, None, None, True

    def closed(edge: bool) -> pa.RecordBatch:
        all_ids = pa.concat_arrays(ids)
        n, head = len(all_ids), np.zeros(len(all_ids), bool)
        head[0] = True
        keep = pa.repeat(all_ids[0], n) if all_ids[0].is_valid else pa.nulls(n, pa.int64())
        columns = [all_ids, pa.repeat(sha, n), pa.repeat(size, n), keep, pa.repeat(pa.scalar(n, pa.int64()), n)]
        columns += [pa.repeat(part, n), pa.array(head), pa.repeat(pa.scalar(edge), n)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "text_sha256", "n_cp", "keep_id", "size", "part", "head", "edge"])

    for batch in batches:
        if not batch.num_rows:
            continue
        texts, part = batch["norm"], batch["part"][0]
        same = np.zeros(batch.num_rows, bool)
        same[0] = text is not None and texts[0].as_py() == text
        if batch.num_rows > 1:
            same[1:] = pc.equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(~same)
        cuts = [0, *starts[starts > 0].tolist(), batch.num_rows]
        done = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if not same[a] and ids:
                done.append(closed(first))
                ids, first = [], False
            if not ids:
                sha, size = batch["text_sha256"][a], batch["n_cp"][a]
            ids.append(batch["doc_id"].slice(a, b - a))
        text = texts[batch.num_rows - 1].as_py()
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
    if ids:
        yield closed(True)


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256. Reads `doc_id` and `text`."""
    shared_folder(docs.sparkSession)
    norm = without_spaces(F.col("text"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm"), F.length(F.coalesce("text", F.lit(""))).alias("n_cp")
    ).withColumns({"head64": F.substring("norm", 1, HEAD_CHARS), "text_sha256": F.sha2("norm", 256)})
    order = [F.col("head64"), F.col("text_sha256"), F.col("n_cp").desc(), F.col("doc_id").asc_nulls_last()]
    ordered = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "norm", "text_sha256", "n_cp", F.spark_partition_id().alias("part"))
    )
    # The splitters are sampled anew in each job: the runs have to be kept from one.
    runs = ordered.mapInArrow(_runs, _RUNS).checkpoint()
    # At most two rows per partition.
    edges = (
        runs.filter("edge AND head")
        .groupBy("text_sha256")
        .agg(
            F.sum("size").alias("all_size"),
            F.min(F.struct((-F.col("n_cp")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "part")).alias("best"),
        )
        .select(F.col("text_sha256").alias("edge_sha"), "all_size", F.col("best.doc_id").alias("best_id"), F.col("best.part").alias("best_part"))
    )
    joined = runs.join(F.broadcast(edges), F.col("edge") & (F.col("text_sha256") == F.col("edge_sha")), "left")
    return joined.select(
        "doc_id",
        F.when(F.col("edge"), F.col("best_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(F.col("edge"), F.col("all_size")).otherwise(F.col("size")).alias("group_size"),
        (F.col("head") & (~F.col("edge") | (F.col("part") == F.col("best_part")))).alias("kept"),
        "text_sha256",
    )
