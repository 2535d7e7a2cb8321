"""From raw documents to token ids: quality rules, exact dedup, near-dedup, mixing, segmentation.

Each stage takes all that the one before kept, as a table with the columns of `documents`; the last returns token ids.
A stage's statistics (bucket weights, document frequencies, source sizes) are those of its own input.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tillhouse.llm import exact_dedup, mixing, near_dedup, piece_sampling, quality_rules  # noqa: E402
from tillhouse.session import shared_folder  # noqa: E402

#: The rows of run() have no SQL: hashed scores, sampling and segmentation are tested against brute force.
ORACLE_SQL = None


def _kept(docs: DataFrame, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows that `judge` keeps, each by its own verdict, whatever its id.

    Rows are judged under a key of their own, ascending by id (null last) and then by text, so that the rules for ties
    hold. Rows and keys are written once: all that read them see the same numbering.
    """
    spark = docs.sparkSession
    order = [F.col("row.doc_id").asc_nulls_last(), F.xxhash64("row.text")]
    rows = docs.select(F.struct("*").alias("row")).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    path = f"{shared_folder(spark)}/keyed-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    kept = judge(rows.select(F.col("_row").alias("doc_id"), "row.text")).filter("kept").select(F.col("doc_id").alias("_row"))
    return rows.join(kept, "_row", "left_semi").select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.judge(docs, labels).filter("quality.kept").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return _kept(docs, exact_dedup.exact_dedup)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return _kept(docs, near_dedup.classes)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as their source's target takes them, the last one of a source cut."""
    return mixing.mixed(docs)


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations: doc_id, sample, ids, log_prob, inclusion."""
    return piece_sampling.segmentations(docs)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("near-dedup", near), ("source mixing", mix), ("segmentation", segment)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; what a stage returns is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
