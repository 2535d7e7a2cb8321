"""Ranks inside groups of any size, also a group that holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.ranking import global_row_number
from tillhouse.session import shared_folder


def rank_in_groups(frame: DataFrame, group: str, order: list[Column | str]) -> DataFrame:
    """Adds `rank` (from 0), `first` (the group's first row in the whole order, so a key of the group) and `n`, its size.

    Groups ascend, null first; rows ascend by `order` in their group. Rows are range-partitioned, so a group spans any
    number of partitions. Fully equal rows, which may take each other's ranks, are told apart by their place in the
    input; it is written first, as range boundaries are sampled in a job of their own.
    """
    shared_folder(frame.sparkSession)
    placed = frame.withColumn("_place_in", F.monotonically_increasing_id()).checkpoint()
    numbered = global_row_number(placed, [F.col(group).asc_nulls_first(), *order, F.col("_place_in")], "_row").drop("_place_in")
    groups = numbered.groupBy(F.col(group).alias("_group")).agg(F.min("_row").alias("first"), F.count("*").alias("n"))
    return (
        numbered.join(groups, F.col(group).eqNullSafe(F.col("_group")))
        .withColumn("rank", F.col("_row") - F.col("first"))
        .drop("_row", "_group")
    )
