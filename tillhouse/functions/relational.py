"""Small DataFrame building blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup(frame: DataFrame, dimension: DataFrame, key: str, dim_key: str | None = None, **take: str) -> DataFrame:
    """Left join a keyed dimension and add only `new_name=source_column`.

    No broadcast hint: AQE broadcasts when the measured size is below the session threshold and
    otherwise splits skewed partitions of the sort-merge join.
    """
    side = dimension.select(
        F.col(dim_key or key).alias("_lookup_key"),
        *[F.col(source).alias(name) for name, source in take.items()],
    )
    return frame.join(side, F.col(key) == F.col("_lookup_key"), "left").drop("_lookup_key")


def first_per(frame: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """First row of each key. The rank filter is applied before the shuffle too (window group limit)."""
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return frame.withColumn("_rank", F.row_number().over(ranked)).filter("_rank = 1").drop("_rank")
