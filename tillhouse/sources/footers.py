"""Counts and extremes of stored tables from the footers of their Parquet files.

A count of all rows, and the least or greatest value of a number or date, need no row group: every file's footer has them.
Spark answers such aggregates from footers when the files are read through the newer source interface, so `footer_view`
reads a table that way; other queries on it work as usual.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Takes effect for tables read through `footer_view` only.
PUSHDOWN = "spark.sql.parquet.aggregatePushdown"
_OLD_INTERFACE = "spark.sql.sources.useV1SourceList"


@contextmanager
def _newer_interface(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_OLD_INTERFACE)
    spark.conf.set(_OLD_INTERFACE, ",".join(s for s in before.split(",") if s.strip() != "parquet"))
    try:
        yield
    finally:
        spark.conf.set(_OLD_INTERFACE, before)


def footer_view(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table of Parquet files under `path`, aggregates of which are answered from the files' footers."""
    spark.conf.set(PUSHDOWN, "true")
    with _newer_interface(spark):
        return spark.read.schema(schema).parquet(path)
