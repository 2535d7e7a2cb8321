"""The operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tillhouse.llm import (
    chat_format,
    exact_dedup,
    html_extraction,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    phrases,
    piece_sampling,
    quality_rules,
    sharding,
    substring_dedup,
    url_filters,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched_on", url_filters.fetch_day(F.col("page_id")))
    return url_filters.filter_urls(captures, url_filters.list_events(pages))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs, _table(spark, sf_dir, "labels")).select("row.doc_id", "quality.*")


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.read_back(chat_format.format_chats(chats.unionByName(chat_format.probe_rows(spark))))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(_table(spark, sf_dir, "pages"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).drop("kept_text")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).documents.select("doc_id", "size", "source_size", "target", "taken")


def op10_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_sampling.digests(_table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(_table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    altered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return merkle.manifest(_table(spark, sf_dir, "documents"), altered)


def op13_stratified_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(_table(spark, sf_dir, "documents")).drop("source")


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    listed = [
        op1_url_filters,
        op2_line_dedup,
        op3_minhash_near_dedup,
        op4_quality_rules,
        op5_chat_formatting,
        op6_html_extraction,
        op7_exact_dedup,
        op8_substring_dedup,
        op9_source_mixing,
        op10_sentencepiece_sampling,
        op11_phrase_mining,
        op12_merkle_manifest,
        op13_stratified_sharding,
    ]
    return {f.__name__: f for f in listed} | {"pipeline": corpus_pipeline.run}
