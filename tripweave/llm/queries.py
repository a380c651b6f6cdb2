"""Registered queries of the pipeline operators and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.llm import (
    alignment, chat, contamination, filter_audit, jaccard, language, license_scan, mixing, nearest, quality, substrings, token_counts,
    url_filter,
)
from tripweave.llm.common import table
from tripweave.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        @wraps(query)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return query(spark, folder)

        QUERIES[name] = run
        if sql:
            TWINS[name] = sql
        return run

    return add


@register("op1_url_filter", url_filter.SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"))


@register("op2_decontamination", contamination.SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return contamination.find_contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@register("op3_quality")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return quality.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


@register("op4_jaccard_join", jaccard.SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, folder, "documents"))


@register("op5_nearest")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.nearest(table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


@register("op6_mixing", mixing.SQL)
def op6(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@register("op7_language")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


@register("op8_token_counts")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return token_counts.count_tokens(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@register("op9_chat_format", chat.SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(chat.PROBE).alias("text"),
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    return chat.chat_digest(chat.format_conversations(turns))


@register("op10_substring_dedup", substrings.SQL)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    kept = substrings.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@register("op11_token_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    first, second = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align_tokens(table(spark, folder, "documents"), first, second)


@register("op12_license_scan", license_scan.SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, folder, "documents")).drop("places")


@register("op13_filter_audit", filter_audit.SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))
