"""The operators over the given tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pressmark.llm import (
    alignment, bpe, chats, decontamination, fingerprints, language, near_dedup, quality, quality_rules, ranking, sharding,
    toxicity, url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TOKENIZERS = alignment.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edit_resistance(table(spark, folder, "documents"))


def op2_chat_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return chats.rendered(table(spark, folder, "conversations"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.judged(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identified(table(spark, folder, "documents"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assigned(table(spark, folder, "documents"))


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"))


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judged(table(spark, folder, "pages"))


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judged(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), RANKS, PATTERN)


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.linked(table(spark, folder, "documents"), TOKENIZERS)


def op12_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_fingerprints, op2_chat_snapshots, op3_toxicity, op4_decontamination, op5_language, op6_sharding, op7_near_dedup,
        op8_url_filter, op9_quality, op10_bpe, op11_alignment, op12_ranked_search, op13_quality_rules,
    )
}

ORACLE: dict[str, str] = {
    "op2_chat_snapshots": chats.ORACLE,
    "op6_sharding": sharding.oracle(),
    "op8_url_filter": url_filter.oracle(),
    "op12_ranked_search": ranking.ORACLE,
    "op13_quality_rules": quality_rules.oracle(),
}
