"""A training corpus from raw documents.

Quality, toxicity, near-duplicates, benchmark leaks, tokens, in this order. Every stage works
on the rows that the one before it wrote and reads labels and benchmark from ``sf_dir``. The
first four keep rows whole and return the columns of ``documents``; the last returns ids as
counts and digests. Cases without a text, without labels and the like are defined by the
operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pressmark.llm import bpe, decontamination, near_dedup, quality, toxicity
from pressmark.llm.queries import PATTERN, RANKS, table
from pressmark.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality vote accepts."""
    return quality.of_quality(docs, table(spark, sf_dir, "labels"))


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.without_near_duplicates(docs, near_dedup.MinHash(percent=80, bands=28, rows=4))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes."""
    return bpe.round_trip(docs, RANKS, PATTERN)


#: Most rows of a batch that goes to a Python worker: batches hold whole texts, on both sides of the pipe.
BATCH_ROWS = 1000


def in_small_batches(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The same stage, with no more than ``BATCH_ROWS`` rows in a batch; the session keeps that setting."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        name = "spark.sql.execution.arrow.maxRecordsPerBatch"
        if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
            spark.conf.set(name, str(BATCH_ROWS))
        return function(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("quality", in_small_batches(good_quality)),
    ("toxicity", in_small_batches(not_toxic)),
    ("near_duplicates", in_small_batches(one_of_each)),
    ("decontamination", in_small_batches(without_benchmark)),
    ("tokens", in_small_batches(tokenised)),
]

#: Trained models and token merges are beyond SQL; tests compare the pipeline with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    return docs
