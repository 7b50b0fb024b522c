"""Labelled and front-matter documents kept as text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pressmark import constants as K
from pressmark.functions.html import strip_tags
from pressmark.functions.text import ascii_fold


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``path`` and ``content`` of every file below a folder, one row per file."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """``path`` (the name) and ``content`` of documents that :func:`pressmark.sinks.writers.write_packed` wrote."""
    return spark.read.schema("file_name string, content string").parquet(path).select(F.col("file_name").alias("path"), "content")


def _blocks(content: Column, marker: str) -> Column:
    """Text before, between and after the marker lines."""
    return F.split(content, rf"(?dm)^{marker}$\n?")


def parse_training(documents: DataFrame, excluded: Sequence[str] = K.EXCLUDED_LABELS) -> DataFrame:
    """Categories and body of labelled documents.

    Every second block between marker lines is metadata. ``unclosed`` says that the last
    one is not ended. Documents left without a category stay: see :func:`labelled`.
    """
    parted = documents.withColumn("_blocks", _blocks(F.col("content"), K.CORPUS_MARKER))
    metadata = F.array_join(F.filter("_blocks", lambda b, i: i % 2 == 1), "\n")
    body = F.array_join(F.filter("_blocks", lambda b, i: i % 2 == 0), "")
    found = F.regexp_extract_all(metadata, F.lit(r"(?dm)^category: (.+)$"), 1)
    kept = [c for c in documents.columns if c != "content"]
    return parted.select(
        *kept,
        drop_labels(found, excluded).alias("categories"),
        body.alias("article_body"),
        (F.size("_blocks") % 2 == 0).alias("unclosed"),
    )


def drop_labels(categories: Column, excluded: Sequence[str] = K.EXCLUDED_LABELS) -> Column:
    """The labels without the excluded ones; order and repeats are kept."""
    return F.filter(categories, lambda c: ~c.isin(*excluded)) if excluded else categories


def labelled(training: DataFrame) -> DataFrame:
    """Documents with at least one category."""
    return training.where(F.size("categories") > 0)


def label_counts(training: DataFrame) -> DataFrame:
    """How many documents have a category and how many are removed for having none."""
    return training.agg(
        F.count_if(F.size("categories") > 0).alias("kept"),
        F.count_if(F.size("categories") == 0).alias("removed"),
    )


def parse_front_matter(documents: DataFrame) -> DataFrame:
    """Metadata, body and plain ASCII text of documents with a front-matter block.

    Lines between the first two marker lines are metadata, all others are body.
    """
    parted = documents.withColumn("_blocks", _blocks(F.col("content"), K.FRONT_MATTER_MARKER))
    kept = [c for c in documents.columns if c != "content"]
    rows = parted.select(
        *kept,
        F.coalesce(F.get("_blocks", F.lit(1)), F.lit("")).alias("metadata"),
        F.array_join(F.filter("_blocks", lambda b, i: i != 1), "").alias("article_body"),
    )
    return rows.withColumn("article_body_no_html", ascii_fold(strip_tags(F.col("article_body"))))


def training_from_articles(articles: DataFrame) -> DataFrame:
    """File name, categories and plain text of articles; of equal file names the last URL stays."""
    last = F.max_by(F.struct("categories", F.col("article_body_no_html").alias("article_body")), "url")
    return articles.groupBy("file_name").agg(last.alias("_last")).select("file_name", "_last.*")
