"""Writers of import files, markdown, corpora and reject tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from pressmark import constants as K
from pressmark.operators.shards import assign_shards
from pressmark.session import remove, stage
from pressmark.sinks import render, templates as T

HEADER_BYTES = len(T.IMPORT_HEADER.encode())


def import_items(articles: DataFrame, root: str, zone: str = "UTC") -> DataFrame:
    """``url``, ``position``, ``item`` and its size in ``bytes`` of numbered articles."""
    rendered = articles.select("url", "position", render.import_item(root, zone).alias("item"))
    return rendered.withColumn("bytes", F.octet_length("item").cast("long"))


def import_shards(items: DataFrame, limit: int = K.IMPORT_FILE_LIMIT, **chunking: int) -> DataFrame:
    """``url``, ``position``, ``bytes`` and ``file_no`` of every item."""
    return assign_shards(items.select("url", "position", "bytes"), limit, HEADER_BYTES, **chunking)


def import_files(items: DataFrame, limit: int = K.IMPORT_FILE_LIMIT, **chunking: int) -> DataFrame:
    """``file_no``, ``file_name`` and ``content`` of every import file.

    A group is one file: the limit and at most one article more.
    """
    stored = stage(items, "items")
    numbered = stored.join(import_shards(stored, limit, **chunking).select("position", "file_no"), "position")
    files = numbered.groupBy("file_no").agg(
        F.array_sort(F.collect_list(F.struct("position", "item"))).alias("_items")
    )
    body = F.array_join(F.transform("_items", lambda x: x["item"]), "")
    return files.select(
        "file_no",
        F.concat(F.lit("import-"), F.col("file_no").cast("string"), F.lit(".xml")).alias("file_name"),
        F.concat(F.lit(T.IMPORT_HEADER), body, F.lit(T.IMPORT_FOOTER)).alias("content"),
    )


def shard_sizes(shards: DataFrame) -> DataFrame:
    """Items and bytes of every import file, footer left out."""
    return shards.groupBy("file_no").agg(
        F.count("*").alias("items"), (F.sum("bytes") + F.lit(HEADER_BYTES)).alias("bytes")
    )


def write_texts(documents: DataFrame, path: str, name: str = "file_name", content: str = "content") -> None:
    """One text file per row, in a folder named by the row.

    The text sink ends every row with a newline, so one at the end of the content is left out.
    """
    rows = documents.select(F.col(name).alias("file_name"), F.regexp_replace(content, r"\n\z", "").alias("value"))
    rows.write.partitionBy("file_name").text(path)


def write_named_texts(documents: DataFrame, path: str, name: str = "file_name", content: str = "content") -> None:
    """One text file per row, with exactly the row's name, directly below ``path``.

    For files of some size, such as import files. Spark's writer writes and commits them in a folder of its own below
    ``path``; then they are moved by name, which copies nothing. Until all are written none has its name, and
    a failed job leaves none. Two rows of one name, or a name with a slash, are an error.
    """
    spark = documents.sparkSession
    staging = f"{path.rstrip('/')}/_writing-{uuid.uuid4().hex}"
    try:
        write_texts(documents, staging, name, content)
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        system = hadoop(staging).getFileSystem(spark._jsc.hadoopConfiguration())
        plain = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        moves = []
        for folder in system.listStatus(hadoop(staging)):
            label = folder.getPath().getName()
            if not label.startswith("file_name="):
                continue
            target = plain(label.removeprefix("file_name="))
            parts = [f.getPath() for f in system.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")]
            if len(parts) != 1 or "/" in target:
                raise ValueError(f"{len(parts)} files named {target}")
            moves.append((parts[0], target))
        for part, target in moves:
            system.delete(hadoop(f"{path.rstrip('/')}/{target}"), False)
            if not system.rename(part, hadoop(f"{path.rstrip('/')}/{target}")):
                raise OSError(f"{target} was not moved to its name")
    finally:
        remove(spark, staging)


def write_packed(documents: DataFrame, path: str, name: str = "file_name", content: str = "content") -> None:
    """Many documents a file, in order of their names: for corpora of small documents.

    The files are Parquet with ``file_name`` and ``content``; as names are in order, a look-up by
    name reads one block of one file. Names that repeat stay. There are as many files as the session
    has shuffle partitions, fewer for little data. See :func:`pressmark.sources.corpus.read_packed`.
    """
    rows = documents.select(F.col(name).alias("file_name"), F.col(content).alias("content"))
    spread = rows.repartitionByRange("file_name", F.xxhash64("content"))
    spread.sortWithinPartitions("file_name").write.parquet(path)


def written_name(path: Column) -> Column:
    """The name of a document by its path: that of the folder made for it, else the file's own.

    Folder names are escaped as the writer does, and once more as paths are.
    """
    folder = F.regexp_extract(path, r"/file_name=([^/]*)/[^/]*\z", 1)

    def plain(name: Column) -> Column:
        return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))

    return F.when(folder != "", plain(plain(folder))).otherwise(plain(F.element_at(F.split(path, "/"), -1)))


def markdown_files(articles: DataFrame, root: str) -> DataFrame:
    """``file_name`` and ``content`` of numbered articles; of equal file names the last URL stays."""
    last = articles.groupBy("file_name").agg(F.max("url").alias("url"))
    kept = articles.join(last, ["file_name", "url"], "left_semi")
    return kept.select("file_name", render.markdown(root).alias("content"))


def training_files(training: DataFrame, name: str = "file_name") -> DataFrame:
    return training.select(
        F.col(name).alias("file_name"),
        render.training_document(F.col("categories"), F.col("article_body")).alias("content"),
    )


def categorised_files(documents: DataFrame, name: str = "file_name") -> DataFrame:
    return documents.select(
        F.col(name).alias("file_name"),
        render.categorised_document(F.col("metadata"), F.col("categories"), F.col("article_body")).alias("content"),
    )


def write_rejects(rejects: DataFrame, path: str) -> None:
    rejects.write.parquet(path)
