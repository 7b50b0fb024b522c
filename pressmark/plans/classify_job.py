"""Train on a labelled corpus and write categories into front-matter documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressmark.operators import classify
from pressmark.operators.classify import Settings
from pressmark.sinks import writers
from pressmark.session import job
from pressmark.sources import corpus


def training_set(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """Labelled documents below a folder, or in packed files, that have a category left."""
    read = corpus.read_packed if packed else corpus.read_documents
    return corpus.labelled(corpus.parse_training(read(spark, path)))


def save_training_set(articles: DataFrame, path: str, packed: bool = False) -> None:
    """Write articles as a labelled corpus, by file name; ``packed`` keeps many documents a file."""
    write = writers.write_packed if packed else writers.write_texts
    write(writers.training_files(corpus.training_from_articles(articles)), path)


def unlabelled_documents(spark: SparkSession, path: str, packed: bool = False) -> DataFrame:
    """Parsed front-matter documents below a folder; of equal file names the last path stays.

    A file that :func:`writers.write_texts` wrote has the name of its ``file_name=`` folder, any
    other that of the file.
    """
    if packed:
        return corpus.parse_front_matter(corpus.read_packed(spark, path).withColumnRenamed("path", "filename"))
    found = corpus.read_documents(spark, path)
    found = found.withColumn("filename", writers.written_name(F.col("path")))
    last = found.groupBy("filename").agg(F.max("path").alias("path"))
    return corpus.parse_front_matter(found.join(last, ["filename", "path"], "left_semi")).drop("path")


def classify_documents(
    documents: DataFrame, training: DataFrame, model_path: str, settings: Settings = Settings()
) -> DataFrame:
    """Add ``categories`` by a saved model, trained and saved first when there is none."""
    model = classify.load_or_fit(training, model_path, settings=settings)
    return model.predict(documents, keep=[c for c in documents.columns])


def run(
    spark: SparkSession, corpus_path: str, documents_path: str, model_path: str, target: str,
    settings: Settings = Settings(), packed: bool = False,
) -> None:
    """Classify all documents below a folder and write each with its categories.

    With ``packed`` all three corpora have many documents a file.
    """
    with job(spark):
        documents = unlabelled_documents(spark, documents_path, packed)
        labelled = classify_documents(documents, training_set(spark, corpus_path, packed), model_path, settings)
        write = writers.write_packed if packed else writers.write_texts
        write(writers.categorised_files(labelled, "filename"), target)
