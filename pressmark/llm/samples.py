"""Bounded samples of labelled rows, and models fitted on them in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def fold(doc_id: str, folds: int) -> Column:
    """The crc32 of a document id as text, modulo ``folds``; null ids are fold 0."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds)), F.lit(0))


def labelled_sample(documents: DataFrame, labels: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """At most ``rows`` labelled documents (text and label columns), chosen by a hash of the id.

    The choice depends on the ids alone. Labels of unknown documents and rows with a null in
    ``columns`` are left out. Repeated label rows count once, different ones of a document each.
    Of texts that share a ``doc_id`` the least one is learnt from, so however many rows one id
    holds, no more than ``rows`` come out.
    """
    known = documents.select(F.col("doc_id").alias("doc_id")).where("doc_id is not null").distinct()
    full = labels.select("doc_id", *columns).dropna().distinct()
    chosen = full.join(known, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", *columns).limit(rows)
    # no more than ``rows`` narrow rows, so this side can be sent to every task
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return texts.groupBy("doc_id", *columns).agg(F.min("text").alias("text")).select("text", *columns)


def fitted(sample: DataFrame, fit: Callable[[pa.Table], Any]) -> Any:
    """What ``fit`` makes of a bounded sample, worked out in one task: the driver holds the result, not the rows."""
    names = sample.columns

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if sum(batch.num_rows for batch in held):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(pa.Table.from_batches(held).select(names)))], pa.binary())], names=["model"])

    found = sample.repartition(1).mapInArrow(whole, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else fit(sample.limit(0).toArrow())
