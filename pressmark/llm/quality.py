"""Quality by nearest-neighbour voting in a latent-semantic space.

A text is the counts of its terms over the whole text: hashed byte trigrams with case,
punctuation and spacing, and one term for words that repeat the word before them. Counts
enter as log(1 + count) times the inverse document frequency; the repeat term has weight
``repeats``, as one term stands against thousands. The singular vectors of
a bounded sample of labelled texts span the latent space. The sample's vectors and labels,
whose size the settings bound, go to every task. Every document's cosine with every labelled
vector is computed exactly, block by block; the labels of its nearest neighbours vote,
weighted by a power of their similarity.

Memory of a task: ``ROWS`` documents times ``features`` or ``sample`` numbers.

Defined results: a null or empty text, and one without a trigram or any similar neighbour,
gets the share of label 1 in the sample. Equal texts have equal scores. Without labelled rows
every score is 0.5. Similarities are worked out in doubles and rounded to ``DIGITS`` digits, so that the documents
beside it, which may change the last bits of a product, do not change a score. Neighbours at equal similarity count in the order of the sample. Only
``doc_id`` and ``text`` of ``documents`` are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from pressmark.llm.samples import fitted, fold, labelled_sample
from pressmark.llm.words import row_chunks, word_hashes

ROWS = 256
DIGITS = 5


@dataclass(frozen=True)
class Neighbours:
    """Most labelled rows to learn from, terms, dimensions, voters, power of similarity, weight of repeats.

    ``features`` is a power of two; one more term counts repeated words.
    """

    sample: int = 4000
    features: int = 4096
    dimensions: int = 64
    voters: int = 15
    power: int = 4
    repeats: float = 3


@dataclass(frozen=True)
class VoteModel:
    settings: Neighbours
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def trigram_counts(column: pa.Array, features: int) -> Iterator[np.ndarray]:
    """Matrices of trigram counts of at most ``ROWS`` consecutive texts, repeated words in a last column of their own."""
    for _, data, offsets in row_chunks(column):
        wide = data.astype(np.uint32)
        codes = np.zeros(len(data), dtype=np.int64)
        if len(data) > 2:
            grams = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:]
            codes[:-2] = (grams * np.uint32(0x9E3779B1)) >> np.uint32(32 - int(features).bit_length() + 1)
        repeats = _repeats(*word_hashes(data, offsets))
        for begin in range(0, len(offsets) - 1, ROWS):
            own = offsets[begin : begin + ROWS + 1]
            lengths = np.diff(own)
            row = np.repeat(np.arange(len(lengths)), lengths)
            inside = np.arange(own[0], own[-1]) + 2 < own[1:][row] if len(row) else np.zeros(0, dtype=bool)
            flat = np.bincount((row * features + codes[own[0] : own[-1]])[inside], minlength=len(lengths) * features)
            yield np.column_stack((flat.reshape(len(lengths), features), repeats[begin : begin + ROWS]))


def _repeats(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many words of each text equal the word before them."""
    same = np.zeros(len(words) + 1, dtype=np.int64)
    same[2:] = words[1:] == words[:-1] if len(words) else 0
    firsts = starts[:-1]
    same[firsts[firsts < len(words)] + 1] = 0
    sums = np.cumsum(same)
    return sums[starts[1:]] - sums[starts[:-1]]


def _unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, in place."""
    length = np.sqrt(np.einsum("ij,ij->i", rows, rows, dtype=np.float64))[:, None]
    rows /= np.maximum(length, 1e-12).astype(np.float32)
    return rows


def _weighted(counts: np.ndarray, idf: np.ndarray, repeats: float, own: bool = False) -> np.ndarray:
    """Weighted terms of length 1; counts in single precision that are the caller's ``own`` become them in place."""
    terms = np.log1p(counts, out=counts) if own else np.log1p(counts, dtype=np.float32)
    terms *= idf
    terms[:, -1] *= repeats
    return _unit(terms)


def fit(texts: pa.Array, labels: np.ndarray, settings: Neighbours = Neighbours()) -> VoteModel:
    """Latent vectors of labelled texts. ``settings.features`` is a power of two."""
    counts = [c.astype(np.float32) for c in trigram_counts(texts, settings.features)] or [np.zeros((0, settings.features + 1), np.float32)]
    return _fit(np.concatenate(counts), labels, settings)


def _fit(counts: np.ndarray, labels: np.ndarray, settings: Neighbours) -> VoteModel:
    """``counts``, in single precision, are used up."""
    holding = sum(((counts[at : at + ROWS] > 0).sum(axis=0) for at in range(0, len(counts), ROWS)), np.zeros(counts.shape[1], dtype=np.int64))
    idf = np.log((1 + len(counts)) / (1 + holding)).astype(np.float32) + np.float32(1)
    rows = _weighted(counts, idf, settings.repeats, own=True)
    axes = _singular_vectors(rows, settings.dimensions)
    return VoteModel(settings, idf, axes, _unit(rows @ axes), np.asarray(labels, dtype=np.float32))


def _singular_vectors(rows: np.ndarray, count: int) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a fixed start."""
    start = np.random.default_rng(7).standard_normal((rows.shape[1], count + 16)).astype(np.float32)
    space = np.linalg.qr(start)[0]
    for _ in range(6):
        space = np.linalg.qr(rows.T @ (rows @ space))[0]
    _, _, turn = np.linalg.svd(rows @ space, full_matrices=False)
    return np.ascontiguousarray((space @ turn.T)[:, :count], dtype=np.float32)


def _nearest(similar: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` greatest values of each row; of equal ones the first."""
    least = -np.partition(-similar, k - 1, axis=1)[:, k - 1 : k]
    above, equal = similar > least, similar == least
    room = k - above.sum(axis=1, keepdims=True)
    return np.nonzero(above | (equal & (np.cumsum(equal, axis=1) <= room)))[1].reshape(len(similar), k)


def votes(counts: np.ndarray, model: VoteModel) -> np.ndarray:
    """Scores of a block of documents by exact cosines with all labelled vectors."""
    if not len(model.labels):
        return np.full(len(counts), 0.5)
    prior = float(model.labels.mean())
    latent = _weighted(counts, model.idf, model.settings.repeats).astype(np.float64) @ model.axes.astype(np.float64)
    length = np.sqrt(np.einsum("ij,ij->i", latent, latent))[:, None]
    similar = np.round(latent / np.maximum(length, 1e-12) @ model.vectors.astype(np.float64).T, DIGITS)
    nearest = _nearest(similar, min(model.settings.voters, similar.shape[1]))
    weight = np.maximum(np.take_along_axis(similar, nearest, axis=1), 0) ** model.settings.power
    total = weight.sum(axis=1)
    known = (total > 1e-9) & counts.any(axis=1)
    score = np.where(known, (weight * model.labels[nearest]).sum(axis=1) / np.maximum(total, 1e-9), prior)
    return np.clip(score, 0, 1)


def train(documents: DataFrame, labels: DataFrame, label: str, settings: Neighbours = Neighbours()) -> VoteModel:
    """Learn from at most ``settings.sample`` labelled documents; texts become vectors in the tasks."""
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [c for part in trigram_counts(batch.column("text"), settings.features) for c in part]
            packed = [zlib.compress(c.astype("<u4").tobytes(), 1) for c in counts]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column("label")], names=["counts", "label"])

    sample = labelled_sample(documents, labels.select("doc_id", F.col(label).cast("int").alias("label")), ["label"], settings.sample)

    def of(table: pa.Table) -> VoteModel:
        rows = sorted(zip(table["counts"].to_pylist(), table["label"].to_pylist()))  # at most settings.sample rows
        counts = np.zeros((len(rows), settings.features + 1), dtype=np.float32)
        for count, (packed, _) in zip(counts, rows):
            count[:] = np.frombuffer(zlib.decompress(packed), dtype="<u4")
        return _fit(counts, np.array([label for _, label in rows], dtype=np.float32), settings)

    return fitted(sample.mapInArrow(vectors, "counts binary, label int"), of)


def score(text: Column, model: Broadcast) -> Column:
    """Scores (0 to 1) of a text column by a broadcast model."""

    @F.arrow_udf("double")
    def of(texts: pa.Array) -> pa.Array:
        parts = [votes(c, model.value) for c in trigram_counts(texts, model.value.settings.features)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return of(text)


def judged(documents: DataFrame, labels: DataFrame, settings: Neighbours = Neighbours()) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Labels of documents whose crc32 of the id is 1 modulo 3 are not learnt from.
    """
    model = train(documents, labels.where(fold("doc_id", 3) != 1), "quality", settings)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.col("doc_id").alias("doc_id"), score(F.col("text"), shared).alias("score"))
    return rows.select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def of_quality(documents: DataFrame, labels: DataFrame, settings: Neighbours = Neighbours()) -> DataFrame:
    """The rows of ``documents`` that are predicted to have label 1, with all their columns."""
    model = train(documents, labels.where(fold("doc_id", 3) != 1), "quality", settings)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    return documents.where(score(F.col("text"), shared) >= 0.5)
