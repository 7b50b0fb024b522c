"""Toxicity categories by a chain of linear classifiers.

Categories are predicted one after another. Each is a logistic regression on the words of
the whole text (runs of letters, lower-cased, present or not, hashed) and on the
probabilities of all earlier categories. In training those come from out-of-fold
predictions: a text's probability is that of a model that has not seen it or an equal text.
The last category is the verdict, so every earlier model has a say in it. A model
has a weight for every hashed word of its training rows.

Models are fitted in one task from a bounded sample of labelled rows (``Chain.sample``),
whose texts become hashed words in the tasks before. Scoring is one narrow pass.

Defined results: null and wordless texts are scored by the intercepts and earlier
probabilities alone. A text at the threshold is rejected. Repeated rows stay and an empty table
gives no rows. A category without both classes has its share in the sample as constant
probability; without labelled rows all probabilities are 0. Equal texts have equal
probabilities. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from pressmark.llm.samples import fitted, labelled_sample
from pressmark.llm.words import row_chunks, word_hashes
from pressmark.operators.linear import Descent

# bytes of letters: ASCII letters and all bytes of longer characters
_BETWEEN = ~np.isin(np.arange(256), [*range(65, 91), *range(97, 123), *range(128, 256)])


# pairs of row and word that a fit copies at once
PAIRS = 1 << 16
# rows at which a word's correlation with a category counts a quarter
RARE = 4


@dataclass(frozen=True)
class Chain:
    """Most labelled rows to learn from, bits of a word hash, folds, ridge, most rounds, gradient left, cut.

    The ridge on a word is ``ridge`` over its squared correlation with the category to the power ``trust``;
    that on the probability of an earlier category is ``earlier``.
    """

    sample: int = 16000
    bits: int = 20
    folds: int = 3
    ridge: float = 3e-8
    trust: float = 1.5
    earlier: float = 1e-4
    rounds: int = 150
    tolerance: float = 1e-4
    threshold: float = 0.5


@dataclass(frozen=True)
class Linear:
    """``words`` are sorted hashes; ``weights`` are theirs, then those of earlier categories."""

    words: np.ndarray
    weights: np.ndarray
    earlier: np.ndarray
    intercept: float

    def probabilities(self, row: np.ndarray, word: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """``row`` and ``word``: distinct words of each row; ``earlier``: rows by earlier categories."""
        place = np.minimum(np.searchsorted(self.words, word), max(len(self.words) - 1, 0))
        hit = self.words[place] == word if len(self.words) else np.zeros(len(word), dtype=bool)
        logit = np.bincount(row[hit], weights=self.weights[place[hit]], minlength=len(earlier)) + self.intercept
        return _sigmoid(logit + earlier @ self.earlier)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def text_words(column: pa.Array, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For runs of rows: their number, and the distinct hashed words as pairs of row and word."""
    for _, data, offsets in row_chunks(column):
        hashes, starts = word_hashes(data, offsets, _BETWEEN)
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(starts))
        pairs = np.unique((row << bits) | (hashes >> np.uint64(64 - bits)).astype(np.int64))
        yield len(offsets) - 1, pairs >> bits, pairs & ((1 << bits) - 1)


def _pieces(pairs: int) -> Iterator[slice]:
    return (slice(begin, begin + PAIRS) for begin in range(0, pairs, PAIRS))


def _sums(at: np.ndarray, values: np.ndarray, of: np.ndarray, size: int) -> np.ndarray:
    """The sums of ``values[of]`` by ``at``, added in order; no more than ``PAIRS`` values are copied at once."""
    total = np.zeros(size)
    for piece in _pieces(len(at)):
        np.add.at(total, at[piece], values[of[piece]])
    return total


def _chosen(values: np.ndarray, number: np.ndarray, row: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``number[values]`` of the pairs whose ``row`` is one of ``rows`` (a mask)."""
    return np.concatenate([number[values[piece][rows[row[piece]]]] for piece in _pieces(len(row))] or [number[:0]])


def _fit_one(row: np.ndarray, word: np.ndarray, earlier: np.ndarray, wanted: np.ndarray, chain: Chain) -> Linear:
    share, n = float(wanted.mean()) if len(wanted) else 0.0, len(wanted)
    if share in (0.0, 1.0):
        return Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1]), 50.0 * (2 * share - 1))
    number = np.zeros(1 << chain.bits, dtype=np.int32)
    for piece in _pieces(len(word)):
        number[word[piece]] = 1
    seen = np.flatnonzero(number).astype(word.dtype)
    number[seen] = np.arange(len(seen), dtype=np.int32)
    place = _chosen(word, number, row, np.ones(n, dtype=bool))
    held = _sums(place, np.ones(n), row, len(seen))
    both = _sums(place, wanted, row, len(seen))
    # squared correlation of each word with the category, less for rare words: what tells little is held back more
    gain = (both - held * share) ** 2 / np.maximum(held * (n - held) * share * (1 - share), 1e-9) * (held / (held + RARE)) ** 2
    weights = _logistic(row, place, gain, earlier, wanted, chain)
    return Linear(seen, weights[: len(seen)], weights[len(seen) : -1], float(weights[-1]))


def _logistic(row: np.ndarray, place: np.ndarray, gain: np.ndarray, earlier: np.ndarray, wanted: np.ndarray, chain: Chain) -> np.ndarray:
    """Ridge logistic regression on sparse words and dense earlier probabilities; the intercept is not shrunk."""
    n, words = len(wanted), len(gain)
    ridge = np.concatenate((np.full(words, chain.ridge), np.full(earlier.shape[1], chain.earlier), [0.0]))
    ridge[:words] /= np.maximum(gain, 1e-4) ** chain.trust
    squares = np.concatenate((_sums(place, np.ones(n), row, words), (earlier**2).sum(axis=0), [n])) / n
    descent = Descent(np.zeros(len(ridge), dtype=np.float32), (0.25 * squares + ridge + 1e-8).astype(np.float32))
    for _ in range(chain.rounds):
        at = descent.trial().astype(np.float64)
        logit = _sums(row, at, place, n) + earlier @ at[words:-1] + at[-1]
        off = (_sigmoid(logit) - wanted) / n
        slope = np.concatenate((_sums(place, off, row, words), off @ earlier, [off.sum()])) + ridge * at
        loss = float(np.mean(np.logaddexp(0, logit) - wanted * logit)) + 0.5 * float(ridge @ at**2)
        descent.take(loss, slope, 8)
        if descent.ratio() <= chain.tolerance:
            break
    return descent.w.astype(np.float64)


def fit_chain(rows: list[np.ndarray], wanted: np.ndarray, chain: Chain = Chain()) -> list[Linear]:
    """Models in order; ``rows`` are sorted distinct words of each text, ``wanted`` rows by categories."""
    n = len(rows)
    every = np.arange(1 << chain.bits, dtype=np.int32)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(r) for r in rows])
    word = np.concatenate(rows).astype(np.int32) if n else np.zeros(0, dtype=np.int32)
    fold = np.array([int(r.astype(np.int64).sum()) * 2654435761 % 2**32 % chain.folds for r in rows], dtype=np.int64)
    earlier, models = np.zeros((n, 0)), []
    for category in range(wanted.shape[1]):
        target = wanted[:, category].astype(float)
        models.append(_fit_one(row, word, earlier, target, chain))
        held_out = np.zeros(n)
        for k in range(chain.folds):
            train, test = fold != k, fold == k
            number = (np.cumsum(train) - 1).astype(np.int32)
            model = _fit_one(_chosen(row, number, row, train), _chosen(word, every, row, train), earlier[train], target[train], chain)
            number = (np.cumsum(test) - 1).astype(np.int32)
            held_out[test] = model.probabilities(_chosen(row, number, row, test), _chosen(word, every, row, test), earlier[test])
        earlier = np.column_stack((earlier, held_out))
    return models


def predict(column: pa.Array, models: list[Linear], bits: int) -> np.ndarray:
    """Probabilities, rows by categories."""
    out = []
    for n, row, word in text_words(column, bits):
        found = np.zeros((n, 0))
        for model in models:
            found = np.column_stack((found, model.probabilities(row, word, found)))
        out.append(found)
    return np.concatenate(out) if out else np.zeros((0, len(models)))


def train(documents: DataFrame, labels: DataFrame, categories: list[str], chain: Chain = Chain()) -> list[Linear]:
    """Learn from at most ``chain.sample`` labelled documents (columns ``doc_id`` and ``categories``, 0 or 1)."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for n, row, word in text_words(batch.column("text"), chain.bits):
                bounds = np.searchsorted(row, np.arange(n + 1))
                packed.extend(word[bounds[i] : bounds[i + 1]].astype("<u4").tobytes() for i in range(n))
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column("wanted")], names=["words", "wanted"])

    sample = labelled_sample(documents, labels, categories, chain.sample)
    wanted = F.array(*[F.col(c).cast("double") for c in categories]).alias("wanted")
    def fit(table: pa.Table) -> list[Linear]:
        rows = sorted(zip(table["words"].to_pylist(), table["wanted"].to_pylist()))  # at most chain.sample rows
        target = np.array([w for _, w in rows]).reshape(len(rows), len(categories))
        return fit_chain([np.frombuffer(w, dtype="<u4") for w, _ in rows], target, chain)

    return fitted(sample.select("text", wanted).mapInArrow(hashed, "words binary, wanted array<double>"), fit)


def probabilities(text: Column, models: Broadcast, bits: int = Chain.bits) -> Column:
    """An array column with the probability of each category, in chain order."""

    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(predict(texts, models.value, bits).tolist(), pa.list_(pa.float64()))

    return of(text)


# Categories of the given labels: toxic in prose, in noise, and, told by both, toxic at all.
CATEGORIES = ["toxic_prose", "toxic_noise", "toxic"]


def categorised(labels: DataFrame) -> DataFrame:
    toxic, good = F.col("toxic"), F.col("quality")
    return labels.select("doc_id", toxic, (toxic * good).alias("toxic_prose"), (toxic * (1 - good)).alias("toxic_noise"))


def judged(documents: DataFrame, labels: DataFrame, chain: Chain = Chain()) -> DataFrame:
    """One row per document: doc_id, a probability for each category, rejected (the last one, toxic, at the threshold)."""
    models = documents.sparkSession.sparkContext.broadcast(train(documents, categorised(labels), CATEGORIES, chain))
    rows = documents.select(F.col("doc_id").alias("doc_id"), probabilities(F.col("text"), models, chain.bits).alias("p"))
    named = [F.col("p")[i].alias(f"p_{c}") for i, c in enumerate(CATEGORIES)]
    return rows.select("doc_id", *named, (F.col("p")[len(CATEGORIES) - 1] >= chain.threshold).alias("rejected"))


def without_toxic(documents: DataFrame, labels: DataFrame, chain: Chain = Chain()) -> DataFrame:
    """The rows of ``documents`` below the threshold, with all their columns."""
    models = documents.sparkSession.sparkContext.broadcast(train(documents, categorised(labels), CATEGORIES, chain))
    return documents.where(probabilities(F.col("text"), models, chain.bits)[len(CATEGORIES) - 1] < chain.threshold)
