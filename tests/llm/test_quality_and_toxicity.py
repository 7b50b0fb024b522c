from __future__ import annotations

import os
import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import rows
from pyspark.sql import functions as F

from pressmark.llm import quality, toxicity
from pressmark.llm.quality import Neighbours, fit, trigram_counts, votes
from pressmark.llm.samples import labelled_sample
from pressmark.llm.toxicity import Chain, fit_chain, predict, text_words

LARGE = "/root/testdata/sf0.1"


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def labelled(label: str) -> list[tuple[int, str, int]]:
    texts = dict(rows(LARGE, "documents", "doc_id", "text"))
    return [(i, texts[i], y) for i, y in rows(LARGE, "labels", "doc_id", label)]


def plain_counts(text: str) -> dict[bytes, int]:
    data, out = text.encode(), {}
    for i in range(len(data) - 2):
        out[data[i : i + 3]] = out.get(data[i : i + 3], 0) + 1
    return out


def test_counts_cover_whole_texts():
    texts = ["", None, "ab", "abc", "the the cat the the the", "x " * 9000, "äöü", ""]
    counts = np.concatenate(list(trigram_counts(pa.array(texts), 4096)))
    assert counts.shape == (8, 4097)
    for row, text in zip(counts, texts):
        words = (text or "").split()
        assert row[-1] == sum(a == b for a, b in zip(words, words[1:]))
        assert int(row[:-1].sum()) == sum(plain_counts(text or "").values())


def test_votes_are_those_of_brute_force():
    pick = random.Random(4)
    texts = ["".join(pick.choices("abcde ", k=60)) for _ in range(80)] + ["abc" * 9] * 3
    labels = np.array([i % 2 for i in range(83)])
    settings = Neighbours(dimensions=16, voters=5)
    model = fit(pa.array(texts), labels, settings)
    counts = np.concatenate(list(trigram_counts(pa.array(texts[::-1]), settings.features)))
    found = votes(counts, model)
    weighted = np.log1p(counts.astype(float)) * model.idf
    weighted[:, -1] *= settings.repeats
    latent = weighted @ model.axes
    for score, vector in zip(found, latent):
        cosine = sorted(
            ((float(vector @ v) / float(np.linalg.norm(vector)), i) for i, v in enumerate(model.vectors.astype(float))), reverse=True
        )[:5]
        weight = [max(c, 0) ** settings.power for c, _ in cosine]
        assert abs(score - sum(w * labels[i] for w, (_, i) in zip(weight, cosine)) / sum(weight)) < 0.03


def test_scores_do_not_depend_on_the_block():
    given = [t for (t,) in rows("/root/testdata/sf0.01", "documents", "text")][:300]
    labels = np.arange(100) % 2
    model = fit(pa.array(given[:100]), labels)
    whole = np.concatenate([votes(c, model) for c in trigram_counts(pa.array(given), model.settings.features)])
    alone = np.concatenate([votes(c, model) for t in given for c in trigram_counts(pa.array([t]), model.settings.features)])
    assert whole.tolist() == alone.tolist()


def test_equal_similarities_count_in_order():
    similar = np.array([[0.5, 0.7, 0.5, 0.5, 0.9], [0.1, 0.1, 0.1, 0.1, 0.1]], dtype=np.float32)
    assert quality._nearest(similar, 3).tolist() == [[0, 1, 4], [0, 1, 2]]
    assert quality._nearest(similar, 5).tolist() == [[0, 1, 2, 3, 4]] * 2


def test_quality_of_held_out_documents():
    data = labelled("quality")
    train, test = [r for r in data if not held_out(r[0])], [r for r in data if held_out(r[0])]
    settings = Neighbours()
    model = fit(pa.array([t for _, t, _ in train]), np.array([y for *_, y in train]), settings)
    scores = np.concatenate([votes(c, model) for c in trigram_counts(pa.array([t for _, t, _ in test]), settings.features)])
    wanted = np.array([y for *_, y in test])
    assert ((scores >= 0.5) == wanted).mean() > 0.99


def test_toxicity_of_held_out_documents():
    data, chain = labelled("toxic"), Chain()
    train, test = [r for r in data if not held_out(r[0])], [r for r in data if held_out(r[0])]
    words = []
    for n, row, word in text_words(pa.array([t for _, t, _ in train]), chain.bits):
        at = np.searchsorted(row, np.arange(n + 1))
        words.extend(word[at[i] : at[i + 1]] for i in range(n))
    models = fit_chain(words, np.array([[y, y] for *_, y in train]), chain)
    found = predict(pa.array([t for _, t, _ in test]), models, chain.bits)
    wanted = np.array([y for *_, y in test])
    said = found[:, 0] >= 0.5
    # some 300 toxic rows to learn ten words in each of four languages from
    assert (said & (wanted == 0)).sum() <= 0.002 * len(test) and (said & (wanted == 1)).sum() > 0.8 * wanted.sum()
    assert models[1].earlier[0] > 1  # the first category's probability is used by the second


def test_chain_uses_out_of_fold_probabilities():
    pick = np.random.default_rng(1)
    # words that only occur once: seen rows are known by heart, so only out-of-fold
    # probabilities show that the first category cannot be predicted
    rows_ = [np.unique(pick.integers(0, 2**20, 30)).astype(np.uint32) for _ in range(200)]
    first = pick.integers(0, 2, 200)
    models = fit_chain(rows_, np.column_stack([first, first]), Chain())
    assert abs(models[1].earlier[0]) < 2


def _newton(x, y, ridge):
    """Ridge logistic regression by Newton steps on a dense table whose last column is constant."""
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (p - y) / len(y) + ridge * w
        w = w - np.linalg.solve((x.T * (p * (1 - p))) @ x / len(y) + np.diag(ridge + 1e-12), slope)
    return w


def _plain_fit(rows_, earlier, y, chain):
    """Probabilities of other rows by a model of these, one dense column for each word."""
    words = sorted(set().union(*map(set, rows_)))
    table = np.array([[w in own for w in words] for own in map(set, rows_)], dtype=float)
    n, share = len(y), y.mean()
    held = table.sum(axis=0)
    gain = (table.T @ y - held * share) ** 2 / np.maximum(held * (n - held) * share * (1 - share), 1e-9) * (held / (held + 4)) ** 2
    ridge = np.concatenate((chain.ridge / np.maximum(gain, 1e-4) ** chain.trust, np.full(earlier.shape[1], chain.earlier), [0]))
    w = _newton(np.column_stack((table, earlier, np.ones(n))), y, ridge)

    def of(others, before):
        table = np.array([[v in own for v in words] for own in map(set, others)], dtype=float)
        return 1 / (1 + np.exp(-np.column_stack((table, before, np.ones(len(others)))) @ w))

    return of


def test_chain_equals_a_plain_one():
    pick = np.random.default_rng(5)
    rows_ = [np.unique(pick.integers(0, 12, 5)).astype(np.uint32) for _ in range(150)]
    first = np.array([(3 in r) ^ (pick.random() < 0.2) for r in rows_]).astype(float)
    second = np.array([(7 in r) ^ (pick.random() < 0.2) for r in rows_]).astype(float)
    wanted = np.column_stack([first, second, np.maximum(first, second)])
    chain = Chain(ridge=1e-4, tolerance=1e-6, rounds=1000)
    models = fit_chain(rows_, wanted, chain)
    fold = np.array([int(r.astype(np.int64).sum()) * 2654435761 % 2**32 % chain.folds for r in rows_])
    earlier, full = np.zeros((150, 0)), np.zeros((150, 0))
    for category in range(3):
        y = wanted[:, category]
        full = np.column_stack((full, _plain_fit(rows_, earlier, y, chain)(rows_, full)))
        unseen = np.zeros(150)
        for k in range(chain.folds):
            train, test = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            unseen[test] = _plain_fit([rows_[i] for i in train], earlier[train], y[train], chain)([rows_[i] for i in test], earlier[test])
        earlier = np.column_stack((earlier, unseen))
    found = np.zeros((150, 0))
    row, word = np.repeat(np.arange(150), [len(r) for r in rows_]), np.concatenate(rows_).astype(np.int64)
    for model in models:
        found = np.column_stack((found, model.probabilities(row, word, found)))
    assert np.abs(found - full).max() < 1e-3


def test_verdict_comes_through_the_chain():
    texts = [t for _, t, _ in labelled("toxic")][:1500]
    both = {i: (q, t) for i, q, t in rows(LARGE, "labels", "doc_id", "quality", "toxic")}
    ids = [i for i, *_ in labelled("toxic")][:1500]
    wanted = np.array([[t * q, t * (1 - q), t] for q, t in (both[i] for i in ids)], dtype=float)
    words = []
    for n, row, word in text_words(pa.array(texts), 20):
        at = np.searchsorted(row, np.arange(n + 1))
        words.extend(word[at[i] : at[i + 1]] for i in range(n))
    models = fit_chain(words, wanted)
    assert toxicity.CATEGORIES[-1] == "toxic" and len(models) == 3 and models[-1].earlier.any()
    whole = predict(pa.array(texts), models, 20)
    blind = [toxicity.Linear(np.zeros(0, np.int64), np.zeros(0), np.zeros(i), -50.0) for i in range(2)]
    without = predict(pa.array(texts), [*blind, models[-1]], 20)
    assert ((whole[:, -1] >= 0.5) != (without[:, -1] >= 0.5)).any()


@pytest.mark.parametrize("operator", [quality, toxicity])
def test_odd_rows(spark, operator):
    pick = random.Random(8)
    words = ["river", "stone", "cloud", "paper", "green", "walks", "seven", "often"]
    texts = [" ".join(pick.choices(words, k=30)) + (" idiot" * 3 + " $$$###" * 9) * (i % 3 == 0) for i in range(120)]
    odd = [None, "", " ", "idiot", "river stone " * 30_000, texts[0], texts[0], "\x00\x01", "日本語"]
    given = [(i, t, 9, "s") for i, t in enumerate(texts + odd)] + [(None, texts[0], 9, "s"), (0, texts[0], 9, "s")]
    documents = spark.createDataFrame(given, "doc_id long, text string, score int, source string")
    for clash in ("p", "label", "toxic", "quality", "words", "wanted"):
        documents = documents.withColumn(clash, F.lit("x"))
    labels = [(i, int(i % 3 != 0), int(i % 3 == 0)) for i in range(120)] + [(5, None, 0), (None, 1, 1), (9999, 1, 0), (6, 0, 1)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("text", F.lit("clash"))
    found = operator.judged(documents, labels).collect()
    assert len(found) == len(given)
    bad = {r.doc_id: (r.predicted == 0 if operator is quality else r.rejected) for r in found}
    assert all(bad[i] == (i % 3 == 0) for i in range(120))
    by_text = {}
    for r, (_, text, *_) in zip(sorted(found, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(given, key=lambda g: (g[0] is None, g[0]))):
        value = r.score if operator is quality else (r.p_toxic, r.p_toxic_prose, r.p_toxic_noise)
        assert by_text.setdefault(text or "", value) == value
        assert all(0 <= v <= 1 for v in (value if isinstance(value, tuple) else (value,)))
    filtered = quality.of_quality if operator is quality else toxicity.without_toxic
    kept = filtered(documents, labels)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, is_bad in bad.items() if not is_bad}
    # nothing to judge, nothing to learn from
    assert operator.judged(documents.limit(0), labels).collect() == []
    untaught = operator.judged(documents, labels.limit(0)).collect()
    assert {r.score if operator is quality else r.p_toxic for r in untaught} <= {0.5, 0.0, toxicity._sigmoid(np.array(-50.0)).item()}


def test_sample_is_bounded_when_one_id_holds_many_rows(spark):
    documents = spark.range(900).selectExpr("if(id < 300, 7, id) doc_id", "concat('text ', 1000 + id) text", "'x' label")
    labels = spark.range(900).selectExpr("if(id < 300, 7, id) doc_id", "cast(id % 2 as int) label").unionByName(
        spark.createDataFrame([(1000, 1), (None, 1), (8, None)], "doc_id long, label int")
    )
    everything = labelled_sample(documents, labels, ["label"], 5000).collect()
    # ids 300 to 899 have a label each, id 7 has two and 300 texts, of which the least stays
    assert sorted((r.text, r.label) for r in everything) == sorted(
        [("text 1000", 0), ("text 1000", 1), *((f"text {1000 + i}", i % 2) for i in range(300, 900))]
    )
    assert labelled_sample(documents, labels, ["label"], 50).count() == 50


def test_models_are_fitted_in_a_task(spark, monkeypatch):
    """Fits of the pipeline's samples add nothing to the driver's memory."""
    documents = spark.createDataFrame([(i, f"text {i % 7}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, label int")
    monkeypatch.setattr(quality, "_fit", lambda counts, *_: (os.getpid(), len(counts)))
    monkeypatch.setattr(toxicity, "fit_chain", lambda rows, *_: (os.getpid(), len(rows)))
    for place, rows in (quality.train(documents, labels, "label"), toxicity.train(documents, labels, ["label"])):
        assert place != os.getpid() and rows == 20
    assert quality.train(documents, labels.limit(0), "label")[1] == 0
    assert toxicity.train(documents, labels.limit(0), ["label"])[1] == 0


def _peak(work) -> int:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_fits_copy_little_of_their_sample():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 5000, 900)).astype("<u4") for _ in range(1500)]
    pairs = sum(map(len, rows))
    wanted = rng.integers(0, 2, (1500, 2)).astype(float)
    few = toxicity.Chain(rounds=3)
    assert _peak(lambda: toxicity.fit_chain(rows, wanted, few)) < 32 * pairs + 2**22
    counts = rng.integers(0, 3, (3000, 1025)).astype(np.float32)
    assert _peak(lambda: quality._fit(counts, wanted[:, 0].repeat(2), quality.Neighbours(features=1024))) < counts.nbytes / 2
