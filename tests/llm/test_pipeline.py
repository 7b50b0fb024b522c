"""The pipeline against a plain one: every stage is compared on what the one before it kept."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from brute import components, words
from pyspark.sql import functions as F
from test_decontamination import plain_leaks

import corpus_pipeline
from pressmark.llm import quality, toxicity
from pressmark.llm.samples import fold
from pressmark.session import stage

SMALL = "/root/testdata/sf0.001"


def texts_of(table):
    return {r.doc_id: r.text for r in table.select("doc_id", "text").collect()}


def plain_quality(texts, model):
    """Ids whose nearest labelled vectors, found by sorting all of them, vote for label 1."""
    kept = set()
    for doc_id, text in texts.items():
        (counts,) = quality.trigram_counts(pa.array([text], pa.string()), model.settings.features)
        weighted = np.log1p(counts[0].astype(float)) * model.idf
        weighted[-1] *= model.settings.repeats
        vector = weighted @ model.axes.astype(float)
        cosines = [round(float(vector @ v) / float(np.linalg.norm(vector)), 4) for v in model.vectors.astype(float)]
        nearest = sorted(range(len(cosines)), key=lambda i: (-cosines[i], i))[: model.settings.voters]
        weight = {i: max(cosines[i], 0) ** model.settings.power for i in nearest}
        score = sum(w * model.labels[i] for i, w in weight.items()) / sum(weight.values())
        if abs(score - 0.5) < 0.02:
            kept.add((doc_id, None))  # too near to tell by other arithmetic
        elif score > 0.5:
            kept.add((doc_id, True))
    return kept


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that enter the pipeline, and those that leave each stage."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = [docs]
    for name, function in corpus_pipeline.STAGES:
        found.append(stage(function(spark, found[-1], SMALL), name))
    return found


def test_stages_keep_rows_whole(spark, stages):
    given = Counter(map(tuple, stages[0].collect()))
    for kept in stages[1:5]:
        assert kept.columns == stages[0].columns
        own = Counter(map(tuple, kept.collect()))
        assert own and own <= given
        given = own
    assert corpus_pipeline.run(spark, SMALL).exceptAll(stages[5]).isEmpty() and stages[5].count() == stages[4].count()


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.train(stages[0], labels.where(fold("doc_id", 3) != 1), "quality")
    wanted = plain_quality(texts_of(stages[0]), model)
    sure, open_ = {i for i, told in wanted if told}, {i for i, told in wanted if told is None}
    found = set(texts_of(stages[1]))
    assert found - open_ == sure and len(open_) < 20


def test_toxicity_stage(spark, stages):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    models = toxicity.train(stages[1], toxicity.categorised(labels), toxicity.CATEGORIES)
    texts = texts_of(stages[1])
    chances = toxicity.predict(pa.array(list(texts.values()), pa.string()), models, toxicity.Chain.bits)
    clean = {i for i, p in zip(texts, chances) if p[-1] < toxicity.Chain.threshold}
    assert set(texts_of(stages[2])) == clean


def test_near_duplicate_stage(stages):
    groups = components(sorted(texts_of(stages[2]).items()), 80)
    assert set(texts_of(stages[3])) == {i for i, least in groups.items() if i == least}


def test_decontamination_stage(spark, stages):
    items = [words(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    wanted = set()
    for doc_id, text in texts_of(stages[3]).items():
        own = words(text)
        runs = set(zip(*[own[i:] for i in range(4)]))
        # eleven of thirteen equal words hold a run of four
        near = [w for w in items if len(w) < 13 or runs & set(zip(*[w[i:] for i in range(4)]))]
        if not any(plain_leaks(own, w) for w in near):
            wanted.add(doc_id)
    assert set(texts_of(stages[4])) == wanted


def test_token_stage(stages):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = texts_of(stages[4])
    found = {r.doc_id: r for r in stages[5].collect()}
    assert set(found) == set(texts)
    for doc_id, text in texts.items():
        ids = library.encode_ordinary(text or "")
        assert found[doc_id].n_tokens == len(ids)
        assert found[doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_rows(spark, tmp_path):
    """Nulls, empty and repeated texts, clashing columns; then no documents and no other rows."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = docs.orderBy(F.length("text").desc()).limit(3)
    odd = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate([None, "", " \n", "short text"])], "doc_id long, text string")
    odd = docs.unionByName(odd, allowMissingColumns=True).unionByName(first).unionByName(first.withColumn("doc_id", F.lit(None).cast("long")))
    for clash in ("label", "p", "seed", "least", "n", "words", "leaked_doc_id", "counts"):
        odd = odd.withColumn(clash, F.lit("x"))
    odd.write.parquet(f"{tmp_path}/odd/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    for name in ("labels", "benchmark"):
        table = spark.read.parquet(f"{SMALL}/{name}.parquet")
        table.write.parquet(f"{tmp_path}/odd/{name}.parquet")
        table.limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    found = corpus_pipeline.run(spark, f"{tmp_path}/odd")
    ids = [r.doc_id for r in found.collect() if r.doc_id is not None]
    assert ids and len(ids) == len(set(ids))
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
