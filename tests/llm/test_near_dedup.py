from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import components, rows, shingles, similarity

from pressmark.llm import near_dedup
from pressmark.llm.near_dedup import MinHash, equal_groups, low_bits, minima, near_duplicates, without_near_duplicates
from pressmark.llm.words import shingle_sets

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], SCHEMA)


def variants(count: int, length: int, edits: int, seed: int) -> list[str]:
    """Texts that replace words of one text; some lie near it, some only near one another."""
    pick = random.Random(seed)
    base = [f"w{pick.randrange(4000)}" for _ in range(length)]
    made = [base]
    for n in range(count - 1):
        text = list(pick.choice(made))
        for _ in range(pick.randrange(edits) + 1):
            text[pick.randrange(length)] = f"x{n}{pick.randrange(100)}"
        made.append(text)
    pick.shuffle(made)
    return [" ".join(t) for t in made]


def test_shingles_of_whole_texts():
    texts = ["", None, " \n", "One", "one two\tTHREE four", "a b c d e", "a b c d e f a b c d e", "ä Ä é", "x" * 5000]
    texts += ["café\x0bau lait  noir\r\nÉté  fin"] * 2
    sizes = {i: s for i, s in shingle_sets(pa.array(texts))}
    assert [len(sizes[i]) for i in range(len(texts))] == [len(shingles(t)) for t in texts]
    assert (sizes[9] == sizes[10]).all()
    (_, upper), (_, lower) = shingle_sets(pa.array(["A b C d e f", "a B c D e f"]))
    assert (upper == lower).all()
    # neither chunks nor neighbours matter
    many = [f"{i} " + "word " * (i % 70) + "end of it all" for i in range(3000)]
    alone = [next(iter(shingle_sets(pa.array([t]))))[1] for t in many[:50]]
    whole = dict(shingle_sets(pa.array(many)))
    assert all((whole[i] == a).all() for i, a in enumerate(alone))
    assert [len(whole[i]) for i in range(3000)] == [len(shingles(t)) for t in many]


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_estimates_are_corrected(bits):
    settings = MinHash(bits=bits, signature=512)
    values = np.random.default_rng(3).integers(0, 2**63, 3000).astype(np.uint64)
    for shared in (0, 500, 800, 1000):
        a, b = values[:1000], values[1000 - shared : 2000 - shared]
        packed = [np.frombuffer(low_bits(minima(x, 512), bits), dtype="<u8").reshape(1, -1) for x in (a, b)]
        found = settings.estimate(equal_groups(*packed, bits)[0, 0])
        assert abs(found - shared / (2000 - shared)) < (0.13 if bits == 1 else 0.09)


def test_groups_of_given_documents(spark):
    texts = rows("/root/testdata/sf0.01", "documents", "doc_id", "text")
    found = near_duplicates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()
    wanted = components(texts)
    assert {r.doc_id: r.component_id for r in found} == wanted and len(found) == len(texts)
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t)) for i, t in texts}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_large_group_over_many_blocks(spark):
    texts = list(enumerate(variants(400, 130, 5, 1) + variants(60, 40, 2, 2) + ["same words as all the others"] * 300))
    found = near_duplicates(table(spark, texts).repartition(7), MinHash(block=16)).collect()
    assert {r.doc_id: r.component_id for r in found} == components(texts)
    assert similarity(shingles(texts[-1][1]), shingles(texts[-2][1])) == 1


def test_rows_grow_with_the_group(spark, monkeypatch):
    pick, texts = random.Random(5), []
    base = [f"w{pick.randrange(4000)}" for _ in range(200)]
    for n in range(1500):
        text = list(base)
        text[pick.randrange(200)] = f"x{n}"
        texts.append((n, " ".join(text)))
    dealt = []
    deal = near_dedup._in_block_pairs
    monkeypatch.setattr(near_dedup, "_in_block_pairs", lambda apart: dealt.append(deal(apart).count()) or deal(apart))
    found = near_duplicates(table(spark, texts), MinHash(block=16)).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 1500
    assert sum(dealt) <= 1500


def test_odd_rows(spark):
    long = " ".join(str(i) for i in range(60_000))
    given = [
        (5, None), (6, ""), (7, " \t\n"), (8, "Hi"), (3, "hi"), (9, "hi there"), (1, long), (2, long + " x"),
        (None, "hi"), (None, None), (20, "p q r s t u"), (20, "p q r s t u"), (21, "k l m n o"), (22, "a b c d e f g"),
        (21, "a b c d e f g"),
    ]
    documents = table(spark, given)
    for clash in ("key", "row_of_id", "component_id", "size", "block"):
        documents = documents.withColumn(clash, documents["text"])
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in near_duplicates(documents).collect())
    assert found == sorted([
        (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 1, 3, False), (3, 1, 3, True), (9, 1, 9, True),
        (1, 59_996, 1, True), (2, 59_997, 1, False), (0, 1, 0, True), (0, 0, 0, True),
        (20, 2, 20, True), (20, 2, 20, True), (21, 1, 21, True), (22, 3, 21, False), (21, 3, 21, True),
    ])
    kept = without_near_duplicates(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 1, 3, 5, 6, 7, 9, 20, 21]
    assert near_duplicates(documents.limit(0)).collect() == [] and without_near_duplicates(documents.limit(0)).collect() == []
