from __future__ import annotations

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from brute import rows
from pyspark.sql import functions as F

from pressmark.llm import bpe

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def wanted():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = [
    None, "", " ", "\n\n \t x", "don't I'LL we've", "naïve café 东京 日本語です", "👩‍👩‍👧 🏳️‍🌈", "a\u0000b\u001c\u001d\u001e\u001f\u0085c", "   x　",
    "<|endoftext|>", "x" * 3000, "aaaaaaaaab" * 500, "٣٤٥ ½ Ⅷ", "é‍​", "   lead and trail   ", "1234567890" * 9, "�﻿",
]


def test_ids_are_those_of_the_rank_encoder(spark, wanted):
    pick = random.Random(5)
    alphabet = "aebtion  nthgüßéñ.,'!\n\t0123€日𝄞́"
    made = ["".join(pick.choices(alphabet, k=pick.randrange(200))) for _ in range(500)]
    texts = ODD + made + [t for _, t in rows("/root/testdata/sf0.01", "documents", "doc_id", "text")]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("ids", F.lit("clash"))
    found = {r.doc_id: r for r in bpe.round_trip(table, RANKS, PATTERN).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        ids = wanted.encode_ordinary(text or "")
        assert found[i].n_tokens == len(ids), repr(text)
        assert found[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), repr(text)
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(table.limit(0), RANKS, PATTERN).collect() == []


def test_columns_and_offsets(spark, wanted):
    table = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    ids = table.withColumn("ids", bpe.encode(F.col("text"), RANKS, PATTERN))
    full = ids.withColumns({
        "data": bpe.decode(F.col("ids"), RANKS, PATTERN),
        "bounds": bpe.with_offsets(F.col("text"), F.col("ids"), RANKS, PATTERN),
    }).collect()
    for row in full:
        text = row.text or ""
        assert bytes(row.data).decode() == text and row.ids == wanted.encode_ordinary(text)
        assert len(row.bounds) == len(row.ids)
        for i, (begin, end) in zip(row.ids, row.bounds):
            assert wanted.decode_single_token_bytes(i) in text[begin:end].encode()
            assert end > begin
        if text:
            assert row.bounds[0].begin == 0 and row.bounds[-1].end == len(text)
    nothing = spark.createDataFrame([(None,), ([],), ([None, 99_999_999],)], "ids array<int>")
    assert [r[0] for r in nothing.select(bpe.decode(F.col("ids"), RANKS, PATTERN)).collect()] == [None, b"", b""]


def test_offsets_of_unknown_ids():
    coder = bpe.ByteBpe(RANKS, PATTERN)
    ((first, *rest),) = coder.encode(["hello wörld"])
    known = coder.offsets("hello wörld", [first, *rest])
    found = coder.offsets("hello wörld", [None, first, 99_999_999, *rest, None])
    assert [found[1], *found[3:-1]] == known
    assert found[0] == (0, 0) and found[2] == (known[0][1],) * 2 and found[-1] == (11, 11)
    assert coder.offsets("", [first, None]) == [(0, 0), (0, 0)] and coder.offsets("he", [first, first])[1] == (2, 2)


def test_split_characters():
    coder = bpe.ByteBpe(RANKS, PATTERN)
    text = "日本 👩‍👩‍👧 naïve 𝄞"
    (ids,) = coder.encode([text])
    assert "".join(coder.decode_text([i] for i in ids)) == text
    assert list(coder.decode_text([[coder.library.token_to_id(bpe.byte_characters()[0xE6])]])) == ["", "�"]
    assert sorted(map(ord, bpe.byte_characters()))[-1] == 323 and len(set(bpe.byte_characters())) == 256


def test_a_full_store_of_pieces_is_emptied(monkeypatch, wanted):
    monkeypatch.setattr(bpe, "_CACHED", 5)
    texts = ["one two three", "four five six seven eight nine", "one two"]
    assert list(bpe.ByteBpe(RANKS, PATTERN).encode(texts)) == [wanted.encode_ordinary(t) for t in texts]


def test_pieces_met_again_stay_known(monkeypatch):
    monkeypatch.setattr(bpe, "_CACHED", 4)
    own = bpe.ByteBpe(RANKS, PATTERN)
    first = list(own.encode(["the"]))
    for i in range(50):
        assert list(own.encode([f"the {chr(97 + i % 26)}{i}x"])) and list(own.encode(["the"])) == first
        assert len(own.known) + len(own.older) <= 30
