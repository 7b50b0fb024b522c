from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from brute import rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pressmark.llm import alignment as al
from pressmark.llm.bpe import byte_characters

FILES = al.Tokenizers(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
ODD = [
    None, "", " ", "  ", "\n\n \t x", "a  b", "x ", " x", "\x00z q", "▁ a", "ﬁ é 日本 語 日本語です 👩‍👩‍👧 🏳️‍🌈", "<|endoftext|> <s> <unk>",
    "a" * 3000, "é‍​ ̈ x", "a b　c d", "x\x1cy z\x85 w", "don't I'LL", "👩‍" * 600, "one two", "one two", "-- \n -- " * 40,
]


class Plain:
    """The definition, text by text and byte by byte."""

    def __init__(self):
        self.a = Tokenizer.from_file(FILES.a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=FILES.b_path)
        self.byte = {c: b for b, c in enumerate(byte_characters())}

    def a_bytes(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        spelt_a, spelt_b = [self.a_bytes(i) for i in a], [self.b_bytes(i) for i in b]
        if not b"".join(spelt_a) == b"".join(spelt_b) == (" " + text).encode():
            return []
        made, own_a, own_b, at_a, at_b = [], [], [], 0, 0
        left = list(zip(b, spelt_b))[::-1]
        for i, data in zip(a, spelt_a):
            own_a.append(i)
            at_a += len(data)
            while left and at_b + len(left[-1][1]) <= at_a:
                j, spelt = left.pop()
                own_b.append(j)
                at_b += len(spelt)
            if at_a == at_b:
                made.append((own_a, own_b))
                own_a, own_b = [], []
        return made

    def rows(self, texts):
        groups = [self.groups(t) for t in texts]
        links = [[(x, y) for a, b in own for x in a for y in b] for own in groups]
        counts = Counter(pair for own in links for pair in set(own))
        most = {}
        for (x, _), n in counts.items():
            most[x] = max(most.get(x, 0), n)
        for own, pairs in zip(groups, links):
            written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
            yield (
                sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(pairs),
                sum(counts[p] == most[p[0]] for p in pairs), sum(counts[p] for p in pairs),
                hashlib.sha256(written.encode()).hexdigest() if own else "",
            )


@pytest.fixture(scope="module")
def texts():
    return ODD + [t for _, t in rows("/root/testdata/sf0.001", "documents", "doc_id", "text")]


@pytest.fixture(scope="module")
def plain():
    return Plain()


def found(table):
    wanted = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return [tuple(r) for r in table.select(*wanted).collect()]


def test_links_and_counts(spark, texts, plain):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    clash = table.withColumns({c: F.lit("x") for c in ("row", "pairs", "times", "docs", "best", "n_a")})
    got = sorted(found(al.linked(clash, FILES)))
    assert got == [(i, *r) for i, r in enumerate(plain.rows(texts))]


def test_rare_pairs_are_joined_by_shuffle(spark, texts, plain, monkeypatch):
    monkeypatch.setattr(al, "_FREQUENT_PAIRS", 500)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(found(al.linked(table, FILES))) == [(i, *r) for i, r in enumerate(plain.rows(texts))]


def test_repeated_and_missing_ids(spark, plain):
    texts = ["one two three", "one two three", "one", None, "four"]
    table = spark.createDataFrame(list(zip([7, 7, None, None, 7], texts)), "doc_id long, text string")
    wanted = [(i, *r) for i, r in zip([7, 7, None, None, 7], plain.rows(texts))]
    assert sorted(found(al.linked(table, FILES)), key=str) == sorted(wanted, key=str)
    assert found(al.linked(table.limit(0), FILES)) == []
    assert found(al.linked(table.where("text is null"), FILES)) == [(None, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.parametrize("stretch, block, lane, small", [(50, 200, 8, 2), (1, 1, 1, 1), (1 << 20, 1 << 22, 1 << 30, 1 << 30)])
def test_stretches_lanes_and_blocks_change_nothing(texts, plain, monkeypatch, stretch, block, lane, small):
    for name, value in (("STRETCH", stretch), ("BLOCK", block), ("LANE", lane), ("_SMALL_GROUP", small)):
        monkeypatch.setattr(al, name, value)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    got = [r for part in al._aligned(iter([batch]), FILES) for r in part.to_pylist()]
    size = FILES.b_size()
    for row, wanted, text in zip(got, plain.rows(texts), texts, strict=True):
        assert (row["n_a"], row["n_b"], row["n_groups"], row["n_links"], row["groups_sha256"]) == wanted[:4] + wanted[6:], text
        links = Counter(x * size + y for a, b in plain.groups(text) for x in a for y in b)
        assert dict(zip(row["pairs"], row["times"])) == links and len(row["pairs"]) == len(links)


def test_a_full_store_of_words_is_emptied(monkeypatch, plain):
    monkeypatch.setattr(al, "_KEPT_WORDS", 2)
    coder = al.Encoders(FILES)
    for text in ("one two three four", "five six", "one seven"):
        groups, spelt = al.align([text], coder)
        assert spelt.all() and len(groups.a_first) == len(plain.groups(text))
        assert len(coder.words) <= 6


def test_groups_as_rows(spark, texts, plain):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in al.token_groups(table, FILES).collect():
        text = texts[row.doc_id]
        assert [(g.a, g.b) for g in row.groups] == plain.groups(text)
        if row.groups:
            assert row.groups[-1].end == len(text.encode()) + 1


def test_words_of_the_block_at_hand_stay_known(monkeypatch, plain):
    monkeypatch.setattr(al, "_KEPT_WORDS", 2)
    coder = al.Encoders(FILES)
    al.align(["one two three four"], coder)
    met, encoded = [], coder._encoded
    monkeypatch.setattr(coder, "_encoded", lambda new: met.extend(new) or encoded(new))
    groups, spelt = al.align(["four five one"], coder)
    assert met == ["five"] and set(coder.words) == {"one", "four", "five"} and spelt.all()
    assert groups.a.tolist() == [i for a, _ in plain.groups("four five one") for i in a]


def test_words_that_one_side_does_not_spell():
    words, tokens = [b" ab", b" c", b" de", b" f", b" xy"], [b" a", b"b", b" C", b" d", b"e", b" ff"]
    assert al._spelt(words, [0, 1, 2, 3, 4, 5], [2, 3, 5, 6, 6], tokens).tolist() == [True, False, True, False, False]
