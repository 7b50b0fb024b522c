from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from brute import rows
from pyspark.sql import functions as F

from pressmark.llm import language
from pressmark.llm.language import Parse, identified, learn, letters, phrases, squeezed


def plain_phrases(text: bytes, known: bytes) -> int:
    """Longest-match phrases by substring search."""
    total = i = 0
    while i < len(text):
        n = 1
        while i + n <= len(text) and text[i : i + n] in known:
            n += 1
        i += max(1, n - 1)
        total += 1
    return total


def test_phrases_are_longest_matches():
    pick = random.Random(2)
    known = {name: "".join(pick.choices(letters, k=700)).encode() for name, letters in (("a", "abc d"), ("b", "bcdé  "), ("c", "xyz "))}
    model = learn(known)
    texts = ["".join(pick.choices("abcdéxyz, Q9", k=n)).encode() for n in (0, 1, 3, 40, 511, 512, 513, 1500, 4000)] * 3
    # one phrase longer than several windows, alone and within others, and repeats that never end a phrase early
    texts += [known["a"], b"c" + known["a"] * 4 + b"xyz" * 300, known["c"] * 5, b"ab" * 2000, ("é" * 900).encode()]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    lengths, counts = phrases(data, offsets, model)
    clean = {n: squeezed(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0].tobytes() for n, t in known.items()}
    for i, text in enumerate(texts):
        own = squeezed(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0].tobytes()
        assert lengths[i] == len(own)
        assert counts[i].tolist() == [plain_phrases(own, clean[n]) for n in model.names]


def test_a_long_match_is_one_phrase():
    known = "".join(random.Random(3).choices("abcdefgh ", k=6000)).replace("  ", " x").encode()
    model = learn({"a": known})
    part = known[700:4700].strip()
    assert phrases(np.frombuffer(part, np.uint8), np.array([0, len(part)]), model)[1].tolist() == [[1]]


@pytest.mark.parametrize("marks", [0, 2**40])
def test_languages_in_groups_of_any_size(monkeypatch, marks):
    pick = random.Random(4)
    model = learn({f"l{i}": "".join(pick.choices("abcdefghij "[i % 5 :], k=300)).encode() for i in range(9)})
    text = "".join(pick.choices("abcdefghij ", k=5000)).encode()
    wanted = phrases(np.frombuffer(text, np.uint8), np.array([0, 900, 900, len(text)]), model)
    monkeypatch.setattr(language, "_MARKS", marks)
    found = phrases(np.frombuffer(text, np.uint8), np.array([0, 900, 900, len(text)]), model)
    assert found[0].tolist() == wanted[0].tolist() and found[1].tolist() == wanted[1].tolist()


def test_stretches_are_cut_between_words():
    assert language._cut("the cats sat".encode(), 9) == b"the cats"
    assert language._cut("the cats".encode(), 8) == b"the cats"
    assert language._cut("日本語".encode(), 7) == "日本".encode()
    assert language._stretch([b"aa bb cc", b"d"], 6) == b"d\naa bb"


def test_a_short_stretch_is_no_disadvantage():
    """A phrase costs the logarithm of its stretch, so equally many phrases cost less in the shorter one."""
    model = learn({"long": b"abcdefgh" * 200, "short": b"abcdefgh"})
    assert model.bits.tolist() == [np.log2(1601), np.log2(9)]


def test_given_documents(spark):
    given = rows("/root/testdata/sf0.01", "documents", "doc_id", "lang")
    found = {r.doc_id: r for r in identified(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    assert len(found) == len(given)
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, _ in given)
    tested = [(i, lang) for i, lang in given if found[i].held_out]
    assert sum(found[i].lang_pred == lang for i, lang in tested) >= 0.99 * len(tested)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_odd_rows(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    given = [(i, f"the cat sat on the mat number{'x' * (i % 3)}", "en", "s") for i in ids[:12]]
    given += [(i, f"der Hund läuft über die Straße{'y' * (i % 3)}", "de", "s") for i in ids[12:24]]
    odd = [None, "", " 12 ++ !!", "日本語", "The cat " * 30_000, "ÜBER DIE STRASSE", "the cat", "the cat"]
    given += [(1000 + i, t, None, None) for i, t in enumerate(odd)] + [(None, "the mat", None, None)]
    table = spark.createDataFrame(given, "doc_id long, text string, lang string, source string")
    for clash in ("hash", "rank", "p", "score"):
        table = table.withColumn(clash, table["source"])
    found = {r.doc_id: r for r in identified(table).collect()}
    assert [found[1000 + i].lang_pred for i in range(len(odd))][:3] == ["und"] * 3
    assert [found[1000 + i].lang_pred for i in range(4, 8)] == ["en", "de", "en", "en"]
    assert found[1006].score == found[1007].score > 0.5 and found[None].lang_pred == "en"
    # unknown letters cost most where a phrase does
    assert found[1003].lang_pred == "en" and 0.5 < found[1003].score < 0.6
    assert identified(table.limit(0)).collect() == []
    assert {r.lang_pred for r in identified(table.where("lang is null")).collect()} == {"und"}
    assert {(r.lang_pred, r.score) for r in identified(table.where("lang = 'en'")).collect()} == {("en", 1.0)}
    try:
        identified(table, Parse(languages=1))
    except ValueError:
        return
    raise AssertionError("too many languages pass")


def test_only_letters_are_parsed(spark):
    given = ["Ça — va… «bien» 12×3", "e\u0301té’s", " .. ", "", None, "日本、語"]
    table = spark.createDataFrame([(t,) for t in given], "text string")
    found = [r.t for r in table.select(letters(F.col("text")).alias("t")).collect()]
    assert found == ["ça va bien ", "e\u0301té s", None, None, None, "日本 語"]
