from __future__ import annotations

import hashlib

import numpy as np
import pytest
from brute import SMALL, rows, shingles, similarity as jaccard

from pressmark.llm.fingerprints import Bins, edit_resistance, fingerprint, with_next_text

SCHEMA = "doc_id long, text string, near_next string"


def expected(pairs):
    """Edited texts by the rule, on one machine."""
    order = sorted(pairs, key=lambda p: (p[0] is None, -(p[0] or 0), p[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(text) // 3
        out.append((doc_id, text, text[: len(text) - third] + after[:third], after))
    return out


def check(found, pairs):
    made = [
        (r.doc_id or 0, r.n_chars, r.edited_sha256) for r in found
    ]
    wanted = [(i or 0, len(t), hashlib.sha256(e.encode()).hexdigest()) for i, t, e, _ in expected(pairs)]
    assert sorted(made) == sorted(wanted)


def test_given_documents(spark):
    pairs = rows(SMALL, "documents", "doc_id", "text")
    found = edit_resistance(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    check(found, pairs)
    likeness = {r.doc_id: r for r in found}
    for doc_id, text, changed, after in expected(pairs):
        row, own = likeness[doc_id], shingles(text)
        assert abs(row.near_edited - jaccard(own, shingles(changed))) < 0.17
        assert abs(row.near_next - jaccard(own, shingles(after))) < 0.17
    errors = [likeness[i].near_edited - jaccard(shingles(t), shingles(c)) for i, t, c, _ in expected(pairs)]
    assert abs(np.mean(errors)) < 0.01


def test_odd_rows(spark):
    pairs = [(9, None), (7, ""), (7, "b c"), (7, "b c"), (5, "ä𝄞" * 50), (1, "word " * 100_000), (None, "x y z"), (3, "b c")]
    given = spark.createDataFrame([(i, t, t) for i, t in pairs], SCHEMA)
    found = edit_resistance(given).collect()
    check(found, pairs)
    equal = {(r.fingerprint, r.n_chars) for r in found if r.n_chars == 3}
    assert len(equal) == 1
    assert {r.fingerprint for r in found if r.n_chars == 0} == {""}
    assert [r.near_next for r in found if r.doc_id == 9] == [1.0]
    assert edit_resistance(given.limit(0)).collect() == []
    assert [r.near_next for r in edit_resistance(given.limit(1)).collect()] == [1.0]


@pytest.mark.parametrize("ranges", [2, 5, 40])
def test_next_row_over_any_ranges(spark, ranges):
    pairs = [(i * i % 1009 * 10**12, f"t{i}") for i in range(500)]
    given = spark.createDataFrame([(i, t, t) for i, t in pairs], SCHEMA).repartition(6)
    found = {(r.doc_id, r.text, r.next_text) for r in with_next_text(given, [], ranges).collect()}
    order = sorted(pairs, key=lambda p: (-p[0], p[1]))
    assert found == {(i, t, order[(n + 1) % 500][1]) for n, (i, t) in enumerate(order)}


@pytest.mark.parametrize("bits", [1, 2, 4, 8])
def test_bias_is_corrected(bits):
    bins, pick, seen = Bins(512, bits), np.random.default_rng(1), []
    for shared in (0, 300, 600, 900):
        for size in (1000, 40):
            a = pick.integers(0, 2**63, size).astype(np.uint64)
            b = np.concatenate((a[: shared * size // 1000], pick.integers(0, 2**63, size - shared * size // 1000).astype(np.uint64)))
            x, y = (np.unpackbits(np.frombuffer(fingerprint(v, bins), np.uint8), bitorder="little").reshape(512, bits) for v in (a, b))
            equal = (x == y).all(axis=1).mean()
            kept = shared * size // 1000
            seen.append((equal - 0.5**bits) / (1 - 0.5**bits) - kept / (2 * size - kept))
    assert max(map(abs, seen)) < 0.2 and abs(np.mean(seen)) < 0.08
