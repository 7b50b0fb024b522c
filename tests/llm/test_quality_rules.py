from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from pressmark.llm import quality_rules as qr, words

SF = "/root/testdata/sf0.01"


def plain(text):
    """The measurements, by the definition."""
    text = text or ""
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    times = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (
        len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered),
        sum(bool(re.search(r"[A-Za-z\x80-\U0010FFFF]", w)) for w in found),
    )


ODD = [
    None, "", " \n\t ", "a a a a", "a a a", "a b c a b c", "A b c a b c", "x\n\n x\nx\nx \n", "é日本 1 2 # $% &|<>*", "w " * 49, "w " * 50,
    "\x0b\x0c\r", "a\x1cb \x85 c", "1 2 3 4 5", "l\r\nl\r\nl", "one two three " * 30, " ".join(f"w{i}" for i in range(60)),
]


def made():
    pick = random.Random(3)
    return ODD + ["".join(pick.choices("ab c\n\té#1 ", k=pick.randrange(120))) for _ in range(600)]


def rows(frame):
    return [tuple(r) for r in frame.select("doc_id", *qr.MEASUREMENTS, "failures").orderBy("doc_id").collect()]


def test_measurements_and_bits(spark):
    texts = made()
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = table.withColumns({c: F.lit("x") for c in ("_m", "failures", "n_words", "kept")})
    for got, text in zip(rows(qr.ledger(table)), texts, strict=True):
        assert got[1:-1] == plain(text), repr(text)
        values = dict(zip(qr.MEASUREMENTS, got[1:-1]))
        bits = sum(1 << i for i, rule in enumerate(qr.RULES) if eval(rule.fails.replace("=", "=="), {}, values))
        assert got[-1] == bits, repr(text)
    assert rows(qr.ledger(table.limit(0))) == []


def test_long_texts_in_parts(monkeypatch):
    texts = pa.array(made() + ["word and word " * 3000, "y" * 9000])
    whole = [r for part in qr.measure(texts) for r in part.tolist()]
    monkeypatch.setattr(words, "_CHUNK", 50)
    column = [r for part in qr.measure(texts) for r in part.tolist()]
    assert column == whole
    data, offsets = next((d, o) for _, d, o in words.row_chunks(texts, 1 << 30))
    cut = words.word_hashes(data, offsets)
    monkeypatch.setattr(words, "_CHUNK", 1 << 30)
    plain_run = words.word_hashes(data, offsets)
    assert all((a == b).all() for a, b in zip(cut, plain_run))


def test_one_text_of_30_megabytes():
    text = "lorem ipsum dolor sit amet, consectetur #1 adipiscing\n" * 560_000
    (row,) = [r for part in qr.measure(pa.array([text])) for r in part.tolist()]
    assert row == [8 * 560_000, 46 * 560_000, 560_000, 560_000, 559_999, 8 * 560_000, 7 * 560_000]


def test_policies_and_ablations(spark):
    rng = random.Random(8)
    bits = [rng.choice([0, 0, 1, 2, 4, 5, 32, 33, 64, 96, 255]) for _ in range(500)]
    ledger = spark.createDataFrame([(i, b) for i, b in enumerate(bits)], "doc_id long, failures long")
    some = qr.Policy("some", 3, ("few_words", "symbols", "repeated_lines"), allowed=1, always=("repeated_words",))
    policies = [qr.STRICT, qr.LENIENT, some]

    def keeps(b, policy, without=None):
        names = [r.name for i, r in enumerate(qr.RULES) if b >> i & 1 and r.name != without]
        return not set(names) & set(policy.always) and len(set(names) & set(policy.rules)) <= policy.allowed

    found = {(r.policy, r.version, r.rule): r for r in qr.ablations(ledger, policies).collect()}
    assert len(found) == sum(len(p.rules) for p in policies)
    for policy in policies:
        for name in policy.rules:
            row, bit = found[policy.name, policy.version, name], qr.mask_of([name])
            own = qr.mask_of({*policy.rules, *policy.always})
            assert row.documents == 500 and row.kept == sum(keeps(b, policy) for b in bits)
            assert row.failed == sum(bool(b & bit) for b in bits)
            assert row.only == sum(not keeps(b, policy) and b & own == bit for b in bits)
            assert row["without"] == sum(keeps(b, policy, name) for b in bits)
    kept = ledger.select(*[qr.keeps(F.col("failures"), p).alias(str(p.version)) for p in policies], "failures").collect()
    assert all(r[str(p.version)] == keeps(r.failures, p) for r in kept for p in policies)


def test_sql_and_labels(spark):
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    judged = qr.judged(spark.read.parquet(f"{SF}/documents.parquet"))
    wanted = base.execute(f"SELECT {', '.join(judged.columns)} FROM ({qr.oracle()})").fetchall()
    assert sorted(tuple(r) for r in judged.collect()) == sorted(wanted)
    good = judged.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("quality = 1 and not base_failed")
    assert good.where("not kept").count() == 0
