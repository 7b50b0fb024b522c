from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from checks.compare import database, sorted_rows
from pressmark.llm import chats, queries, sharding, url_filter
from pressmark.llm.url_filter import Rule, Vocabulary, hits

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_agrees(spark, name):
    found = queries.QUERIES[name](spark, SMALL).toPandas().astype(object)
    wanted = database(SMALL).execute(queries.ORACLE[name]).df().astype(object)
    assert sorted(found.columns) == sorted(wanted.columns)
    assert sorted_rows(found) == sorted_rows(wanted)


URLS = [
    None, "", "no scheme casino", "http://", "https://Casino-Win.EXAMPLE.com/a?b#c", "http://x.net", "http://x.net/", "http://net/q", "http://subnet/q",
    "http://a.example.net/en/1", "http://example.net/en", "http://www.EXAMPLE.com/de/1", "http://badexample.com/de/1", "http://q.org/fr/",
    "http://q.org/FR/", "x://y://z.org/fr/1", "http://h?a/b", "http://h#a/b", "http://ok.com/free/bonus", "http://ok.com/free/free", "http://ok.com/freebonus",
    "http://ok.com/xsex", "http://ok.com/sex\nx", "http://ÄÖ.com/Ü", "http://ads-track.example.org/", "http://ok.com/" + "free-" * 20_000,
]


def judged_plainly(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.sub("[A-Z]", lambda m: m[0].lower(), re.split("[/?#]", rest)[0])
    path = re.split("[?#]", rest[len(host):])[0]
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
    low, v = (url or "").lower(), Vocabulary()
    count = [sum(bool(re.search(f"(?<![a-z0-9]){re.escape(t)}(?![a-z0-9])", low)) for t in terms) for terms in (v.strict, v.soft)]
    verdict = best[2] if best else "block" if count[0] or count[1] >= 2 else "allow"
    return host, path, best and best[0] + best[1], verdict, *count


def test_urls(spark):
    pages = spark.createDataFrame(list(enumerate(URLS * 2)), "page_id long, url string").withColumn("host", F.lit("clash"))
    found = {r.page_id: r for r in url_filter.judged(pages).collect()}
    assert len(found) == 2 * len(URLS)
    for i, url in enumerate(URLS * 2):
        r = found[i]
        assert (r.host, r.path, r.rule, r.verdict, r.strict_terms, r.soft_terms) == judged_plainly(url), url
    assert url_filter.judged(pages.limit(0)).collect() == []
    assert hits("free win", Vocabulary(strict=(), soft=())) == (0, 0)


def test_rules_of_equal_length(spark, tmp_path):
    rules = (Rule("a.net", "/", "allow"), Rule("net", "/x/", "block"), Rule("net", "/", "block"))
    pages = spark.createDataFrame([(1, "http://a.net/x/y"), (2, "http://a.net/"), (3, "http://b.net/x/")], "page_id long, url string")
    pages.write.parquet(str(tmp_path / "pages"))
    found = sorted(tuple(r) for order in (rules, rules[::-1]) for r in url_filter.judged(pages, order).collect())
    assert [r[3:5] for r in found[::2]] == [("a.net/", "allow"), ("a.net/", "allow"), ("net/x/", "block")]
    database = duckdb.connect()
    database.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages/*.parquet')")
    names = url_filter.judged(pages, rules).columns
    assert sorted(database.execute(f"SELECT {', '.join(names)} FROM ({url_filter.oracle(rules)})").fetchall()) == found[::2]


def test_turns_of_equal_number_and_role(spark, tmp_path):
    rows = [(1, 1, "user", t) for t in ("d", "a", "c", "b", None, "")] + [(2, 1, "user", t) for t in (None, "", "b")]
    rows += [(3, 1, "user", None), (4, None, None, "x"), (4, None, "user", "x"), (4, None, "user", None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table.write.parquet(str(tmp_path / "chats"))
    database = duckdb.connect()
    database.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/chats/*.parquet')")
    assert {tuple(r) for r in chats.rendered(table).collect()} == set(database.execute(chats.ORACLE).fetchall())


def test_shards(spark):
    texts = [None, "", "ä" * 9, "x" * 200_000, "same", "same"]
    given = [(i, texts[i % 6]) for i in range(3000)] + [(5, "same"), (5, "same"), (None, "n"), (None, None)]
    table = spark.createDataFrame(given, "doc_id long, text string").withColumn("shard", F.lit("clash"))
    found = sharding.assigned(table).collect()
    assert len(found) == len(given) and {r.law for r in found} == {"key"}
    data = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in given)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == data
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(24))
    assert all(r.grown_shard in (r.shard, 24) for r in found)
    moved = sum(r.grown_shard == 24 for r in found)
    assert 60 < moved < 200 and max(map(len, slots.values())) < 200
    assert sharding.assigned(table.limit(0)).collect() == []


def test_weights_and_fewer_shards(spark):
    keys = spark.range(6000)
    shares = Counter(r[0] for r in keys.select(sharding.rendezvous(F.col("id"), [1.0, 2.0, 3.0])).collect())
    assert all(abs(shares[i] - 1000 * (i + 1)) < 150 for i in range(3))
    both = keys.select(sharding.rendezvous(F.col("id"), [1.0] * 5), sharding.rendezvous(F.col("id"), [1.0] * 4)).collect()
    assert all(a == b for a, b in both if a < 4)
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("id"), [1.0, 0.0])


def plain_chats(rows):
    talks = {}
    for conv, turn, role, text in set(rows):
        if conv is not None:
            talks.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text))
    talks = {c: tuple((role if has else None, text) for _, _, has, role, text in sorted(t, key=lambda x: x[:4])) for c, t in talks.items()}
    prefixes = {t[:i] for t in talks.values() for i in range(1, len(t))}
    out = {}
    for conv in sorted(talks):
        turns = talks[conv]
        if turns not in prefixes:
            out.setdefault(turns, [conv, 0])[1] += 1
    return {
        (conv, len(turns), copies, "".join(f"<|{r if r is not None else 'unknown'}|>\n{t or ''}\n<|end|>\n" for r, t in turns))
        for turns, (conv, copies) in out.items()
    }


def test_chats(spark):
    pick, rows = random.Random(6), []
    for conv in range(400):
        start = pick.randrange(12)
        for turn in range(1 + pick.randrange(6)):
            rows.append((conv, turn * 2, ("user", "assistant")[turn % 2], f"{start if turn < 4 else conv % 7} {turn}"))
    rows += [(1000, 1, "user", "long " * 50_000), (1000, 2, "user", None), (1001, 1, "user", "long " * 50_000), (1002, None, None, None)]
    rows += [(None, 1, "user", "lost"), (1003, 1, "", ""), (1004, 1, None, ""), (1005, 5, "", None), (1006, 0, "user", "0 0")]
    rows += rows[:50]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for clash in ("n", "x", "copies", "last"):
        table = table.withColumn(clash, F.lit(1))
    found = [tuple(r) for r in chats.rendered(table).collect()]
    assert len(found) == len(set(found)) and set(found) == plain_chats(rows)
    assert chats.rendered(table.limit(0)).collect() == []
