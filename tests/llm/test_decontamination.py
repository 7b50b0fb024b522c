from __future__ import annotations

import itertools
import random

import pytest
from brute import SMALL, rows, words
from pyspark.sql import functions as F

from pressmark.llm import decontamination
from pressmark.llm.decontamination import Seeds, decontaminated, judged


def plain_leaks(own: list[str], item: list[str], seeds: Seeds = Seeds()) -> bool:
    """Every alignment, every window that holds a seed where a mask's words agree; short items whole."""
    size, span = seeds.window, seeds.span
    if len(item) < span:
        return len(item) >= seeds.shortest and any(own[i : i + len(item)] == item for i in range(len(own)))
    for shift in range(-len(item), len(own)):
        same = {i for i in range(len(item)) if 0 <= i + shift < len(own) and own[i + shift] == item[i]}
        for at in range(max(0, -shift), min(len(item) - span, len(own) - span - shift) + 1):
            if any(all(at + i in same for i, c in enumerate(m) if c == "1") for m in seeds.masks):
                for first in range(at + span - size, at + 1):
                    if 100 * sum(i in same for i in range(first, first + size)) >= seeds.percent * min(size, len(item)):
                        return True
    return False


def test_every_window_with_two_replaced_words_holds_a_seed():
    seeds = Seeds()
    for replaced in itertools.combinations(range(seeds.window), 2):
        assert any(
            not any(at + i in replaced for i, c in enumerate(mask) if c == "1")
            for mask in seeds.masks for at in range(seeds.window - seeds.span + 1)
        )


def test_given_documents(spark):
    documents, items = rows(SMALL, "documents", "doc_id", "text"), rows(SMALL, "benchmark", "item_id", "text")
    items = [(i, words(t)) for i, t in items]
    grams = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in items}
    wanted = {}
    for doc_id, text in documents:
        own = words(text)
        # eleven of thirteen equal words hold a run of four; only such pairs are tried in full
        runs = {tuple(own[j : j + 4]) for j in range(len(own) - 3)}
        near = [i for i, w in items if runs & {g[:4] for g in grams[i]} | runs & {g[1:] for g in grams[i]}]
        wanted[doc_id] = ",".join(str(i) for i in sorted(near) if plain_leaks(own, dict(items)[i]))
    found = judged(spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect()
    assert {r.doc_id: r.items for r in found} == wanted and len(found) == len(documents)
    assert sum(map(bool, wanted.values())) > 0


@pytest.mark.parametrize("rows_to_broadcast", [1_000_000, 0])
def test_planted_passages(spark, rows_to_broadcast):
    pick = random.Random(3)
    words_ = [f"v{i}" for i in range(60)]
    items = [(i, [pick.choice(words_) for _ in range(pick.choice([4, 8, 10, 13, 25, 40]))]) for i in range(30)]
    documents = []
    for n in range(200):
        own = [pick.choice(words_) for _ in range(pick.randrange(60))]
        if n % 2:
            item = list(pick.choice(items)[1])
            for _ in range(pick.randrange(4)):
                item[pick.randrange(len(item))] = "other"
            cut = pick.randrange(3)
            own[len(own) // 2 : len(own) // 2] = item[cut : len(item) - pick.randrange(3)]
        documents.append((n, own))
    seeds = Seeds(broadcast_rows=rows_to_broadcast)
    wanted = {n: ",".join(str(i) for i, w in items if plain_leaks(own, w)) for n, own in documents}
    docs = spark.createDataFrame([(n, "\n ".join(o).upper()) for n, o in documents], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    assert {r.doc_id: r.items for r in judged(docs, bench, seeds).collect()} == wanted
    assert 30 < sum(map(bool, wanted.values())) < 150


@pytest.mark.parametrize("rows_to_broadcast", [1_000_000, 0])
def test_short_items(spark, rows_to_broadcast):
    docs = [(1, "the capital of the land of Zog"), (2, "capital of the land of Zog lies"), (3, "capital of the land of"),
            (4, "capital of the land in Zog"), (5, "of Zog"), (6, None), (7, "a b\nc D"), (8, "a b c")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(1, "Capital of the land of Zog"), (2, "of Zog"), (3, "A b c d"), (4, "a b c")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: r["items"] for r in judged(docs, bench, Seeds(broadcast_rows=rows_to_broadcast)).collect()}
    assert found == {1: "1", 2: "1", 3: "", 4: "", 5: "", 6: "", 7: "3", 8: ""}
    assert {r.doc_id for r in judged(docs, bench, Seeds(shortest=2)).where("contaminated").collect()} == {1, 2, 5, 7, 8}


@pytest.mark.parametrize("seeds", [Seeds(), Seeds(broadcast_rows=0), Seeds(broadcast_bytes=10)])
def test_odd_rows(spark, seeds):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    given = [
        (1, None), (2, ""), (3, "  \n"), (4, passage), (5, "x " * 60_000 + passage + " y" * 60_000), (6, passage[:40]), (7, "clean"),
        (7, passage), (None, passage), (None, "clean"), (8, passage.replace("five", "5").replace("ten", "10")), (9, "one two three"),
        *[(10, passage)] * 50, *[(11, "clean " * 30)] * 50,
    ]
    docs = spark.createDataFrame(given, "doc_id long, text string")
    for clash in ("item_id", "seed", "words", "place", "leaked_doc_id", "items"):
        docs = docs.withColumn(clash, F.lit("x"))
    items = [(70, passage), (70, passage), (71, passage), (72, None), (None, passage), (73, ""), (74, "one two three"), (75, "clean")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    found = judged(docs, bench, seeds).collect()
    dirty = {4, 5, 7, 8, 10, None}
    assert len(found) == len(given) and all(r.contaminated == (r.doc_id in dirty) for r in found)
    assert {r.items for r in found if r.contaminated} == {"70,71"} and {r.n_items for r in found} == {0, 2}
    kept = decontaminated(docs, bench, seeds)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 6, 9, *[11] * 50]
    assert decontaminated(docs, bench.limit(0), seeds).count() == len(given)
    assert judged(docs.limit(0), bench, seeds).collect() == []
    plan = decontamination.leaks(docs, bench, seeds)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
