from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressmark.operators import shards
from pressmark.operators.folds import assign_folds, fold_sizes, held_out_rows, position_slice, training_rows
from pressmark.operators.order import assign_ids, with_position
from pressmark.sinks import templates, writers


def sequential(sizes, limit, header):
    """The rule as it is told: close a file before an item once it is over the limit."""
    size, number, numbers = header, 0, []
    for item in sizes:
        if size > limit:
            number, size = number + 1, header
        numbers.append(number)
        size += item
    return numbers, size, number


def test_composition_equals_the_sequential_rule():
    pick = random.Random(1)
    for _ in range(1500):
        sizes = [pick.randint(1, 50) for _ in range(pick.randint(1, 60))]
        header, limit = pick.randint(1, 20), pick.randint(5, 150)
        whole, at = None, 0
        while at < len(sizes):
            step = pick.randint(1, 15)
            part = shards._steps_of(shards._chunk(np.array(sizes[at:at + step]), limit, header), limit, header)
            whole = part if whole is None else shards._compose(whole, part)
            at += step
        assert shards._apply(whole, header) == sequential(sizes, limit, header)[1:]


@pytest.fixture(scope="module")
def sized(spark):
    pick = random.Random(2)
    sizes = [pick.randint(1, 5000) for _ in range(900)]
    frame = spark.createDataFrame([(f"k{i:05d}", b) for i, b in enumerate(sizes)], "url string, bytes long")
    return sizes, frame.repartition(7)


def test_positions_and_sums_before(sized):
    sizes, frame = sized
    found = with_position(frame, "url", weight="bytes").orderBy("position").collect()
    assert [r["position"] for r in found] == list(range(len(sizes)))
    assert [r["url"] for r in found] == sorted(r["url"] for r in found)
    assert [r["before"] for r in found] == [sum(sizes[:i]) for i in range(len(sizes))]


@pytest.mark.parametrize("chunk_rows, fan_in", [(50_000, 256), (40, 256), (13, 3)])
def test_shards_for_any_chunking(sized, chunk_rows, fan_in):
    sizes, frame = sized
    found = shards.assign_shards(with_position(frame, "url"), 20_000, 300, chunk_rows, fan_in)
    found = found.orderBy("position").collect()
    assert [r["file_no"] for r in found] == sequential(sizes, 20_000, 300)[0]
    assert [r["url"] for r in found] == sorted(r["url"] for r in found)


def test_no_items(spark):
    empty = spark.createDataFrame([], "url string, position long, bytes long")
    assert shards.assign_shards(empty, 100, 10).count() == 0


def test_import_files(spark):
    made = [(f"u{i}", i, f"<item>{i}</item>\n" * 3) for i in range(20)]
    items = spark.createDataFrame(made, "url string, position long, item string")
    items = items.withColumn("bytes", F.octet_length("item").cast("long"))
    limit = writers.HEADER_BYTES + 150
    files = writers.import_files(items, limit).orderBy("file_no").collect()
    bodies = [f["content"].removeprefix(templates.IMPORT_HEADER).removesuffix(templates.IMPORT_FOOTER) for f in files]
    assert "".join(bodies) == "".join(item for _, _, item in made)
    assert [f["file_name"] for f in files] == [f"import-{i}.xml" for i in range(len(files))]
    assert len(files) > 3
    assert all(writers.HEADER_BYTES + len(b) > limit for b in bodies[:-1])


def test_ids_are_dense(spark):
    made = [("b", 2), ("a", 0), ("c", 1), ("d", 3)]
    frame = spark.createDataFrame(made, "url string, n int")
    image = F.transform(F.when(F.col("n") > 0, F.sequence(F.lit(1), F.col("n"))).otherwise(F.array().cast("array<int>")),
                        lambda i: F.struct(i.cast("string").alias("image_url")))
    found = assign_ids(frame.withColumn("images", image), start_index=10).orderBy("url").collect()
    ids = [[*[i["image_id"] for i in r["images"]], r["post_id"]] for r in found]
    assert ids == [[11], [12, 13, 14], [15, 16], [17, 18, 19, 20]]


def test_folds(spark):
    frame = spark.range(100, 123).withColumnRenamed("id", "doc_id").repartition(5)
    for seed in (None, 3):
        rows = assign_folds(frame, 4, seed=seed).cache()
        by_fold = {f: {r["doc_id"] for r in held_out_rows(rows, f).collect()} for f in range(4)}
        assert all(len(ids) == 5 for ids in by_fold.values())
        assert len(set().union(*by_fold.values())) == 20
        assert training_rows(rows, 0).count() == 18
        assert rows.where("fold = 4").count() == 3
    inside, outside = position_slice(assign_folds(frame, 4), 2, 6)
    assert {r["doc_id"] for r in inside.collect()} == {102, 103, 104, 105} and outside.count() == 19
    assert tuple(fold_sizes(frame, 4).first()) == (23, 5, 3)
    assert assign_folds(frame, 50).select("fold").distinct().collect()[0]["fold"] == 50
