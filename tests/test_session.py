from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from pressmark.session import check_reach, job, pack, path_exists, shared_dir, spread, stage


def test_spread_only_small_tables(spark, monkeypatch, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t")).select((F.col("id") + 1).alias("n"))
    assert spread(table).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr("pressmark.session._stored_bytes", lambda df: 10**15)
    assert spread(table) is table and pack(table) is table


def test_stage_keeps_rows_in_the_shared_folder(spark):
    stored = stage(spark.range(10).repartition(4), "numbers")
    assert {r["id"] for r in stored.collect()} == set(range(10))
    assert pack(stored).rdd.getNumPartitions() == 1
    where = stored.inputFiles()[0].removeprefix("file:").removeprefix("//")
    assert shared_dir(spark).removeprefix("file:").rstrip("/") in where
    assert path_exists(spark, where) and not path_exists(spark, where + "x")


def test_a_job_removes_what_it_staged(spark):
    with job(spark):
        where = stage(spark.range(10), "numbers").inputFiles()[0].removeprefix("file:").removeprefix("//")
        assert path_exists(spark, where)
    assert not path_exists(spark, where)


def test_jobs_of_threads_keep_their_own_tables(spark):
    ready, done, found = threading.Event(), threading.Event(), []

    def other():
        with job(spark):
            kept = stage(spark.range(3), "other")
            ready.set()
            done.wait(60)
            found.append(kept.count())

    thread = threading.Thread(target=other)
    with job(spark):
        stage(spark.range(2), "own")
        thread.start()
        assert ready.wait(60)
    done.set()
    thread.join()
    assert found == [3]


def test_local_folders_are_no_shared_ones():
    for master, scheme in (("local[2]", "file"), ("yarn", "hdfs"), ("spark://h:7077", "s3a")):
        check_reach(master, scheme)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        check_reach("spark://h:7077", "file")
