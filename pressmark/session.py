"""Session settings and the staging of intermediate tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", app: str = "pressmark") -> SparkSession:
    """A session for one machine: tests and the benchmark. On a cluster use the submitted one."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PRESSMARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )


# Spark gives tables of unknown size the largest number there is
_UNKNOWN = 2**60

# the tables of the job that is open in this thread or context; jobs of other threads have their own
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach: ``spark.checkpoint.dir``, else one in the session's warehouse.

    Without ``spark.checkpoint.dir``, a warehouse on local disks is an error unless the session runs on one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    scheme = spark._jvm.org.apache.hadoop.fs.Path(warehouse).getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    check_reach(spark.sparkContext.master, scheme)
    return f"{warehouse}/pressmark_stages"


def check_reach(master: str, scheme: str) -> None:
    """Raise where executors of ``master`` would each see a warehouse of their own."""
    if not master.startswith("local") and scheme == "file":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach; the warehouse is on local disks")


@contextmanager
def job(spark: SparkSession) -> Iterator[None]:
    """Remove the tables staged within, by this thread, once what is made of them has been written."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in paths:
            remove(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts lineage so that a lost executor recomputes nothing upstream, freezes
    values that depend on the physical layout, and gives the optimiser true sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (paths := _staged.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a small table whose files allow fewer tasks than there are cores.

    Tables whose files fill all cores with tasks are left as they are, so at most one task's
    input per core is ever shuffled here.
    """
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    task = int(spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    return df.repartition(cores) if _stored_bytes(df) < cores * task else df


def pack(stored: DataFrame, task_bytes: int = 16 * 2**20) -> DataFrame:
    """A stored table in no more tasks than its size asks for, for jobs that read it many times."""
    tasks = -(-_stored_bytes(stored) // task_bytes)
    return stored.coalesce(tasks) if tasks < stored.sparkSession.sparkContext.defaultParallelism else stored


def tasks_of(df: DataFrame, task_bytes: int) -> int:
    """How many tasks take no more than ``task_bytes`` each of the stored tables that ``df`` reads; one a core at least.

    A table whose size Spark does not know, such as one made of local rows, gets the session's shuffle partitions.
    """
    stored = _stored_bytes(df)
    if stored > _UNKNOWN:
        return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(-(-stored // task_bytes), df.sparkSession.sparkContext.defaultParallelism)


def _stored_bytes(df: DataFrame) -> int:
    """Size of all tables a plan reads, whole, so no estimate of what is kept of them can be too low."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder on any file system Spark can reach, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on any file system Spark can read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
