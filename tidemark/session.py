"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark. On a cluster the deployer makes the session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(folder)
    return shared_folder(spark)


# Folders below the shared one that this process has named and not freed.
_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; every call gives another one."""
    _SCRATCH.append(f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}")
    return f"{_SCRATCH[-1]}/{name}"


def free_scratch(spark: SparkSession) -> int:
    """Delete the tables that operators have left in the shared folder, and give their number. For when results are
    written elsewhere: those that still read such a table can no longer be computed."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    freed = 0
    while _SCRATCH:
        path = hadoop.Path(_SCRATCH.pop())
        freed += path.getFileSystem(conf).delete(path, True)
    return freed


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs have left: broadcasts and job data on the driver, shuffle files on the executors.

    Spark's cleaner learns that a broadcast or a shuffle is not used any more from a garbage collection of the driver, which
    comes only when its heap is full or after ``spark.cleaner.periodicGC.interval``. For operators of many small jobs.
    """
    gc.collect()  # of the Python side's references to Java objects
    spark.sparkContext._jvm.System.gc()


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the jobs inside; afterwards it is as before."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def settle(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage, survives lost executors, and lets Spark plan the following joins by the real
    size of the table.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_parallel(work: Callable, items: Sequence, threads: int) -> list:
    """Run independent Spark jobs from several threads of the driver; results in the order of items."""
    if threads <= 1 or len(items) <= 1:
        return [work(item) for item in items]
    spark = SparkSession.getActiveSession()
    pool = ThreadPool(min(threads, len(items)))
    try:
        return pool.map(inheritable_thread_target(spark)(work), items, chunksize=1)
    finally:
        pool.close()
