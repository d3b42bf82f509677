"""Micro-batches as folders: written aside, then shown by one rename.

A folder `batch=N` appears whole or not at all, and only once: a repeated batch finds its
folder and is done. So a stream may read the parent folder while another query writes it.
A rename must be atomic, as in HDFS and on local disks.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(number: int) -> str:
    return f"{BATCH}={number:012d}"


def hadoop(spark: SparkSession, path: str):
    """The file system of a path and the path as its object."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def globbed(spark: SparkSession, pattern: str) -> list[str]:
    fs, at = hadoop(spark, pattern)
    return [s.getPath().toString() for s in fs.globStatus(at) or []]


@contextmanager
def no_shuffles_left(spark: SparkSession) -> Iterator[None]:
    """What is written meanwhile drops its own shuffle files when it is done."""
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def drop_shuffles(batch: DataFrame) -> None:
    """Drop the shuffle files that a stored micro-batch was made of.

    Spark drops them when the driver's garbage is collected. A driver makes little of it, so the
    shuffles of all batches so far would lie on the executors' disks at once.
    """
    made = batch._jdf.queryExecution().toRdd()
    made.getNumPartitions()  # now it knows what it depends on
    made.cleanShuffleDependencies(False)


def collect_garbage(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of jobs that have ended."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def commit(rows: DataFrame, path: str, number: int, partition_by: list[str] | None = None) -> None:
    """Store one batch below `path`, unless it is there."""
    spark = rows.sparkSession
    fs, final = hadoop(spark, f"{path}/{folder(number)}")
    if fs.exists(final):
        return
    aside = f"{path}/_aside/{folder(number)}"
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    with no_shuffles_left(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(aside)
    _, source = hadoop(spark, aside)
    if not fs.rename(source, final):
        raise OSError(f"cannot move {aside} to {final}")


def land(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    partition_by: list[str] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append a stream batch by batch; `finish` turns the rows of a batch into what is stored."""

    def store(batch: DataFrame, number: int) -> None:
        commit(finish(batch) if finish else batch, path, number, partition_by)
        drop_shuffles(batch)

    return (
        rows.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )
