"""Session settings the warehouse relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings: safe to apply to a session somebody else has started.
RUNTIME = {
    # Re-plan from real sizes: coalesce small partitions, split hot ones, and
    # switch to a broadcast only when a side turns out to be small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange above it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join on more keys goes on with rows that are dealt by one of them.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Hash instead of sort where every partition of the smaller side is small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Keep set-valued aggregates (windows per user and day) hashed, not sorted.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
    # Upserts of summary tables touch only the partitions they carry.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

STREAMING = {
    # Keyed state beyond the heap, incremental checkpoints to the shared folder.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Rows wait in the state and in its changelogs, which nobody reads again but to recover.
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    # One store for each task of a join, not four to open and commit in every micro-batch. A
    # checkpoint keeps the form that it began with.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    # No read before every write and removal, which only counts the rows of the state.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    # Several watermarked inputs: wait for the slowest one.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def tune(spark: SparkSession, time_zone: str | None = None) -> SparkSession:
    """Apply the runtime settings; `time_zone` decides where a day begins."""
    for key, value in {**RUNTIME, **STREAMING}.items():
        spark.conf.set(key, value)
    if time_zone:
        spark.conf.set("spark.sql.session.timeZone", time_zone)
    return spark


def tuned(spark: SparkSession, time_zone: str) -> SparkSession:
    """A session beside the caller's with the runtime settings; the caller's stays as it is."""
    beside = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"):
        beside.conf.set(key, spark.conf.get(key))
    return tune(beside, time_zone)


def build_session(app: str = "tidewell", time_zone: str = "Asia/Shanghai", **conf: str) -> SparkSession:
    """Start (or reuse) a session with the warehouse's settings."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**RUNTIME, **STREAMING, **conf}.items():
        builder = builder.config(key, value)
    return builder.config("spark.sql.session.timeZone", time_zone).getOrCreate()
