"""The dimension configuration as versioned snapshots.

A snapshot holds the latest change of each source table. It is advanced by the changes that
the log has got since, so a micro-batch reads a few rows and not the whole log.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import dims
from tidewell.schemas import DIM_CONFIG_CHANGE
from tidewell.sinks.batches import BATCH, commit, globbed, hadoop


@dataclass(frozen=True)
class ConfigSnapshots:
    """Snapshots below `path`, numbered by the micro-batch that made them."""

    path: str
    keep: int = 2  # older ones go; a plan of an earlier batch may still read the last but one

    def _found(self, spark: SparkSession) -> list[str]:
        done = globbed(spark, f"{self.path}/{BATCH}=*/_SUCCESS")
        return sorted(p.rpartition("/")[0] for p in done)

    def newest(self, spark: SparkSession) -> DataFrame:
        """The latest change of each source table, as far as a snapshot holds it."""
        found = self._found(spark)
        if not found:
            return spark.createDataFrame([], DIM_CONFIG_CHANGE)
        return spark.read.schema(DIM_CONFIG_CHANGE).parquet(found[-1])

    def advance(
        self, log: DataFrame, number: int, changed: Callable[[DataFrame], None] | None = None
    ) -> DataFrame:
        """The snapshot after the changes in `log` that it does not hold yet.

        `log` grows at its end: later changes have a greater `seq`, and the filter on it reaches the
        files. `changed` gets the entries that are new, before the snapshot that holds
        them appears: a micro-batch that failed in between hands them over again.
        """
        spark = log.sparkSession
        held = self.newest(spark)
        seen = held.agg(F.max("seq")).head()[0]
        since = log if seen is None else log.where(F.col("seq") > seen)
        if since.isEmpty():
            return held
        if changed:
            changed(dims.current_config(since))
        commit(dims.latest_changes(held.unionByName(since)).coalesce(1), self.path, number)
        for old in self._found(spark)[: -self.keep]:
            fs, at = hadoop(spark, old)
            fs.delete(at, True)
        return self.newest(spark)
