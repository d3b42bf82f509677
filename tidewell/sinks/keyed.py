"""Keyed tables: upserts from micro-batches, folded per partition.

Each micro-batch is a folder `kind=delta/batch=N` that appears by one rename, so results are
exactly once and a stream may read the deltas (`changes`). After `fold_every` batches the job
folds: only partitions that the new deltas touch are merged with what they held before and written
to `kind=base/batch=N`; all others stay where they are. Readers take the newest base of each
partition and the deltas after the last fold, and merge rows of equal key. With `buckets` the
partitions are hashes of the key; with `fold_every=1` there is nothing left to merge when read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell.operators.merge import aggregate_key_merge, latest
from tidewell.sinks.batches import BATCH, commit, drop_shuffles, folder, globbed, hadoop, no_shuffles_left

KIND, BUCKET, DELETED = "kind", "bucket", "_deleted"


def _number(path: str) -> int:
    """The batch in the path of a folder."""
    return int(path.rpartition(f"{BATCH}=")[2].partition("/")[0])


@dataclass(frozen=True)
class KeyedTable:
    """A table of one row per key.

    `rules` gives a merge rule per metric (see ``aggregate_key_merge``); without
    rules the newest row replaces the older ones.  `version` orders rows before
    the batch id does. With `deletes`, a row whose column `_deleted` is true removes its
    key; it is kept as a mark, so that an older row that comes later stays removed.
    """

    path: str
    schema: T.StructType
    keys: list[str]
    partition_by: list[str] = field(default_factory=list)
    rules: dict[str, str] | None = None
    version: list[str] = field(default_factory=list)
    buckets: int = 0
    fold_every: int = 20
    deletes: bool = False

    @property
    def checkpoint(self) -> str:
        """Kept with the data: batch ids are only valid together with it."""
        return f"{self.path}/_checkpoint"

    @property
    def partitions(self) -> list[str]:
        return [BUCKET] if self.buckets else self.partition_by

    @property
    def _apart(self) -> bool:
        """Rows of equal key are in one partition."""
        return bool(self.buckets) or set(self.partition_by) <= set(self.keys)

    @property
    def _stored(self) -> T.StructType:
        fields = list(self.schema.fields)
        fields += [T.StructField(DELETED, T.BooleanType())] if self.deletes else []
        fields += [T.StructField(BUCKET, T.IntegerType())] if self.buckets else []
        return T.StructType(fields)

    # -- writing ----------------------------------------------------------
    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Store one micro-batch; batches already folded into a base are skipped."""
        spark = rows.sparkSession
        if batch_id <= self._folded(spark):
            return
        if self.deletes and DELETED not in rows.columns:
            rows = rows.withColumn(DELETED, F.lit(False))
        if self.buckets:
            rows = rows.withColumn(BUCKET, F.pmod(F.hash(*self.keys), F.lit(self.buckets)))
        commit(self._dealt(rows.select(*self._stored.names)), f"{self.path}/{KIND}=delta", batch_id, self.partitions)
        if len(self._deltas(spark)) >= self.fold_every:
            self.compact(spark)

    def upsert(
        self, stream: DataFrame, mode: str = "update", trigger: dict | None = None
    ) -> StreamingQuery:
        """Start the query that keeps this table up to date."""

        def store(batch: DataFrame, number: int) -> None:
            self.write(batch, number)
            drop_shuffles(batch)

        return (
            stream.writeStream.outputMode(mode)
            .foreachBatch(store)
            .option("checkpointLocation", self.checkpoint)
            .trigger(**(trigger or {"processingTime": "2 seconds"}))
            .start()
        )

    def compact(self, spark: SparkSession) -> None:
        """Fold the deltas: the partitions that they touch get a new base."""
        deltas = self._deltas(spark)
        if not deltas:
            return
        last = _number(deltas[-1])
        touched = None
        if self.partitions:
            touched = {self._partition(p) for d in deltas for p in globbed(spark, d + "/*=*" * len(self.partitions))}
        rows = self._dealt(self._merged(self._read(spark, touched)))
        before = self._folded(spark)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        with no_shuffles_left(spark):
            (writer.partitionBy(*self.partitions) if self.partitions else writer).parquet(f"{self.path}/{KIND}=base/{folder(last)}")
        self.drop_folded(spark, before)

    def drop_folded(self, spark: SparkSession, up_to: int | None = None) -> None:
        """Remove what a newer base contains, by default up to the newest.

        Folding leaves what it replaced until the next fold, for readers with an older plan.
        """
        up_to = self._folded(spark) if up_to is None else up_to
        old = [d for d in globbed(spark, f"{self.path}/{KIND}=delta/{BATCH}=*") if _number(d) <= up_to]
        newest = set(self._bases(spark))
        old += [p for p in self._base_parts(spark) if _number(p) <= up_to and p not in newest]
        for path in old:
            fs, at = hadoop(spark, path)
            fs.delete(at, True)

    def _dealt(self, rows: DataFrame) -> DataFrame:
        # Few files per partition, large partitions split: sizes known at run time.
        return rows.hint("rebalance", *self.partitions) if self.partitions else rows

    # -- reading ----------------------------------------------------------
    def read(self, spark: SparkSession, **wanted: str) -> DataFrame:
        """Current rows. `wanted` names partitions (cur_date="2024-03-01"): only their folders are listed."""
        rows = self._read(spark, None, wanted)
        # A key is in one partition, and a base has one row for it.
        rows = self._merged(rows) if self._deltas(spark) or not self._apart else rows.drop(BATCH)
        if self.deletes:
            rows = rows.where(~F.col(DELETED))
        return rows.select(*self.schema.names)

    def changes(self, spark: SparkSession, **options: str) -> DataFrame:
        """The rows of every batch as a stream, each once, with their batch.

        A reader must not fall behind by more than one fold, after which deltas are removed.
        """
        schema = T.StructType([*self._stored.fields, T.StructField(BATCH, T.LongType())])
        return spark.readStream.schema(schema).options(**options).parquet(f"{self.path}/{KIND}=delta")

    def _merged(self, rows: DataFrame) -> DataFrame:
        order: list[str | Column] = [*self.version, BATCH]
        if self.rules:
            return aggregate_key_merge(rows, self.keys, self.rules, *order)
        return latest(rows, self.keys, *order).drop(BATCH)

    def _read(self, spark: SparkSession, touched: set[str] | None, wanted: dict[str, str] | None = None) -> DataFrame:
        parts = "/".join(f"{p}={(wanted or {}).get(p, '*')}" for p in self.partitions)
        found = self._bases(spark)
        for delta in self._deltas(spark):
            found += globbed(spark, f"{delta}/{parts}") if parts else [delta]
        if touched is not None:
            found = [p for p in found if self._partition(p) in touched]
        if wanted:
            found = [p for p in found if all(f"{k}={v}" in p.split("/") for k, v in wanted.items())]
        schema = T.StructType(
            [*self._stored.fields, T.StructField(KIND, T.StringType()), T.StructField(BATCH, T.LongType())]
        )
        if not found:
            return spark.createDataFrame([], schema).drop(KIND)
        reader = spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*found).drop(KIND)

    def _partition(self, path: str) -> str:
        """The partition part of a folder's path."""
        return "/".join(path.rstrip("/").split("/")[-len(self.partitions) :]) if self.partitions else ""

    def _base_parts(self, spark: SparkSession) -> list[str]:
        """Every partition of every complete base."""
        done = [p.rpartition("/")[0] for p in globbed(spark, f"{self.path}/{KIND}=base/{BATCH}=*/_SUCCESS")]
        if not self.partitions:
            return done
        return [p for base in done for p in globbed(spark, base + "/*=*" * len(self.partitions))]

    def _bases(self, spark: SparkSession) -> list[str]:
        """The newest base of each partition."""
        newest: dict[str, str] = {}
        for path in sorted(self._base_parts(spark), key=_number):
            newest[self._partition(path)] = path
        return list(newest.values())

    def _folded(self, spark: SparkSession) -> int:
        """The last batch that a base contains."""
        return max(map(_number, globbed(spark, f"{self.path}/{KIND}=base/{BATCH}=*/_SUCCESS")), default=-1)

    def _deltas(self, spark: SparkSession) -> list[str]:
        """Folders of the batches after the last fold, in order."""
        folded = self._folded(spark)
        found = globbed(spark, f"{self.path}/{KIND}=delta/{BATCH}=*/_SUCCESS")
        return sorted((p.rpartition("/")[0] for p in found if _number(p) > folded), key=_number)
