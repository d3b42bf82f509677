"""Dimensions as tables of the session's catalog: made and widened by their configuration,
filled by plain partition overwrite."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.dims import sink_schema
from tidewell.operators.merge import latest
from tidewell.sinks.batches import hadoop

KEY, VERSION, BUCKET = "_pk", "_version", "_bucket"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class CatalogTables:
    """External tables below `path`: the configured columns as text, then the key, the version
    and the bucket of the key, by which they are partitioned.

    A micro-batch rewrites the buckets it touches and is repeatable: a row stays unless one of
    the same or a later version comes. Sessions beside the writer's see it after REFRESH TABLE.
    """

    path: str
    database: str
    buckets: int = 16

    def name(self, sink_table: str) -> str:
        return f"{_quoted(self.database)}.{_quoted(sink_table)}"

    def folder(self, sink_table: str) -> str:
        return f"{self.path}/{sink_table}"

    def columns(self, spark: SparkSession, sink_table: str) -> list[str]:
        """The configured columns, those of earlier configurations too."""
        return [c for c in spark.table(self.name(sink_table)).columns if c not in (KEY, VERSION, BUCKET)]

    def provide(self, spark: SparkSession, config: DataFrame) -> None:
        """Make the tables that `config` names, or add the columns they lack; none is taken away.

        A table whose folder outlived the catalog of its session gets its partitions back.
        """
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(self.database)}")
        # One row per configured table.
        for entry in config.select("sink_table", "sink_columns").distinct().collect():
            at = self.name(entry.sink_table)
            wanted = sink_schema(entry.sink_columns).names
            if not spark.catalog.tableExists(at):
                text = ", ".join(f"{_quoted(c)} STRING" for c in wanted)
                fs, where = hadoop(spark, self.folder(entry.sink_table))
                fs.mkdirs(where)
                where = where.toString().replace("'", "\\'")
                spark.sql(
                    f"CREATE TABLE {at} ({text}, {KEY} STRING, {VERSION} BIGINT, {BUCKET} INT) "
                    f"USING parquet PARTITIONED BY ({BUCKET}) LOCATION '{where}'"
                )
                spark.catalog.recoverPartitions(at)
            have = {c.lower() for c in spark.table(at).columns}
            lacking = [c for c in wanted if c.lower() not in have]
            if lacking:
                spark.sql(f"ALTER TABLE {at} ADD COLUMNS ({', '.join(f'{_quoted(c)} STRING' for c in lacking)})")

    def upsert(self, rows: DataFrame) -> None:
        """Merge stored dimension rows (sink_table, pk, data, version) into their tables."""
        spark = rows.sparkSession
        bucket = F.pmod(F.hash("pk"), F.lit(self.buckets))
        # At most `buckets` rows per configured table.
        touched = rows.groupBy("sink_table").agg(F.collect_set(bucket).alias("buckets")).collect()
        for sink_table, buckets in touched:
            at = self.name(sink_table)
            columns = self.columns(spark, sink_table)
            fresh = rows.where(F.col("sink_table") == sink_table).select(
                *[F.col("data")[c].alias(c) for c in columns],
                F.col("pk").alias(KEY), F.col("version").alias(VERSION), bucket.alias(BUCKET),
                F.lit(1).alias("_fresh"),
            )
            held = spark.table(at).where(F.col(BUCKET).isin(buckets)).withColumn("_fresh", F.lit(0))
            merged = latest(held.unionByName(fresh), [KEY], VERSION, "_fresh").drop("_fresh")
            # Written aside first: a table cannot be overwritten while it is read.
            aside = f"{self.path}/_aside/{sink_table}"
            merged.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(aside)
            (
                spark.read.schema(merged.schema).parquet(aside).hint("rebalance", BUCKET)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy(BUCKET).parquet(self.folder(sink_table))
            )
            spark.catalog.recoverPartitions(at)
            spark.catalog.refreshTable(at)
