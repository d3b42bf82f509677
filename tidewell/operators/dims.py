"""Configured dimension tables: which tables, which columns, which key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.operators import changes as ch

DEFAULT_KEY = "id"


def latest_changes(config_changes: DataFrame) -> DataFrame:
    """Fold the configuration's change log: the latest change of each source table, deletes too.

    The result is a change log again, so folding it with later changes equals folding all.
    """
    source = F.coalesce("after.source_table", "before.source_table")
    entry = F.max_by(F.struct("op", "before", "after", "seq"), F.col("seq"))
    return config_changes.groupBy(source.alias("_source")).agg(entry.alias("_last")).select("_last.*")


def current_config(config_changes: DataFrame) -> DataFrame:
    """The latest entry per source table, without the tables whose latest change is a delete."""
    return latest_changes(config_changes).where("op <> 'd'").select("after.*")


def dimension_rows(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Route change rows to their dimension: (sink_table, pk, data, version).

    `data` keeps the configured columns only.  Deletes are upserts like any
    other change.  Tables without configuration drop out.  The configuration is
    one row per table; Spark broadcasts it after checking its size.
    """
    configured = config.select(
        F.col("source_table").alias("_source"),
        "sink_table",
        F.transform(F.split("sink_columns", ","), lambda c: F.trim(c)).alias("_columns"),
        F.coalesce("sink_pk", F.lit(DEFAULT_KEY)).alias("_pk"),
    )
    rows = ch.data_rows(changes).join(configured, F.col("table") == F.col("_source"), "inner")
    return rows.select(
        "sink_table",
        F.col("data")[F.col("_pk")].alias("pk"),
        F.transform_values(
            F.map_filter("data", lambda k, _: F.array_contains("_columns", k)),
            lambda _, v: F.coalesce(v, F.lit("")),
        ).alias("data"),
        F.col("ts").try_cast("bigint").alias("version"),
        "seq",
    )


def sink_schema(sink_columns: str) -> T.StructType:
    """Declared type of a dimension table: every configured column is text."""
    return T.StructType([T.StructField(c.strip(), T.StringType()) for c in sink_columns.split(",")])


def configured_table(rows: DataFrame, config: DataFrame, sink_table: str) -> DataFrame:
    """A dimension with the columns that its configuration names (one small row is read).

    A table that is configured but has no rows yet is there, empty.
    """
    found = config.where(F.col("sink_table") == sink_table).select("sink_columns").head(1)
    if not found:
        raise LookupError(f"no configuration for {sink_table}")
    return dimension_table(rows, sink_table, found[0]["sink_columns"])


def dimension_table(rows: DataFrame, sink_table: str, sink_columns: str) -> DataFrame:
    """One dimension as a plain table, from its upsert rows."""
    schema = sink_schema(sink_columns)
    return rows.where(F.col("sink_table") == sink_table).select(
        *[F.col("data")[f.name].alias(f.name) for f in schema.fields]
    )
