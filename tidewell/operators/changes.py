"""Database change records: selection by table, projection of columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.changes import new
from tidewell.functions.time import from_seconds
from tidewell.schemas import CHANGE, CONTROL_TYPES


def parse(messages: DataFrame, schema: T.StructType = CHANGE) -> DataFrame:
    """Change records from JSON messages; unreadable text gives a null type."""
    record = F.from_json("value", schema)
    return messages.where("value is not null").select(F.inline(F.array(record)), "seq")


def data_rows(changes: DataFrame) -> DataFrame:
    """Drop control rows and rows without data; keep insert, update, delete and
    bootstrap inserts."""
    return changes.where(
        F.col("type").isNotNull() & ~F.col("type").isin(CONTROL_TYPES) & F.col("data").isNotNull()
    )


# Gives the changes of one source table, by its name.
Feed = Callable[[str], DataFrame]


def feed(changes: DataFrame) -> Feed:
    """One change log as a feed.

    Comparing `table` with a literal prunes the partitions of a change log
    stored by table.
    """
    return lambda name: changes.where(F.col("table") == name)


def table(changes: Feed, name: str, *types: str) -> DataFrame:
    """Changes of one source table, optionally of some change types only."""
    rows = changes(name)
    return rows.where(F.col("type").isin(*types)) if types else rows


def columns(changes: DataFrame, *names: str, **computed: Column) -> DataFrame:
    """Project changed values to columns; keeps the record time and its event time."""
    return changes.select(
        *[new(n).alias(n) for n in names],
        *[c.alias(n) for n, c in computed.items()],
        F.col("ts"),
        from_seconds("ts").alias("event_time"),
    )
