"""Dimension sync: change log and configuration log to dimension rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewell.operators import dims
from tidewell.operators.merge import latest


def dimension_upserts(changes: DataFrame, config_changes: DataFrame) -> DataFrame:
    """Every upsert of every configured dimension."""
    return dims.dimension_rows(changes, dims.current_config(config_changes))


def dimension_state(changes: DataFrame, config_changes: DataFrame) -> DataFrame:
    """Current row of each dimension key."""
    upserts = dimension_upserts(changes, config_changes)
    return latest(upserts, ["sink_table", "pk"], "version", "seq")
