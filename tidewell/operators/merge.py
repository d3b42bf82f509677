"""Keyed merges: latest version, and merge rules per column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], *version: str | Column) -> DataFrame:
    """The row with the greatest version of each key (all columns kept)."""
    rest = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version))
    return rows.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*").select(*rows.columns)


def aggregate_key_merge(
    rows: DataFrame, keys: list[str], rules: dict[str, str], *version: str | Column
) -> DataFrame:
    """Merge rows of equal key: 'sum', 'max', 'min' or 'replace' per column.

    'replace' takes the value of the row with the greatest version.
    """
    merges = {
        "sum": F.sum,
        "max": F.max,
        "min": F.min,
        "replace": lambda c: F.max_by(c, F.struct(*version)),
    }
    unknown = set(rules.values()) - set(merges)
    if unknown:
        raise ValueError(f"unknown merge rules: {sorted(unknown)}")
    if "replace" in rules.values() and not version:
        raise ValueError("'replace' needs a version to order the rows")
    return rows.groupBy(*keys).agg(*[merges[rule](c).alias(c) for c, rule in rules.items()])
