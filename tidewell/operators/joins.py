"""Dictionary lookups and time-bounded joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, dictionary: DataFrame | None, code: str, name: str) -> DataFrame:
    """Add the dictionary name of a code; rows with an unknown code drop out.

    Without a dictionary the name stays null and no row drops out: `name_codes` looks it up later.

    No hint: Spark broadcasts the dictionary while its size stays under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles it, where
    adaptive execution splits the few hot codes.
    """
    if dictionary is None:
        return rows.withColumn(name, F.lit(None).cast("string"))
    names = dictionary.select(F.col("dic_code").alias(f"_{name}_code"), F.col("dic_name").alias(name))
    return rows.join(names, F.col(code) == F.col(f"_{name}_code"), "inner").drop(f"_{name}_code")


def name_codes(rows: DataFrame, dictionary: DataFrame, names: dict[str, str]) -> DataFrame:
    """Fill the columns `names` (code -> name) of rows that were made without a dictionary.

    The dictionary has the hint, not the rows: a micro-batch without input releases what joins
    held back, yet Spark takes it for empty and would collect and broadcast all of it.
    """
    found = rows.drop(*names.values())
    dictionary = F.broadcast(dictionary)
    for code, name in names.items():
        found = lookup(found, dictionary, code, name)
    return found.select(*rows.columns)


def within(left: str, right: str, bound: str | None) -> Column | None:
    """Both event times lie at most `bound` apart (None: unbounded)."""
    if bound is None:
        return None
    span = F.expr(f"interval {bound}")
    return (F.col(right) >= F.col(left) - span) & (F.col(right) <= F.col(left) + span)


def bounded_join(
    left: DataFrame,
    right: DataFrame,
    on: Column,
    times: tuple[str, str],
    bound: str | None,
    how: str = "inner",
) -> DataFrame:
    """Equi join of two change feeds whose rows meet within `bound`.

    With a bound and watermarks on both sides a stream can forget old rows;
    without a bound (batch) the join is a plain equi join.  Hot keys are split
    by adaptive skew handling, both for inner and left outer joins.
    """
    near = within(*times, bound)
    return left.join(right, on if near is None else on & near, how)


def keyed_join(
    left: DataFrame, right: DataFrame, keys: tuple[str, str], times: tuple[str, str], bound: str | None
) -> DataFrame:
    """Inner `bounded_join` on one column of each side."""
    return bounded_join(left, right, F.col(keys[0]) == F.col(keys[1]), times, bound)
