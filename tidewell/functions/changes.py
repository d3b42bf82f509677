"""Expressions over change records.

`data` and `old` are maps or structs of text; the expressions fit both.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def new(column: str) -> Column:
    """Value after the change."""
    return F.col("data")[column]


def previous(column: str) -> Column:
    """Value before the change; null unless this change touched the column."""
    return F.col("old")[column]


def changed(column: str) -> Column:
    return previous(column).isNotNull()


def changed_to(column: str, value: str) -> Column:
    return changed(column) & (new(column) == value)


def changed_from_to(column: str, before: str, after: str) -> Column:
    return (previous(column) == before) & (new(column) == after)


def amount(quantity: Column, price: Column) -> Column:
    """Quantity times price in DECIMAL(16,2), as text of scale four."""
    money = "decimal(16,2)"
    return (quantity.try_cast(money) * price.try_cast(money)).cast("string")


def added_quantity(column: str) -> Column:
    """The whole value of an insert, the increase of an update."""
    step = new(column).try_cast("int") - previous(column).try_cast("int")
    return F.when(F.col("type") == "insert", new(column)).otherwise(step.cast("string"))


def has_added(column: str) -> Column:
    """True for inserts and for updates that raised the value."""
    raised = new(column).try_cast("int") > previous(column).try_cast("int")
    return (F.col("type") == "insert") | (
        (F.col("type") == "update") & changed(column) & raised
    )
