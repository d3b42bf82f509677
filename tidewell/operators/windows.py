"""Tumbling event-time windows and their decoration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.time import DATE, DATE_TIME

DEFAULT_SIZE = "10 seconds"


def decorate(windowed: DataFrame) -> DataFrame:
    """Replace `window` by `stt`, `edt` and the day partition `cur_date`."""
    rest = [c for c in windowed.columns if c != "window"]
    return windowed.select(
        F.col("window.start").alias("stt"),
        F.col("window.end").alias("edt"),
        F.to_date("window.start").alias("cur_date"),
        *rest,
    )


def tumble(
    rows: DataFrame,
    time: str,
    keys: list[str],
    metrics: dict[str, Column],
    size: str = DEFAULT_SIZE,
    start: str | None = None,
) -> DataFrame:
    """Aggregate per tumbling window and keys.

    Partial aggregation runs before the one shuffle, so neither a hot key nor
    the key-less global window ends up in a single task.  `start` shifts the
    windows, for day windows whose day does not begin at midnight UTC.
    """
    window = F.window(time, size, startTime=start) if start else F.window(time, size)
    grouped = rows.groupBy(window.alias("window"), *keys)
    return decorate(grouped.agg(*[m.alias(n) for n, m in metrics.items()]))


def as_text(summary: DataFrame) -> DataFrame:
    """Window bounds and day as the texts a report shows."""
    return summary.select(
        *[
            F.date_format(c, DATE_TIME if c in ("stt", "edt") else DATE).alias(c)
            if c in ("stt", "edt", "cur_date")
            else F.col(c)
            for c in summary.columns
        ]
    )
