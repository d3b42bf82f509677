"""An inner join of two streams that waits by the wall clock, not by event time.

Rows of equal key meet when their event times lie within `bound`, in whatever order and
batch they arrive. The watermarks are on the time of arrival, which only rises, so no row is
ever late, however much event time a batch covers: a join upstream may release rows as late
as it likes. A row waits `keep` on the wall clock for its partners and then leaves the state
(a pause of the job counts as waiting). Null keys and times meet nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.joins import within

MICROS = {"second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6, "day": 86_400 * 10**6}


def micros(interval: str) -> int:
    """Microseconds of an interval such as `905 seconds` or `1 day`."""
    amount, unit = interval.split()
    return int(amount) * MICROS[unit.rstrip("s")]


def stateful_join(keep: str = "7 days"):
    """A join of the form that the plans take: (left, right, keys, times, bound) -> rows."""

    def join(left: DataFrame, right: DataFrame, keys: tuple[str, str], times: tuple[str, str], bound: str) -> DataFrame:
        return meet(left, right, keys, times, bound, keep)

    return join


def meet(
    left: DataFrame, right: DataFrame, keys: tuple[str, str], times: tuple[str, str], bound: str, keep: str = "7 days"
) -> DataFrame:
    """All columns of both sides, for rows of equal key at most `bound` apart."""
    arrived = ("_left_arrived", "_right_arrived")
    sides = [
        rows.withColumn(a, F.current_timestamp()).withWatermark(a, "0 seconds")
        for rows, a in zip((left, right), arrived, strict=True)
    ]
    same = F.col(keys[0]) == F.col(keys[1])
    return sides[0].join(sides[1], same & within(*times, bound) & within(*arrived, keep)).drop(*arrived)
