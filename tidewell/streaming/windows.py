"""Windowed summaries over streams.

The watermark delay says how late a record may come.  In update mode a window
is sent again whenever it changes, and the keyed table replaces its row: that
is how late records correct a window that was already reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewell import schemas as s
from tidewell.functions.time import day_of_millis, day_of_seconds, from_millis, from_seconds
from tidewell.operators.windows import DEFAULT_SIZE, tumble
from tidewell.plans import summary
from tidewell.streaming import state
from tidewell.streaming.state import IN_ORDER

OUT_OF_ORDER = "3 seconds"
OUT_OF_ORDER_AND_LATE = "13 seconds"  # out of orderness plus allowed lateness


def _sums(names: list[str]) -> dict:
    return {n: F.sum(n) for n in names}


def keyword_window(pages: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    words = summary.search_words(pages).withWatermark("row_time", OUT_OF_ORDER)
    counts = tumble(words, "row_time", ["keyword"], {"keyword_count": F.count("*")}, size)
    return counts.withColumn("source", F.lit(s.KEYWORD_SEARCH)).select(
        *s.KEYWORD_KEYS, *s.KEYWORD_METRICS
    )


def traffic_window(
    pages: DataFrame, uniques: DataFrame, jumps: DataFrame, size: str = DEFAULT_SIZE
) -> DataFrame:
    measures = summary.traffic_measures(pages, uniques, jumps, OUT_OF_ORDER_AND_LATE)
    keys = ["vc", "ch", "ar", "is_new"]
    summed = tumble(measures, "event_time", keys, _sums(s.TRAFFIC_METRICS), size)
    return summed.select(*s.TRAFFIC_KEYS, *s.TRAFFIC_METRICS)


def measures_window(
    measures: DataFrame, metrics: list[str], size: str = DEFAULT_SIZE, delay: str = IN_ORDER
) -> DataFrame:
    """Sum measures (`event_time` and metric columns) per window."""
    rows = measures.withWatermark("event_time", delay)
    return tumble(rows, "event_time", [], _sums(metrics), size).select(*s.WINDOW_KEYS, *metrics)


# --------------------------------------------------------------------------
# Measures: the stateful half of a summary, written to a table of its own
# --------------------------------------------------------------------------
def _seconds(rows: DataFrame, user: str) -> DataFrame:
    return rows.select(
        F.col(user).alias("user_id"),
        (F.col("ts").try_cast("bigint") * 1000).alias("ts"),
        F.lit(0).cast("bigint").alias("seq"),
        day_of_seconds("ts").alias("day"),
        from_seconds("ts").alias("event_time"),
    )


def page_measures(pages: DataFrame, delay: str = IN_ORDER) -> DataFrame:
    visits = summary.page_visits(pages).select(
        "mid", "page_id", "ts", F.lit(0).cast("bigint").alias("seq"),
        day_of_millis("ts").alias("day"), from_millis("ts").alias("event_time"),
    )
    return summary.page_measures(state.first_of_day(visits, "mid", ["page_id"], delay=delay))


def login_measures(pages: DataFrame, delay: str = IN_ORDER) -> DataFrame:
    visits = summary.login_visits(pages).select(
        "uid", "ts", F.lit(0).cast("bigint").alias("seq"),
        day_of_millis("ts").alias("day"), from_millis("ts").alias("event_time"),
    )
    return summary.login_measures(state.first_with_previous_day(visits, "uid", delay))


def register_measures(registrations: DataFrame) -> DataFrame:
    return registrations.select(
        from_seconds("ts").alias("event_time"), F.lit(1).cast("bigint").alias("register_ct")
    )


def cart_measures(
    cart_adds: DataFrame, every_add: bool = False, delay: str = IN_ORDER
) -> DataFrame:
    rows = _seconds(cart_adds, "user_id")
    firsts = rows if every_add else state.first_of_day(rows, "user_id", delay=delay)
    return firsts.select("event_time", F.lit(1).cast("bigint").alias("cart_add_uu_ct"))


def earliest(rows: DataFrame) -> DataFrame:
    """(ever, ts, n): n = 1 for a user's first payment of a day (`ever` false) and of all (`ever`
    true), taken back by n = -1 when an earlier one comes.

    `rows` has user_id, ts (ms) and day. The state of a key is the earliest time so far, one number
    for each user and day on which the user paid.
    """
    always = -1
    day = F.explode(F.array(state._days(F.col("day")), F.lit(always)))
    flat = rows.where("ts is not null").select("user_id", day.alias("day"), "ts")

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values("ts").drop_duplicates(["user_id", "day"])

    def advance(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState):
        first = min(int(chunk["ts"].min()) for chunk in chunks)
        before = state.get[0] if state.exists else None
        out = []
        if before is None or first < before:
            out = [(first, 1)] if before is None else [(first, 1), (before, -1)]
            state.update((first,))
        yield pd.DataFrame(out, columns=["ts", "n"]).assign(ever=bool(key[1] == always))

    return (
        flat.mapInPandas(reduce, flat.schema)
        .groupBy("user_id", "day")
        .applyInPandasWithState(
            advance, "ever boolean, ts long, n long", "ts long", "append", GroupStateTimeout.NoTimeout
        )
    )


def payer_measures(payments: DataFrame) -> DataFrame:
    """Signed measures of paying users: sums are right whatever the order of arrival.

    Every payment gives a zero row, so that windows of repeat payments appear. A user's first
    payment of a day counts in its window, and the first ever too; when an earlier one comes
    later, the row that was counted is taken back.
    """
    rows = _seconds(payments, "user_id")
    unique, first_ever = s.PAYER_METRICS
    zero = F.lit(0).cast("bigint")
    time = from_millis("ts").alias("event_time")
    counted = earliest(rows).select(
        time,
        F.when(F.col("ever"), zero).otherwise(F.col("n")).alias(unique),
        F.when(F.col("ever"), F.col("n")).otherwise(zero).alias(first_ever),
    )
    seen = rows.select(time, zero.alias(unique), zero.alias(first_ever))
    return seen.unionByName(counted).where("event_time is not null")
