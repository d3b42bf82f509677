"""Streaming forms of the keyed-state operators.

Spark shuffles by key and keeps the state; the functions below only say how one
key's state moves.  They use flat columns of plain types.  Rows of a micro-batch
are taken in event-time order.  Before the shuffle each Arrow batch is cut to
the rows that can matter, so a hot key shrinks on the map side wherever the
operator allows it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewell.functions.time import day_of_millis, from_millis
from tidewell.operators import logs
from tidewell.operators.state import keep_flags
from tidewell.schemas import COMMON, PAGE

DAY_MS = 86_400_000
IN_ORDER = "0 seconds"  # watermark delay of a source whose records come in order


def flatten_pages(pages: DataFrame) -> DataFrame:
    return pages.select("common.*", "page.*", "ts", "seq")


def nest_pages(flat: DataFrame) -> DataFrame:
    return flat.select(
        F.struct(*COMMON.names).alias("common"), F.struct(*PAGE.names).alias("page"), "ts", "seq"
    )


def _days(column) -> object:
    """A date as a day number, so that Python needs no time zone."""
    return F.unix_date(column)


def _in_order(chunks: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(chunks), ignore_index=True).sort_values(["ts", "seq"], ignore_index=True)


# --------------------------------------------------------------------------
# New-visitor flag
# --------------------------------------------------------------------------
def new_visitor_days(messages: DataFrame) -> DataFrame:
    """(mid, day) of the visitors of each micro-batch whose flag holds on that day.

    Only visitor, flag and time are parsed, and each Arrow batch is cut to a visitor's first
    record and its first flagged record of a day, so a visitor with most of the rows costs a
    few rows for each task. The state is the one day on which a visitor was new, -1 for none.
    """
    heads = logs.heads(messages).select(
        "common.mid", (F.col("common.is_new") == "1").alias("flag"), "ts", "seq", _days(day_of_millis("ts")).alias("day")
    )

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.assign(flag=batch["flag"].eq(True)).sort_values(["ts", "seq"])
            first = ~batch.duplicated("mid")
            yield batch[first | (batch["flag"] & ~batch.duplicated(["mid", "day", "flag"]))]

    def advance(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState):
        rows = _in_order(chunks)
        if state.exists:
            (new_day,) = state.get
        else:
            first = rows.iloc[0]
            new_day = int(first["day"]) if first["flag"] and not pd.isna(first["day"]) else -1
            state.update((new_day,))
        if (rows["flag"] & (rows["day"] == new_day)).any():
            yield pd.DataFrame({"mid": [key[0]], "day": [new_day]})

    found = (
        heads.mapInPandas(reduce, heads.schema)
        .groupBy("mid")
        .applyInPandasWithState(advance, "mid string, day int", "new_day int", "append", GroupStateTimeout.NoTimeout)
    )
    return found.select(F.col("mid").alias("_mid"), F.date_from_unix_date("day").alias("_day"))


def messages_with_days(messages: DataFrame) -> DataFrame:
    """Messages and, as rows without a value, what `new_visitor_days` says about their batch."""
    return messages.select("value", "seq").unionByName(new_visitor_days(messages), allowMissingColumns=True)


def repair_new_visitors(batch: DataFrame) -> DataFrame:
    """Clean records with corrected flags, from one stored micro-batch of `messages_with_days`.

    The records meet their visitor's day in a join on visitor and day; none is grouped.
    """
    log = logs.clean(logs.parse(batch.select("value", "seq")))
    return keep_flags(log, batch.where("_mid is not null").select("_mid", "_day"))


# --------------------------------------------------------------------------
# First rows of a day
# --------------------------------------------------------------------------
def _first_rows(unit: list[str]) -> Callable:
    """The first row (`ts`, `seq`) of each `unit` in a task; twice the result is held at most."""

    def firsts(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("ts", "ascending"), ("seq", "ascending")])
        numbered = rows.select(unit).append_column("_at", pa.array(range(rows.num_rows), pa.int64()))
        return rows.take(numbered.group_by(unit).aggregate([("_at", "min")])["_at_min"])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kept = [], 0
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 2 * kept + 50_000:
                held = firsts(pa.Table.from_batches(held)).to_batches()
                kept = sum(b.num_rows for b in held)
        if held:
            yield from firsts(pa.Table.from_batches(held)).to_batches()

    return reduce


def first_of_day(
    rows: DataFrame, key: str, also: list[str] | None = None, delay: str = IN_ORDER
) -> DataFrame:
    """First row of each key (and `also` columns) on each day.

    `rows` has plain columns with `ts` (ms), `seq`, `day` (date) and `event_time`. A task cuts its
    rows to the first ones before and after the shuffle, and Spark's own state of the days seen
    lets one through; no Python runs for a single key. The state of a day leaves once the
    watermark is two days past its beginning.
    """
    unit = [key, *(also or []), "day"]
    names = rows.columns
    flat = rows.withColumn("day", _days("day"))
    found = flat.mapInArrow(_first_rows(unit), flat.schema).repartition(*unit).mapInArrow(
        _first_rows(unit), flat.schema
    )
    day = F.date_from_unix_date("day")
    return (
        found.withColumns({"day": day, "_begins": day.cast("timestamp")})
        .withWatermark("_begins", f"2 days {delay}")
        .dropDuplicates([*unit, "_begins"])
        .select(*names)
    )


def first_with_previous_day(rows: DataFrame, key: str, delay: str = IN_ORDER) -> DataFrame:
    """`first_of_day` with `previous_day`, the key's last active day, which is the state of a key."""
    unit = [key, "day"]
    flat = rows.withColumn("day", _days("day"))
    names = flat.columns

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values(["ts", "seq"]).drop_duplicates(unit)

    def advance(_: tuple, chunks: Iterator[pd.DataFrame], state: GroupState):
        batch = _in_order(chunks).drop_duplicates(unit)
        before = state.get[0] if state.exists else None
        previous = batch["day"].shift(1)
        previous.iloc[0] = before
        first = previous.isna() | (previous != batch["day"])
        state.update((int(batch["day"].iloc[-1]),))
        batch["previous_day"] = previous.astype("Int64").astype("Int32")
        yield batch[first]

    out = T.StructType([*flat.schema.fields, T.StructField("previous_day", T.IntegerType())])
    found = (
        flat.mapInPandas(reduce, flat.schema)
        .withWatermark("event_time", delay)
        .groupBy(key)
        .applyInPandasWithState(advance, out, "last_day int", "append", GroupStateTimeout.NoTimeout)
    )
    return found.select(
        *[F.date_from_unix_date("day").alias("day") if n == "day" else F.col(n) for n in names],
        F.date_from_unix_date("previous_day").alias("previous_day"),
    )


def unique_visitors(pages: DataFrame, delay: str = IN_ORDER) -> DataFrame:
    """First session start of each visitor on each day."""
    flat = flatten_pages(logs.session_starts(pages)).withColumns(
        {"event_time": from_millis("ts"), "day": day_of_millis("ts")}
    )
    return nest_pages(first_of_day(flat, "mid", delay=delay))


# --------------------------------------------------------------------------
# Bounces
# --------------------------------------------------------------------------
def bounces(pages: DataFrame, within_ms: int = 10_000, delay: str = IN_ORDER) -> DataFrame:
    """Session starts left without a second page within `within_ms`.

    Visitors are cut into slices of `within_ms`: windows that reach as far into the next slice, so
    the cut is exact and a visitor with most of the rows is many small groups. The state of a group
    is its pages, and only starts carry their payload; once the watermark has passed the window
    its starts are judged, all in Spark's own operators. Rows without a time have no next page.
    """
    is_start = F.col("page.last_page_id").isNull()
    rows = pages.where("ts is not null").select(
        F.col("common.mid").alias("mid"), from_millis("ts").alias("event_time"), "ts", "seq",
        is_start.alias("start"), F.struct(*pages.columns).alias("row"),
    )
    sliced = rows.withWatermark("event_time", delay).withColumn(
        "slice", F.window("event_time", f"{2 * within_ms} milliseconds", f"{within_ms} milliseconds")
    )
    own = F.col("start") & (F.col("ts") < F.unix_millis("slice.start") + within_ms)
    page = F.struct("ts", "seq", "start", F.when(own, F.col("row")).alias("row"))
    groups = sliced.groupBy("mid", "slice").agg(F.sort_array(F.collect_list(page)).alias("pages"))

    def alone(x, i):
        following = F.get("pages", i + 1)
        left = following.isNull() | following["start"] | (following["ts"] >= x["ts"] + within_ms)
        return x["row"].isNotNull() & left

    found = groups.select(F.inline(F.filter("pages", alone))).select("row.*")
    return found.unionByName(pages.where(F.col("ts").isNull() & is_start))
