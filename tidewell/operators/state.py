"""Batch forms of the keyed-state operators.

One visitor or user may own a third of all rows, so none of these gathers the
rows of one key in a task.  Rows are first reduced per key and *day* (partial
aggregation happens before the shuffle), or cut into short time slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.functions.time import day_of_millis


def repair_new_visitors(log: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """Correct `common.is_new`.

    The first record of a visitor decides: if it says "new", the flag holds for
    records of that day only; if it says "known", the visitor is never new.
    Hence a record keeps the flag exactly when the visitor's first record is
    flagged and lies on the same day.

    `heads` gives `common.mid`, `common.is_new`, `ts` and `seq` of the same records where
    they can be had for less than the whole.  The records themselves are read once: those
    without a flag get keys of their own in the join, which no visitor has, so they spread
    evenly if it shuffles.
    """
    heads = log if heads is None else heads
    first = (
        heads.groupBy(F.col("common.mid").alias("_mid"))
        .agg(F.min(F.struct("ts", "seq", F.col("common.is_new").alias("is_new"))).alias("_first"))
        .where(F.col("_first.is_new") == "1")
        .select("_mid", day_of_millis("_first.ts").alias("_day"))
    )
    return keep_flags(log, first)


def keep_flags(log: DataFrame, first: DataFrame) -> DataFrame:
    """`log` with the new-visitor flag only on the days `first` (_mid, _day) names."""
    first = first.select(F.struct("_mid", "_day").alias("_new"))
    flagged = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    day = F.when(flagged, day_of_millis("ts")).otherwise(F.date_from_unix_date((-1 - F.abs(F.col("seq")) % 100_000).cast("int")))
    keyed = log.withColumns({"_visitor": F.when(flagged, F.col("common.mid")).otherwise("\0"), "_on": day})
    joined = keyed.join(
        first, (F.col("_visitor") == F.col("_new._mid")) & (F.col("_on") == F.col("_new._day")), "left"
    )
    is_new = (
        F.when(~flagged, F.col("common.is_new")).when(F.col("_new").isNull(), "0").otherwise("1")
    )
    return joined.withColumn("common", F.col("common").withField("is_new", is_new)).drop(
        "_visitor", "_on", "_new"
    )


def first_rows_of_day(rows: DataFrame, key: Column | str, day: Column, *order: str) -> DataFrame:
    """The first whole row of each key on each day.

    ``row_number() = 1`` lets Spark cut every map task to one row per key and
    day before the shuffle (WindowGroupLimit).
    """
    key = F.col(key) if isinstance(key, str) else key
    first = Window.partitionBy(key, day).orderBy(*order)
    return rows.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def first_times_of_day(rows: DataFrame, keys: list[str], time: str, day: Column) -> DataFrame:
    """Time of the first row per keys and day: `keys`, `day`, `time`.

    A hash aggregate over a few numbers; enough wherever the summary needs the
    window of the first row but not the row.
    """
    return rows.groupBy(*keys, day.alias("day")).agg(F.min(time).alias(time))


def with_previous_day(firsts: DataFrame, key: str) -> DataFrame:
    """Add the key's previous active day.  Groups are bounded by days, not rows."""
    return firsts.withColumn("previous_day", F.lag("day").over(Window.partitionBy(key).orderBy("day")))


def bounces(pages: DataFrame, within_ms: int = 10_000, slice_ms: int | None = None) -> DataFrame:
    """Session starts whose visitor does not go on within `within_ms`.

    A start is kept when the visitor's very next page is another start or comes
    `within_ms` later or never.  Visitors are cut into time slices, so that a
    hot visitor spreads over many tasks; rows in the first `within_ms` of a
    slice are shown to the previous slice too, which makes the cut exact.  Only
    starts carry their payload through the shuffle.
    """
    slice_ms = slice_ms or 10 * within_ms
    if slice_ms < within_ms:
        raise ValueError("a slice must be at least as long as the limit")
    home = F.expr(f"ts div {slice_ms}")
    near_begin = (F.col("ts") - home * slice_ms) < within_ms
    is_start = F.col("page.last_page_id").isNull()
    payload = F.struct(*pages.columns)

    cut = pages.select(
        F.col("common.mid").alias("_mid"),
        F.col("ts").alias("_ts"),
        F.col("seq").alias("_seq"),
        is_start.alias("_start"),
        F.when(is_start, payload).alias("_row"),
        home.alias("_home"),
        F.explode(F.when(near_begin, F.array(home, home - 1)).otherwise(F.array(home))).alias("_slice"),
    ).withColumn("_row", F.when(F.col("_slice") == F.col("_home"), F.col("_row")))

    order = Window.partitionBy("_mid", "_slice").orderBy("_ts", "_seq")
    left_alone = (
        F.col("_next_ts").isNull()
        | (F.col("_next_ts") >= F.col("_ts") + within_ms)
        | F.col("_next_start")
    )
    return (
        cut.drop("_home")
        .withColumn("_next_ts", F.lead("_ts").over(order))
        .withColumn("_next_start", F.lead("_start").over(order))
        .where(F.col("_row").isNotNull() & left_alone)
        .select("_row.*")
    )
