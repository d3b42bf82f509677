"""Window summaries of the traffic, user and trade layers.

Functions named ``*_measures`` give one row per contributing record (they also
feed the streaming summaries); the others give the finished summary table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell import schemas as s
from tidewell.functions.text import keywords
from tidewell.functions.time import (
    day_of_millis,
    day_of_seconds,
    from_millis,
    from_millis_whole_seconds,
    from_seconds,
)
from tidewell.operators import logs, state
from tidewell.operators.windows import DEFAULT_SIZE, tumble

BACK_AFTER_DAYS = 8
JUMP_DELAY = "interval 10 seconds"


def _sums(names: list[str]) -> dict:
    return {n: F.sum(n) for n in names}


# --------------------------------------------------------------------------
# Keywords
# --------------------------------------------------------------------------
def search_words(pages: DataFrame) -> DataFrame:
    """One row per word of each search."""
    return logs.searches(pages).select(
        F.explode(keywords("page.item")).alias("keyword"),
        from_millis_whole_seconds("ts").alias("row_time"),
    )


def keyword_window(pages: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    counts = tumble(
        search_words(pages), "row_time", ["keyword"], {"keyword_count": F.count("*")}, size
    )
    return counts.withColumn("source", F.lit(s.KEYWORD_SEARCH)).select(
        *s.KEYWORD_KEYS, *s.KEYWORD_METRICS
    )


# --------------------------------------------------------------------------
# Traffic by version, channel, area and visitor kind
# --------------------------------------------------------------------------
def traffic_measures(
    pages: DataFrame, uniques: DataFrame, jumps: DataFrame, delay: str | None = None
) -> DataFrame:
    """Unit measures of page views, unique visitors and bounces, one feed.

    Bounces count ten seconds later: they are known only after the limit.  In a stream each
    feed has a watermark of its own (`delay`), and the slowest holds the windows open.
    """
    dims = [F.col(f"common.{c}").alias(c) for c in ("vc", "ch", "ar", "is_new")]
    names = s.TRAFFIC_METRICS
    time = from_millis("ts")

    def unit(rows: DataFrame, at, **ones) -> DataFrame:
        measures = rows.select(
            at.alias("event_time"),
            *dims,
            *[ones.get(n, F.lit(0)).cast("bigint").alias(n) for n in names],
        )
        return measures.withWatermark("event_time", delay) if delay else measures

    opened = F.when(F.col("page.last_page_id").isNull(), 1).otherwise(0)
    stay = F.coalesce("page.during_time", F.lit(0))
    return (
        unit(pages, time, sv_ct=opened, pv_ct=F.lit(1), dur_sum=stay)
        .unionByName(unit(jumps, time + F.expr(JUMP_DELAY), uj_ct=F.lit(1)))
        .unionByName(unit(uniques, time, uv_ct=F.lit(1)))
    )


def traffic_window(
    pages: DataFrame, uniques: DataFrame, jumps: DataFrame, size: str = DEFAULT_SIZE
) -> DataFrame:
    measures = traffic_measures(pages, uniques, jumps)
    keys = ["vc", "ch", "ar", "is_new"]
    summed = tumble(measures, "event_time", keys, _sums(s.TRAFFIC_METRICS), size)
    return summed.select(*s.TRAFFIC_KEYS, *s.TRAFFIC_METRICS)


# --------------------------------------------------------------------------
# Home and product page visitors
# --------------------------------------------------------------------------
def page_visits(pages: DataFrame) -> DataFrame:
    return logs.home_and_detail(pages).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), "ts"
    )


def page_measures(firsts: DataFrame) -> DataFrame:
    home = F.col("page_id") == "home"
    return firsts.select(
        from_millis("ts").alias("event_time"),
        F.when(home, 1).otherwise(0).cast("bigint").alias("home_uv_ct"),
        F.when(home, 0).otherwise(1).cast("bigint").alias("good_detail_uv_ct"),
    )


def page_window(pages: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    firsts = state.first_times_of_day(
        page_visits(pages), ["mid", "page_id"], "ts", day_of_millis("ts")
    )
    summed = tumble(page_measures(firsts), "event_time", [], _sums(s.PAGE_METRICS), size)
    return summed.select(*s.WINDOW_KEYS, *s.PAGE_METRICS)


# --------------------------------------------------------------------------
# Logins: unique users and users who come back
# --------------------------------------------------------------------------
def login_visits(pages: DataFrame) -> DataFrame:
    return logs.logins(pages).select(F.col("common.uid").alias("uid"), "ts")


def login_measures(firsts: DataFrame) -> DataFrame:
    """From first logins per day with `day` and `previous_day`."""
    gap = F.date_diff("day", "previous_day")
    return firsts.select(
        from_millis("ts").alias("event_time"),
        F.when(gap >= BACK_AFTER_DAYS, 1).otherwise(0).cast("bigint").alias("back_ct"),
        F.lit(1).cast("bigint").alias("uu_ct"),
    )


def login_window(pages: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    firsts = state.first_times_of_day(login_visits(pages), ["uid"], "ts", day_of_millis("ts"))
    measures = login_measures(state.with_previous_day(firsts, "uid"))
    summed = tumble(measures, "event_time", [], _sums(s.LOGIN_METRICS), size)
    return summed.select(*s.WINDOW_KEYS, *s.LOGIN_METRICS)


# --------------------------------------------------------------------------
# Registrations
# --------------------------------------------------------------------------
def register_window(registrations: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    rows = registrations.select(from_seconds("ts").alias("event_time"))
    return tumble(rows, "event_time", [], {"register_ct": F.count("*")}, size).select(
        *s.WINDOW_KEYS, *s.REGISTER_METRICS
    )


# --------------------------------------------------------------------------
# Users who add to their cart
# --------------------------------------------------------------------------
def cart_window(
    cart_adds: DataFrame, size: str = DEFAULT_SIZE, every_add: bool = False
) -> DataFrame:
    """Unique users per day and window; `every_add` counts every addition."""
    rows = cart_adds.select("user_id", F.col("ts").try_cast("bigint").alias("ts"))
    if not every_add:
        rows = state.first_times_of_day(rows, ["user_id"], "ts", day_of_seconds("ts"))
    rows = rows.select(from_seconds("ts").alias("event_time"))
    return tumble(rows, "event_time", [], {"cart_add_uu_ct": F.count("*")}, size).select(
        *s.WINDOW_KEYS, *s.CART_METRICS
    )


# --------------------------------------------------------------------------
# Paying users
# --------------------------------------------------------------------------
def payer_window(payments: DataFrame, size: str = DEFAULT_SIZE) -> DataFrame:
    """Users with a first payment that day, and with a first payment ever.

    Windows that hold repeat payments only appear with zeros.  One aggregate per
    user and day keeps the first payment and the set of windows the user paid
    in: bounded by the windows of a day however many payments there are, and
    reduced before the shuffle.
    """
    paid_at = F.col("ts").try_cast("bigint")
    slot = F.window(from_seconds("ts"), size).getField("start")
    days = (
        payments.select("user_id", paid_at.alias("ts"))
        .where("ts is not null")
        .select("user_id", "ts", slot.alias("slot"))
        .groupBy("user_id", day_of_seconds("ts").alias("day"))
        .agg(
            F.min("slot").alias("first_slot"), F.collect_set("slot").alias("slots")
        )
    )
    slots = state.with_previous_day(days, "user_id").select(
        F.explode("slots").alias("event_time"), "first_slot", "previous_day"
    )
    unique, first_ever = s.PAYER_METRICS
    is_first = F.col("event_time") == F.col("first_slot")
    measures = slots.select(
        "event_time",
        F.when(is_first, 1).otherwise(0).cast("bigint").alias(unique),
        F.when(is_first & F.col("previous_day").isNull(), 1)
        .otherwise(0)
        .cast("bigint")
        .alias(first_ever),
    )
    summed = tumble(measures, "event_time", [], _sums(s.PAYER_METRICS), size)
    return summed.select(*s.WINDOW_KEYS, *s.PAYER_METRICS)
