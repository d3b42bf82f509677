"""Cleaning and routing of application logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.schemas import CORRUPT, RAW_LOG

# Topics of the traffic layer
PAGE = "dwd_traffic_page_log"
START = "dwd_traffic_start_log"
DISPLAY = "dwd_traffic_display_log"
ACTION = "dwd_traffic_action_log"
ERROR = "dwd_traffic_error_log"
DIRTY = "dirty_data"


def parse(messages: DataFrame) -> DataFrame:
    """Read the JSON text of each message once.

    ``inline`` keeps the parse in a node of its own, so that later filters on
    parsed fields do not make Spark parse the text a second time.
    """
    schema = T.StructType([*RAW_LOG.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    return messages.where("value is not null").select("value", "seq", F.inline(F.array(record)))


def _is_clean() -> Column:
    return F.col(CORRUPT).isNull() & F.col("common").isNotNull()


def clean(parsed: DataFrame) -> DataFrame:
    """Records that are readable JSON objects with a `common` part."""
    return parsed.where(_is_clean()).drop("value", CORRUPT)


def heads(messages: DataFrame) -> DataFrame:
    """Visitor, flag and time of the clean records, read without the rest of the text."""
    schema = "common struct<mid:string,is_new:string>, ts bigint, _corrupt string"
    record = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = messages.where("value is not null").select("seq", F.inline(F.array(record)))
    return parsed.where(_is_clean()).drop(CORRUPT)


def dirty(parsed: DataFrame) -> DataFrame:
    """The untouched text of every other message."""
    return parsed.where(~_is_clean()).select("value", "seq")


def errors(log: DataFrame) -> DataFrame:
    """Whole records that carry an error."""
    return log.where("err is not null")


def starts(log: DataFrame) -> DataFrame:
    """Application starts; a start record yields nothing but itself."""
    return log.where("start is not null").drop("err")


def displays(log: DataFrame) -> DataFrame:
    """One row per displayed item."""
    return log.where("start is null").select(
        F.explode("displays").alias("display"), "common", "page", "ts", "seq"
    )


def actions(log: DataFrame) -> DataFrame:
    """One row per action.  Action rows carry no record time."""
    return log.where("start is null").select(
        F.explode("actions").alias("action"), "common", "page", "seq"
    )


def pages(log: DataFrame) -> DataFrame:
    """Page views: every record that is not an application start."""
    return log.where("start is null").select("common", "page", "ts", "seq")


def route(log: DataFrame) -> DataFrame:
    """All outputs of a clean log in one pass: (topic, value, seq) rows.

    The record is read once and fans out inside the task, so a sink partitioned
    by topic needs neither a cache nor one scan per output.
    """

    def message(topic: str, *fields: Column | str) -> Column:
        return F.struct(F.lit(topic).alias("topic"), F.to_json(F.struct(*fields)).alias("value"))

    none = F.array().cast("array<struct<topic:string,value:string>>")
    error = message(ERROR, "common", "page", "start", "displays", "actions", "err", "ts")
    start = message(START, "common", "page", "start", "displays", "actions", "ts")
    shown = F.transform(
        "displays", lambda d: message(DISPLAY, d.alias("display"), "common", "page", "ts")
    )
    acted = F.transform("actions", lambda a: message(ACTION, a.alias("action"), "common", "page"))
    page = message(PAGE, "common", "page", "ts")

    outputs = F.concat(
        F.when(F.col("err").isNotNull(), F.array(error)).otherwise(none),
        F.when(F.col("start").isNotNull(), F.array(start)).otherwise(
            F.concat(F.coalesce(shown, none), F.coalesce(acted, none), F.array(page))
        ),
    )
    return log.select(F.inline(outputs), "seq")


# --------------------------------------------------------------------------
# Filters on page views
# --------------------------------------------------------------------------
def session_starts(pages: DataFrame) -> DataFrame:
    return pages.where("page.last_page_id is null")


def home_and_detail(pages: DataFrame) -> DataFrame:
    return pages.where(F.col("page.page_id").isin("home", "good_detail"))


def logins(pages: DataFrame) -> DataFrame:
    last = F.col("page.last_page_id")
    return pages.where(F.col("common.uid").isNotNull() & (last.isNull() | (last == "login")))


def searches(pages: DataFrame) -> DataFrame:
    return pages.where(
        F.col("page.item").isNotNull()
        & (F.col("page.last_page_id") == "search")
        & (F.col("page.item_type") == "keyword")
    )
