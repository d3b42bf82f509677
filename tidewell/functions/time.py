"""Time expressions.  Day boundaries follow ``spark.sql.session.timeZone``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of dates and times
DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
COMPACT_DATE = "yyyyMMdd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_millis(ms: Column | str) -> Column:
    """Event time of an application log (epoch milliseconds)."""
    return F.timestamp_millis(_col(ms))


def from_seconds(s: Column | str) -> Column:
    """Event time of a change record (epoch seconds, as text or number)."""
    return F.timestamp_seconds(_col(s).try_cast("bigint"))


def from_millis_whole_seconds(ms: Column | str) -> Column:
    """Event time cut to whole seconds."""
    return F.date_trunc("second", from_millis(ms))


def day_of_millis(ms: Column | str) -> Column:
    return F.to_date(from_millis(ms))


def day_of_seconds(s: Column | str) -> Column:
    return F.to_date(from_seconds(s))


def yesterday(ms: Column | str) -> Column:
    return F.date_sub(day_of_millis(ms), 1)


def date_text(ms: Column | str) -> Column:
    return F.date_format(from_millis(ms), DATE)


def date_time_text(ms: Column | str) -> Column:
    return F.date_format(from_millis(ms), DATE_TIME)


def partition_date_text(ms: Column | str) -> Column:
    return F.date_format(from_millis(ms), COMPACT_DATE)


def millis_of_text(text: Column | str, with_time: bool = False) -> Column:
    """Epoch milliseconds of a date text, read in the session's zone."""
    fmt = F.lit(DATE_TIME if with_time else DATE)
    return F.unix_millis(F.try_to_timestamp(_col(text), fmt))


def text_date(text: Column | str) -> Column:
    """Date part of a date-time text; null when the text is no date."""
    return F.date_format(_col(text).try_cast("timestamp"), DATE)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.date_diff(_col(later), _col(earlier))
