"""Traffic detail: clean logs, unique visitors, bounces."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewell.functions.time import day_of_millis
from tidewell.operators import logs, state


def clean_log(messages: DataFrame) -> DataFrame:
    """Readable records with corrected new-visitor flags."""
    return state.repair_new_visitors(logs.clean(logs.parse(messages)), logs.heads(messages))


def unique_visitors(pages: DataFrame) -> DataFrame:
    """First session start of each visitor on each day."""
    return state.first_rows_of_day(
        logs.session_starts(pages), "common.mid", day_of_millis("ts"), "ts", "seq"
    )


def user_jumps(pages: DataFrame, within_ms: int = 10_000) -> DataFrame:
    """Session starts that were left without a second page."""
    return state.bounces(pages, within_ms)
