"""The named queries, each a function of (spark, folder of input tables).

Every query reads whole tables.  Window bounds leave as text and processing
stamps stay out, so that results can be compared with another SQL engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import schemas as s
from tidewell.functions import time
from tidewell.functions.text import keywords
from tidewell.functions.time import day_of_millis
from tidewell.operators import changes as ch
from tidewell.operators.changes import Feed
from tidewell.operators import dims, joins, logs, merge, state
from tidewell.operators.windows import as_text
from tidewell.plans import dim, summary, tool, trade, traffic
from tidewell.session import tuned
from tidewell.sinks.messages import to_messages
from tidewell.sources import tables
from tidewell.streaming.replay import Replay

Query = Callable[[SparkSession, str], DataFrame]

SIZES = {"10s": "10 seconds", "1d": "1 day"}
LIMITS = {"10s": 10_000, "1h": 3_600_000, "6h": 21_600_000}


class Inputs:
    """The warehouse's inputs over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tuned(spark, "UTC")
        self.folder = folder

    @property
    def pages(self) -> DataFrame:
        return tables.page_views(self.spark, self.folder)

    @property
    def searched_pages(self) -> DataFrame:
        return tables.page_views(self.spark, self.folder, items=True)

    @property
    def log(self) -> DataFrame:
        return traffic.clean_log(self.messages)

    @property
    def messages(self) -> DataFrame:
        return tables.log_messages(self.spark, self.folder)

    @property
    def changes(self) -> Feed:
        return tables.change_feed(self.spark, self.folder)

    @property
    def master(self) -> DataFrame:
        return tables.master_change_log(self.spark, self.folder)

    @property
    def dic(self) -> DataFrame:
        return tables.base_dic(self.spark)

    @property
    def config(self) -> DataFrame:
        return tables.dim_config_log(self.spark)

    @property
    def wide(self) -> DataFrame:
        return trade.order_wide(self.changes, self.dic)

    @property
    def placed(self) -> DataFrame:
        return trade.order_placed(self.wide)

    @property
    def payments(self) -> DataFrame:
        return trade.payment_detail(self.placed, self.changes, self.dic)

    @property
    def payers(self) -> DataFrame:
        """Payments without activity and coupon, which a count of payers never reads."""
        placed = trade.order_placed(trade.order_wide(self.changes, self.dic, widen=False))
        return trade.payment_detail(placed, self.changes, self.dic)

    @property
    def cart_adds(self) -> DataFrame:
        return trade.cart_add(self.changes, self.dic)


def _query(body: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, folder: body(Inputs(spark, folder))


def _settled(rows: DataFrame) -> DataFrame:
    """Without processing stamps and the `old` map."""
    return rows.drop("row_op_ts", "old")


def _flat(pages: DataFrame, *extra: str) -> DataFrame:
    return pages.select("seq", "common.*", "page.page_id", "page.last_page_id", *extra, "ts")


def _log_part(rows: DataFrame, *extra) -> DataFrame:
    return rows.select("seq", "common.mid", "common.is_new", *extra)


def _number(variant: str, path: str, name: str):
    return F.try_variant_get(variant, path, "bigint").alias(name)


def _word_counts(texts: DataFrame) -> DataFrame:
    words = texts.select(F.explode(keywords("text")).alias("keyword"))
    return words.groupBy("keyword").agg(F.count("*").alias("keyword_count"))


def _event_days(i: Inputs, events: DataFrame | None = None) -> DataFrame:
    events = tables.table(i.spark, i.folder, "events") if events is None else events
    return events.select(
        "user_id", "event_type", "event_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("last_visit"),
        F.floor(F.col("value") * 100).cast("bigint").alias("cost"),
    )


def _paid_near_update(i: Inputs, bound: str) -> DataFrame:
    """Payments and order updates that the join state still holds together."""
    updates = trade.order_versions(i.changes).where("type = 'update'").select(
        "oi_id", "order_status", F.col("event_time").alias("oi_time")
    )
    paid = trade.payments(i.changes).select("pay_order", "callback_time", "pay_time")
    met = joins.bounded_join(
        paid, updates, F.col("pay_order") == F.col("oi_id"), ("pay_time", "oi_time"), bound
    )
    return met.select(F.col("pay_order").alias("order_id"), "callback_time", "order_status")


def _dimension_cells(i: Inputs) -> DataFrame:
    rows = dim.dimension_upserts(i.master, i.config)
    return rows.select("sink_table", "pk", "version", F.explode("data").alias("name", "value"))


def _sku(i: Inputs) -> DataFrame:
    rows = dim.dimension_state(i.master, i.config)
    return dims.configured_table(rows, dims.current_config(i.config), "dim_sku")


def _landed(i: Inputs) -> Feed:
    """Cart and coupon changes as JSON messages of one topic, read back from their text."""
    fields = F.struct("database", "table", "type", "data", "old", "ts")
    texts = [
        i.changes(name).select(F.to_json(fields).alias("value"), "seq")
        for name in ("cart_info", "coupon_use")
    ]
    return ch.feed(ch.parse(texts[0].unionByName(texts[1]), s.TYPED_CHANGE))


def _time_texts(i: Inputs) -> DataFrame:
    """Dates and times as text and back, yesterday, and days since a fixed day."""
    events = tables.table(i.spark, i.folder, "events")
    ms = events.select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    texts = ms.select(
        "event_id",
        "ms",
        time.date_text("ms").alias("day"),
        time.date_time_text("ms").alias("second"),
        time.partition_date_text("ms").alias("partition"),
        time.yesterday("ms").cast("string").alias("day_before"),
        time.days_between(day_of_millis("ms"), F.to_date(F.lit("2024-01-01"))).alias("days"),
    )
    return texts.withColumns(
        {
            "day_ms": time.millis_of_text("day"),
            "second_ms": time.millis_of_text("second", with_time=True),
        }
    )


def _dimension_sizes(i: Inputs) -> DataFrame:
    rows = dim.dimension_state(i.master, i.config)
    return rows.groupBy("sink_table").agg(
        F.count("*").alias("n"), F.sum(F.size("data")).alias("cells")
    )


DAY_KEYS = ["user_id", "day", "event_type"]
DAY_RULES = {"last_visit": "replace", "cost": "sum", "max_dwell": "max", "min_dwell": "min"}


def _dwells(days: DataFrame) -> DataFrame:
    return days.withColumns({"max_dwell": F.col("cost"), "min_dwell": F.col("cost")})


def _merged_days(i: Inputs) -> DataFrame:
    return merge.aggregate_key_merge(_dwells(_event_days(i)), DAY_KEYS, DAY_RULES, "event_id")


def _merged_stream(i: Inputs, replay: Replay) -> DataFrame:
    """The same rules in a keyed table fed by several micro-batches, each of them repeated."""
    rows = _dwells(_event_days(i, replay.sliced("events")))
    return replay.merged(rows, DAY_KEYS, {**DAY_RULES, "event_id": "max"}).where("user_id >= 0").drop("event_id")


def _login_days(i: Inputs) -> DataFrame:
    """Unique and returning logins per user and day."""
    firsts = state.first_times_of_day(
        summary.login_visits(i.pages), ["uid"], "ts", day_of_millis("ts")
    )
    gap = F.date_diff("day", "previous_day")
    return state.with_previous_day(firsts, "uid").select(
        "uid", "ts", F.when(gap >= summary.BACK_AFTER_DAYS, 1).otherwise(0).alias("back")
    )


def queries() -> dict[str, Query]:
    named: dict[str, Callable[[Inputs], DataFrame]] = {
        # Log layer
        "log_errors": lambda i: _log_part(
            logs.errors(i.log), "page.page_id", _number("err", "$.error_code", "error_code"), "ts"
        ),
        "log_starts": lambda i: _log_part(
            logs.starts(i.log), _number("start", "$.loading_time", "loading_time"), "ts"
        ),
        "log_displays": lambda i: _log_part(
            logs.displays(i.log), "page.page_id", _number("display", "$.item", "item"), "ts"
        ),
        "log_actions": lambda i: _log_part(
            logs.actions(i.log), "page.page_id", _number("action", "$.action_id", "action_id")
        ),
        "log_pages": lambda i: _flat(logs.pages(i.log), "page.during_time"),
        "log_dirty": lambda i: logs.dirty(logs.parse(i.messages)),
        "log_routed_topics": lambda i: logs.route(i.log)
        .groupBy("topic", "seq")
        .agg(F.count("*").alias("n")),
        "log_routed_messages": lambda i: logs.route(i.log),
        "visitor_flag_repair": lambda i: state.repair_new_visitors(i.pages).select(
            "seq", "common.mid", "common.is_new"
        ),
        "unique_visitor_detail": lambda i: _flat(
            traffic.unique_visitors(i.pages), "page.during_time"
        ),
        **{
            f"user_jump_detail_{name}": lambda i, ms=ms: _flat(traffic.user_jumps(i.pages, ms))
            for name, ms in LIMITS.items()
        },
        # Trade layer
        "cart_add_detail": lambda i: i.cart_adds,
        "cart_add_from_messages": lambda i: trade.cart_add(_landed(i), i.dic),
        "coupon_order_from_messages": lambda i: tool.coupon_order(_landed(i)),
        "cart_add_messages": lambda i: to_messages(i.cart_adds, s.CART_ADD),
        "event_time_texts": _time_texts,
        "order_wide_detail": lambda i: i.wide.withColumn(
            "old_status", F.col("old")["order_status"]
        ).drop("old", "row_op_ts"),
        "order_wide_upserted": lambda i: _settled(
            trade.order_wide_newest(i.changes, i.dic)
        ),
        "order_placed_detail": lambda i: _settled(i.placed),
        "order_cancel_detail": lambda i: _settled(trade.order_cancelled(i.wide)),
        "payment_detail": lambda i: _settled(i.payments),
        "payment_upserted": lambda i: _settled(
            merge.latest(i.payments, ["order_detail_id"], F.col("ts").cast("bigint"))
        ),
        "payment_order_within_905s": lambda i: _paid_near_update(i, "905 seconds"),
        "payment_order_within_5s": lambda i: _paid_near_update(i, "5 seconds"),
        "order_refund_detail": lambda i: _settled(
            trade.order_refund(i.changes, i.dic)
        ),
        "refund_payment_detail": lambda i: _settled(
            trade.refund_payment(i.changes, i.dic)
        ),
        # Coupons, interaction, users
        "coupon_get_detail": lambda i: tool.coupon_get(i.changes),
        "coupon_order_detail": lambda i: tool.coupon_order(i.changes),
        "coupon_pay_detail": lambda i: tool.coupon_pay(i.changes),
        "favor_add_detail": lambda i: tool.favor_add(i.changes),
        "comment_detail": lambda i: tool.comment(i.changes, i.dic),
        "user_register_detail": lambda i: tool.user_register(i.changes),
        # Words
        "keyword_counts_documents": lambda i: _word_counts(
            tables.table(i.spark, i.folder, "documents")
        ),
        "keyword_counts_conversations": lambda i: _word_counts(
            tables.table(i.spark, i.folder, "conversations")
        ),
        # Merges
        "latest_event_by_user": lambda i: merge.latest(_event_days(i), ["user_id"], "event_id"),
        "aggregate_key_merge": _merged_days,
        "login_days": _login_days,
        # Dimensions
        "dimension_cells": _dimension_cells,
        "dimension_sku": _sku,
        "dimension_sizes": _dimension_sizes,
    }
    for name, size in SIZES.items():
        named |= {
            f"keyword_window_{name}": lambda i, z=size: as_text(summary.keyword_window(i.searched_pages, z)),
            f"traffic_window_{name}": lambda i, z=size: as_text(
                summary.traffic_window(
                    i.pages, traffic.unique_visitors(i.pages), traffic.user_jumps(i.pages), z
                )
            ),
            f"page_window_{name}": lambda i, z=size: as_text(summary.page_window(i.pages, z)),
            f"login_window_{name}": lambda i, z=size: as_text(summary.login_window(i.pages, z)),
            f"register_window_{name}": lambda i, z=size: as_text(
                summary.register_window(tool.user_register(i.changes), z)
            ),
            f"cart_window_{name}": lambda i, z=size: as_text(summary.cart_window(i.cart_adds, z)),
            f"cart_window_every_add_{name}": lambda i, z=size: as_text(
                summary.cart_window(i.cart_adds, z, every_add=True)
            ),
            f"payer_window_{name}": lambda i, z=size: as_text(summary.payer_window(i.payers, z)),
        }
    named |= _streamed()
    return {name: _query(body) for name, body in named.items()}


def _streamed() -> dict[str, Callable[[Inputs], DataFrame]]:
    """The same results by the streaming operators: the tables arrive as streams."""

    def replay(i: Inputs) -> Replay:
        return Replay(i.spark, i.folder)

    def measured(*names: str):
        return lambda i: as_text(replay(i).window(*names))

    def detail(*names: str):
        return lambda i: _settled(replay(i).detail(*names))

    placed = ("order_wide", "order_placed")
    return {
        "stream_log_routed_topics": lambda i: replay(i)
        .routed_topics()
        .groupBy("topic", "seq")
        .agg(F.count("*").alias("n")),
        "stream_log_routed_messages": lambda i: replay(i).routed_topics(),
        "stream_log_dirty": lambda i: replay(i).dirty(),
        "stream_unique_visitor_detail": lambda i: _flat(
            replay(i).visits("unique_visitor"), "page.during_time"
        ),
        "stream_user_jump_detail_10s": lambda i: _flat(replay(i).visits("user_jump")),
        "stream_traffic_window_1d": measured("unique_visitor", "user_jump", "traffic_window"),
        "stream_keyword_window_1d": measured("keyword_window"),
        "stream_page_window_1d": measured("page_measures", "page_window"),
        "stream_login_window_1d": measured("login_measures", "login_window"),
        "stream_register_window_1d": measured("user_register", "register_measures", "register_window"),
        "stream_cart_window_1d": measured("cart_add", "cart_measures", "cart_window"),
        "stream_payer_window_1d": measured(*placed, "payment", "payer_measures", "payer_window"),
        "stream_payer_window_changes": lambda i: as_text(
            replay(i).summed_changes(*placed, "payment", "payer_measures", "payer_window")
        ),
        "stream_cart_add_detail": detail("cart_add"),
        "stream_comment_detail": detail("comment"),
        **{
            f"stream_{name}_detail": detail(name)
            for name in ("coupon_get", "coupon_order", "coupon_pay", "favor_add", "user_register")
        },
        "stream_order_placed_detail": detail(*placed),
        "stream_order_cancel_detail": detail("order_wide", "order_cancelled"),
        "stream_order_wide_upserted": lambda i: _settled(replay(i).upserted("order_wide")),
        "stream_payment_detail": detail(*placed, "payment"),
        "stream_payment_upserted": lambda i: _settled(replay(i).upserted("payment", *placed)),
        "stream_payment_order_within_905s": lambda i: replay(i).paid_near_update("905 seconds"),
        "stream_order_refund_detail": detail("order_refund"),
        "stream_refund_payment_detail": detail("refund_payment"),
        "stream_aggregate_key_merge": lambda i: _merged_stream(i, replay(i)),
        "stream_dimension_tables": lambda i: replay(i).dimension_tables(),
        "stream_dimension_sku": lambda i: dims.configured_table(
            replay(i).dimensions(), dims.current_config(i.config), "dim_sku"
        ),
    }
