"""The continuous jobs of the warehouse, chained through folders.

`Warehouse` names the folders under one shared root.  Each job is a function
that starts one streaming query with a checkpoint of its own.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidewell import schemas as s
from tidewell.operators import changes as ch
from tidewell.operators import dims, logs
from tidewell.operators.joins import name_codes
from tidewell.operators.merge import latest
from tidewell.operators.windows import DEFAULT_SIZE, tumble
from tidewell.plans import tool, trade
from tidewell.sinks.batches import BATCH, folder, land
from tidewell.sinks.catalog import CatalogTables
from tidewell.sinks.keyed import KeyedTable
from tidewell.sinks.messages import append
from tidewell.sources import dictionary, streams
from tidewell.streaming import state, windows
from tidewell.streaming.config import ConfigSnapshots
from tidewell.streaming.meet import micros, stateful_join

ORDER_BOUND = "905 seconds"
REFUND_BOUND = "5 seconds"


def _measures(names: list[str]) -> T.StructType:
    return T.StructType(
        [T.StructField("event_time", T.TimestampType())]
        + [T.StructField(n, T.LongType()) for n in names]
    )


DETAILS = {
    "cart_add": s.CART_ADD,
    "order_wide": s.ORDER_WIDE,
    "order_placed": s.ORDER_PLACED,
    "order_cancelled": s.ORDER_CANCELLED,
    "payment": s.PAYMENT,
    "order_refund": s.ORDER_REFUND,
    "refund_payment": s.REFUND_PAYMENT,
    "coupon_get": s.COUPON_GET,
    "coupon_order": s.COUPON_ORDER,
    "coupon_pay": s.COUPON_PAY,
    "favor_add": s.FAVOR_ADD,
    "comment": s.COMMENT,
    "user_register": s.USER_REGISTER,
}
VISITS = {"unique_visitor": s.PAGE_VIEW, "user_jump": s.PAGE_VIEW}
MEASURES = {
    "page_window": s.PAGE_METRICS,
    "login_window": s.LOGIN_METRICS,
    "register_window": s.REGISTER_METRICS,
    "cart_window": s.CART_METRICS,
    "payer_window": s.PAYER_METRICS,
}
SUMMARIES = {
    "keyword_window": (s.KEYWORD_KEYS, s.KEYWORD_METRICS),
    "traffic_window": (s.TRAFFIC_KEYS, s.TRAFFIC_METRICS),
    **{name: (s.WINDOW_KEYS, metrics) for name, metrics in MEASURES.items()},
}
# Keys and versions of the details that replace earlier rows of their key.
UPSERTED = {"order_wide": ("id", "oi_ts"), "payment": ("order_detail_id", "ts")}
# Codes that the dictionary names, when the rows of a micro-batch are stored.
CODES = {
    "cart_add": {"source_type_code": "source_type_name"},
    "order_wide": {"source_type": "source_type_name"},
    "payment": {"payment_type_code": "payment_type_name"},
    "order_refund": {
        "refund_type_code": "refund_type_name", "refund_reason_type_code": "refund_reason_type_name",
    },
    "refund_payment": {"payment_type_code": "payment_type_name"},
    "comment": {"appraise_code": "appraise_name"},
}


@dataclass(frozen=True)
class Warehouse:
    """Folders and settings shared by all jobs."""

    spark: SparkSession
    root: str
    size: str = DEFAULT_SIZE
    jump_ms: int = 10_000
    order_bound: str = ORDER_BOUND
    refund_bound: str = REFUND_BOUND
    # How late a record may come: Spark keeps one watermark per query, so this
    # must cover the disorder between the partitions of a topic.
    delay: str = "10 seconds"
    # How long on the wall clock a placed detail or a payment waits for the other.
    keep: str = "7 days"
    # The dictionary is read again for a micro-batch when it is older than this.
    reload: str = "0 seconds"
    trigger: dict = field(default_factory=lambda: {"processingTime": "3 seconds"})
    source: dict = field(default_factory=dict)  # options of the raw topics' readers
    kafka: str | None = None  # bootstrap servers, when the raw topics are in Kafka
    database: dict | None = None  # options of the dictionary's JDBC reader; else it is a folder
    # Database of the session's catalog in which configured dimensions are tables, if any.
    catalog: str | None = None

    # -- folders ----------------------------------------------------------
    def folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    # -- readers ----------------------------------------------------------
    def messages(self, name: str) -> DataFrame:
        if self.kafka:
            return streams.kafka(self.spark, self.kafka, name, True, **self.source)
        return streams.messages(self.spark, self.folder(name), True, **self.source)

    def pages(self) -> DataFrame:
        page = streams.topic(self.spark, self.folder("traffic"), logs.PAGE, True)
        return streams.page_views(page)

    def changes(self, table: str) -> DataFrame:
        """Changes of one source table; other partitions and columns are not read."""
        schema = T.StructType([*s.TYPED_CHANGE.fields, T.StructField("seq", T.LongType())])
        rows = streams.table(self.spark, self.folder("changes"), schema, True)
        return rows.where(F.col("table") == table)

    def rows(self, name: str, schema: T.StructType, stream: bool = True) -> DataFrame:
        """Rows of a folder, written by a file sink or batch by batch."""
        batched = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
        return streams.table(self.spark, self.folder(name), batched, stream).drop(BATCH)

    def detail(self, name: str, stream: bool = True) -> DataFrame:
        return self.rows(name, s.detail_schema(DETAILS[name]), stream)

    def dictionary(self, spark: SparkSession) -> DataFrame:
        """The newest entry of each code, read now."""
        if self.database:
            rows = dictionary.from_database(spark, **self.database)
        else:
            rows = dictionary.from_files(spark, self.folder("base_dic"))
        return latest(rows, ["dic_code"], F.coalesce("operate_time", "create_time"))

    def named(self, name: str) -> Callable[[DataFrame], DataFrame]:
        """Looks the codes of a micro-batch up in the dictionary as it is then."""
        held: dict = {}

        def finish(batch: DataFrame) -> DataFrame:
            now = time.monotonic()
            if not held or now - held["at"] >= micros(self.reload) / 10**6:
                held.update(at=now, rows=self.dictionary(batch.sparkSession))
            return name_codes(batch, held["rows"], CODES[name])

        return finish

    # -- keyed tables -----------------------------------------------------
    def summary(self, name: str) -> KeyedTable:
        keys, metrics = SUMMARIES[name]
        rules = dict.fromkeys(metrics, "sum") if name == "payer_window" else None
        return KeyedTable(
            self.folder(f"summary/{name}"), s.summary_schema(keys, metrics), keys, ["cur_date"], rules
        )

    def keyed(self, name: str) -> KeyedTable:
        """One row per key of a detail whose later rows replace earlier ones."""
        key, version = UPSERTED[name]
        return KeyedTable(
            self.folder(f"keyed/{name}"), s.detail_schema(DETAILS[name]), [key],
            version=[F.col(version).try_cast("bigint")], buckets=16, fold_every=1, deletes=True,
        )

    def upserted(self, name: str) -> DataFrame:
        return self.keyed(name).read(self.spark)

    def dimensions(self) -> KeyedTable:
        return KeyedTable(
            self.folder("dimensions"), s.DIM_ROW, ["sink_table", "pk"], ["sink_table"],
            version=["version"],
        )

    def config(self) -> ConfigSnapshots:
        return ConfigSnapshots(f"{self.dimensions().path}/_config")

    def dimension_tables(self) -> CatalogTables:
        return CatalogTables(self.folder("dimension_tables"), self.catalog)

    def dimension(self, sink_table: str) -> DataFrame:
        """A dimension with the columns its configuration names."""
        config = dims.current_config(streams.config_changes(self.spark, self.folder("table_process")))
        return dims.configured_table(self.dimensions().read(self.spark), config, sink_table)

    # -- writers ----------------------------------------------------------
    def append(self, name: str, rows: DataFrame, partition_by: list[str] | None = None):
        return append(
            rows, self.folder(name), self.checkpoint(name), partition_by, trigger=self.trigger
        )

    def land(self, name: str, rows: DataFrame) -> StreamingQuery:
        """Append the rows of a detail, their codes named batch by batch."""
        return land(rows, self.folder(name), self.checkpoint(name), self.named(name), trigger=self.trigger)

    def upsert(self, name: str, rows: DataFrame) -> StreamingQuery:
        return self.summary(name).upsert(rows, trigger=self.trigger)


# --------------------------------------------------------------------------
# Traffic
# --------------------------------------------------------------------------
def traffic(w: Warehouse) -> StreamingQuery:
    """Clean, repair and route the raw log; one sink partitioned by topic.

    A micro-batch is stored once with the days of its visitors and read again for the repair,
    so the keyed state is advanced once and no record passes through it.
    """

    def repaired(batch: DataFrame) -> DataFrame:
        aside = f"{w.folder('traffic')}/_raw"
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(aside)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(aside)
        return logs.route(state.repair_new_visitors(stored))

    rows = state.messages_with_days(w.messages("topic_log"))
    return land(rows, w.folder("traffic"), w.checkpoint("traffic"), repaired, ["topic"], w.trigger)


def dirty(w: Warehouse) -> StreamingQuery:
    return w.append(logs.DIRTY, logs.dirty(logs.parse(w.messages("topic_log"))))


def unique_visitor(w: Warehouse) -> StreamingQuery:
    return w.append("unique_visitor", state.unique_visitors(w.pages(), w.delay))


def user_jump(w: Warehouse) -> StreamingQuery:
    return w.append("user_jump", state.bounces(w.pages(), w.jump_ms, w.delay))


# --------------------------------------------------------------------------
# Changes and details
# --------------------------------------------------------------------------
def changes(w: Warehouse) -> StreamingQuery:
    """Land the changes of the known tables as typed rows partitioned by table."""
    rows = ch.parse(w.messages("topic_db"), s.TYPED_CHANGE)
    known = rows.where(F.col("table").isin(*s.SOURCE_COLUMNS))
    return w.append("changes", known, ["table"])


def cart_add(w: Warehouse) -> StreamingQuery:
    return w.land("cart_add", trade.cart_add(w.changes, None))


def order_wide(w: Warehouse) -> StreamingQuery:
    return w.land("order_wide", trade.order_wide(w.changes, None, w.order_bound, w.delay))


def order_placed(w: Warehouse) -> StreamingQuery:
    return w.append("order_placed", trade.order_placed(w.detail("order_wide")))


def order_cancelled(w: Warehouse) -> StreamingQuery:
    return w.append("order_cancelled", trade.order_cancelled(w.detail("order_wide")))


def payment(w: Warehouse) -> StreamingQuery:
    rows = trade.payment_detail(
        w.detail("order_placed"), w.changes, None, bound=w.order_bound, join=stateful_join(w.keep)
    )
    return w.land("payment", rows)


def order_refund(w: Warehouse) -> StreamingQuery:
    return w.land("order_refund", trade.order_refund(w.changes, None, w.refund_bound, w.delay))


def refund_payment(w: Warehouse) -> StreamingQuery:
    rows = trade.refund_payment(w.changes, None, bound=w.refund_bound, delay=w.delay)
    return w.land("refund_payment", rows)


def keyed_of(name: str):
    """The job that keeps one row per key of a detail."""

    def job(w: Warehouse) -> StreamingQuery:
        return w.keyed(name).upsert(w.detail(name), "append", w.trigger)

    return job


def coupon_get(w: Warehouse) -> StreamingQuery:
    return w.append("coupon_get", tool.coupon_get(w.changes))


def coupon_order(w: Warehouse) -> StreamingQuery:
    return w.append("coupon_order", tool.coupon_order(w.changes))


def coupon_pay(w: Warehouse) -> StreamingQuery:
    return w.append("coupon_pay", tool.coupon_pay(w.changes))


def favor_add(w: Warehouse) -> StreamingQuery:
    return w.append("favor_add", tool.favor_add(w.changes))


def comment(w: Warehouse) -> StreamingQuery:
    return w.land("comment", tool.comment(w.changes, None))


def user_register(w: Warehouse) -> StreamingQuery:
    return w.append("user_register", tool.user_register(w.changes))


# --------------------------------------------------------------------------
# Dimensions
# --------------------------------------------------------------------------
def dimensions(w: Warehouse) -> StreamingQuery:
    """Upsert dimension rows; each micro-batch sees the configuration as it is then."""

    def config(spark: SparkSession) -> DataFrame:
        return streams.config_changes(spark, w.folder("table_process"))

    return sync_dimensions(w, ch.parse(w.messages("topic_db")), config)


def sync_dimensions(
    w: Warehouse, changes: DataFrame, config_changes: Callable[[SparkSession], DataFrame]
) -> StreamingQuery:
    """Upsert dimension rows by the configuration's newest snapshot.

    A micro-batch first advances the snapshot by the configuration's changes since the last one;
    tables of the catalog are made and widened by these changes, before their first rows.
    """
    target, snapshots = w.dimensions(), w.config()
    catalog = w.dimension_tables() if w.catalog else None
    if catalog:  # the catalog of a new session may not know the tables yet
        catalog.provide(w.spark, dims.current_config(snapshots.newest(w.spark)))

    def sync(batch: DataFrame, batch_id: int) -> None:
        # Tables are made and written in the warehouse's session, so that it reads them fresh.
        provide = partial(catalog.provide, w.spark) if catalog else None
        log = config_changes(batch.sparkSession)
        config = dims.current_config(snapshots.advance(log, batch_id, provide))
        rows = dims.dimension_rows(batch, config)
        newest = latest(rows, ["sink_table", "pk"], "version", "seq")
        target.write(newest, batch_id)
        if catalog:
            delta = f"{target.path}/kind=delta/{folder(batch_id)}"
            catalog.upsert(w.spark.read.schema(s.DIM_ROW).parquet(delta))

    return (
        changes.writeStream.foreachBatch(sync)
        .option("checkpointLocation", target.checkpoint)
        .trigger(**w.trigger)
        .start()
    )


# --------------------------------------------------------------------------
# Summaries
# --------------------------------------------------------------------------
def keyword_window(w: Warehouse) -> StreamingQuery:
    return w.upsert("keyword_window", windows.keyword_window(w.pages(), w.size))


def traffic_window(w: Warehouse) -> StreamingQuery:
    rows = windows.traffic_window(
        w.pages(),
        w.rows("unique_visitor", s.PAGE_VIEW),
        w.rows("user_jump", s.PAGE_VIEW),
        w.size,
    )
    return w.upsert("traffic_window", rows)


def _measured(w: Warehouse, name: str, rows: DataFrame) -> StreamingQuery:
    return w.append(f"measures/{name}", rows)


def page_measures(w: Warehouse) -> StreamingQuery:
    return _measured(w, "page_window", windows.page_measures(w.pages(), w.delay))


def login_measures(w: Warehouse) -> StreamingQuery:
    return _measured(w, "login_window", windows.login_measures(w.pages(), w.delay))


def register_measures(w: Warehouse) -> StreamingQuery:
    return _measured(w, "register_window", windows.register_measures(w.detail("user_register")))


def cart_measures(w: Warehouse) -> StreamingQuery:
    return _measured(w, "cart_window", windows.cart_measures(w.detail("cart_add"), delay=w.delay))


def payer_measures(w: Warehouse) -> StreamingQuery:
    return _measured(w, "payer_window", windows.payer_measures(w.detail("payment")))


def payer_window(w: Warehouse) -> StreamingQuery:
    """Sums the signed measures of each micro-batch; the table adds the sums up."""
    table = w.summary("payer_window")

    def add(batch: DataFrame, number: int) -> None:
        sums = {n: F.sum(n) for n in s.PAYER_METRICS}
        table.write(tumble(batch, "event_time", [], sums, w.size), number)

    return (
        w.rows("measures/payer_window", _measures(s.PAYER_METRICS))
        .writeStream.foreachBatch(add)
        .option("checkpointLocation", table.checkpoint)
        .trigger(**w.trigger)
        .start()
    )


def window_of(name: str):
    """The job that sums the measures of one summary per window."""

    def job(w: Warehouse) -> StreamingQuery:
        rows = w.rows(f"measures/{name}", _measures(MEASURES[name]))
        return w.upsert(name, windows.measures_window(rows, MEASURES[name], w.size, w.delay))

    return job


# Every job, upstream first.
JOBS = {
    "traffic": traffic,
    "dirty": dirty,
    "unique_visitor": unique_visitor,
    "user_jump": user_jump,
    "changes": changes,
    "dimensions": dimensions,
    "cart_add": cart_add,
    "order_wide": order_wide,
    "order_placed": order_placed,
    "order_cancelled": order_cancelled,
    "payment": payment,
    "order_refund": order_refund,
    "refund_payment": refund_payment,
    "coupon_get": coupon_get,
    "coupon_order": coupon_order,
    "coupon_pay": coupon_pay,
    "favor_add": favor_add,
    "comment": comment,
    "user_register": user_register,
    "keyword_window": keyword_window,
    "traffic_window": traffic_window,
    "page_measures": page_measures,
    "login_measures": login_measures,
    "register_measures": register_measures,
    "cart_measures": cart_measures,
    "payer_measures": payer_measures,
    **{name: window_of(name) for name in MEASURES if name != "payer_window"},
    "payer_window": payer_window,
    **{f"{name}_keyed": keyed_of(name) for name in UPSERTED},
}
