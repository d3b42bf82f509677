"""Trade detail: carts, orders, cancellations, payments, refunds.

Each function takes a feed of changes and the dictionary (and upstream details),
and returns the rows of one detail table in its declared column order.
`bound` limits how far apart two joined records may lie in event time; streams
need it to forget old rows, batch runs leave it out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell import schemas as s
from tidewell.functions.changes import (
    added_quantity,
    amount,
    changed,
    changed_to,
    has_added,
    new,
    previous,
)
from tidewell.functions.time import from_seconds, text_date
from tidewell.operators import changes as ch
from tidewell.operators.joins import bounded_join, keyed_join, lookup
from tidewell.operators.merge import latest


def cart_add(changes: ch.Feed, dictionary: DataFrame | None) -> DataFrame:
    """Quantity added to carts: new lines and raised quantities."""
    carts = ch.columns(
        ch.table(changes, "cart_info").where(has_added("sku_num")),
        "id", "user_id", "sku_id", "source_id",
        source_type_code=new("source_type"),
        sku_num=added_quantity("sku_num"),
    )
    return lookup(carts, dictionary, "source_type_code", "source_type_name").select(*s.CART_ADD)


def order_details(changes: ch.Feed) -> DataFrame:
    return ch.columns(
        ch.table(changes, "order_detail", "insert"),
        "id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type",
        "sku_num", "split_total_amount", "split_activity_amount", "split_coupon_amount",
        split_original_amount=amount(new("sku_num"), new("order_price")),
    ).withColumnRenamed("ts", "od_ts")


def order_versions(changes: ch.Feed) -> DataFrame:
    orders = ch.table(changes, "order_info", "insert", "update")
    before = F.struct(*[previous(c).alias(c) for c in s.SOURCE_COLUMNS["order_info"]])
    return orders.select(
        new("id").alias("oi_id"),
        new("user_id").alias("user_id"),
        new("province_id").alias("province_id"),
        new("operate_time").alias("operate_time"),
        new("order_status").alias("order_status"),
        "type",
        F.when(F.col("old").isNotNull(), before).alias("old"),
        F.col("ts").alias("oi_ts"),
        from_seconds("ts").alias("event_time"),
    )


def order_wide(
    changes: ch.Feed,
    dictionary: DataFrame | None,
    bound: str | None = None,
    delay: str | None = None,
    widen: bool = True,
) -> DataFrame:
    """One row per order detail and order version, widened by activity, coupon
    and source name.

    Without `widen` the columns of activity and coupon stay null and their changes are not
    read; these left joins never drop a row.

    The dictionary comes first: it drops details with an unknown source before
    anything is shuffled.  In streams activity and coupon share one partitioning by
    detail id; the orders, which multiply the rows by their versions, come last, on the
    left: of the left side Spark also stores rows that the watermark has passed, and
    most wide rows come when it lets the left joins release them.  In batch runs the wide
    rows are shuffled once, by order: activity and coupon come to them with the order of
    their detail, found on narrow rows.
    """
    details = lookup(order_details(changes), dictionary, "source_type", "source_type_name")
    details = details.withColumnRenamed("event_time", "od_time")
    orders = order_versions(changes).withColumnRenamed("event_time", "oi_time")
    if delay:
        details = details.withWatermark("od_time", delay)
        orders = orders.withWatermark("oi_time", delay)
    streams = bound is not None or delay is not None
    if not widen:
        wide = details.withColumns(
            {c: F.lit(None).cast("string") for c in ("activity_id", "activity_rule_id", "coupon_id")}
        )
    else:
        wide = _promoted(details, changes, bound, delay) if streams else details
    wide = bounded_join(
        orders, wide, F.col("order_id") == F.col("oi_id"), ("oi_time", "od_time"), bound
    )
    if widen and not streams:
        found = _promotions(changes)
        same = (F.col("order_id") == F.col("_order")) & (F.col("id") == F.col("_id"))
        wide = wide.join(found, same, "left")
    return _order_wide(wide)


def _order_wide(wide: DataFrame, *without: str) -> DataFrame:
    return (
        wide.withColumn("date_id", text_date("create_time"))
        .withColumn("operate_date_id", text_date("operate_time"))
        .withColumn("row_op_ts", F.current_timestamp())
        .select(*[c for c in s.ORDER_WIDE if c not in without])
    )


def order_wide_newest(changes: ch.Feed, dictionary: DataFrame | None) -> DataFrame:
    """The row of `order_wide` with the greatest `oi_ts` of each detail id, without `old`.

    Each order's newest version (of equal times the placing one) is taken first and brought to
    the details on narrow rows (id and order), newest again for each id, so the wide rows are
    shuffled once, by id. Details without an id are one group and go by `order_wide`.
    """
    newest = F.col("oi_ts").cast("bigint")
    details = lookup(order_details(changes), dictionary, "source_type", "source_type_name")
    details = details.withColumnRenamed("event_time", "od_time")
    placing = F.col("type") == "insert"
    orders = latest(order_versions(changes).drop("event_time", "old"), ["oi_id"], newest, placing)
    lines = details.where("id is not null").select(F.col("id").alias("_id"), F.col("order_id").alias("_order"))
    placed = lines.join(orders, F.col("_order") == F.col("oi_id")).drop("oi_id")
    placed = latest(placed, ["_id"], newest)
    same = (F.col("id") == F.col("_id")) & (F.col("order_id") == F.col("_order"))
    wide = _promoted(details.where("id is not null"), changes, None, None).join(placed, same)
    found = latest(wide.drop("_id", "_order", "od_time", "act_time", "act_detail", "cou_time", "cou_detail"), ["id"], newest)

    def unnamed(name: str) -> DataFrame:
        rows = changes(name)
        return rows.where("data.id is null") if name == "order_detail" else rows

    nameless = order_wide(unnamed, dictionary, widen=False).drop("old")
    return _order_wide(found, "old").unionByName(latest(nameless, ["id"], newest))


def _promotions(changes: ch.Feed) -> DataFrame:
    """Activity and coupon of the details that have one, with `_id` and `_order` of the detail."""
    lines = order_details(changes).select(F.col("id").alias("_id"), F.col("order_id").alias("_order"))
    activities, coupons = _promoting(changes)
    found = lines.repartition("_id").distinct().join(activities, F.col("_id") == F.col("act_detail"), "left")
    found = found.join(coupons, F.col("_id") == F.col("cou_detail"), "left")
    return found.where("act_detail is not null or cou_detail is not null").select(
        "_id", "_order", "activity_id", "activity_rule_id", "coupon_id"
    )


def _promoting(changes: ch.Feed) -> tuple[DataFrame, DataFrame]:
    """Activities and coupons of order details."""
    activities = ch.columns(
        ch.table(changes, "order_detail_activity", "insert"),
        "activity_id", "activity_rule_id", act_detail=new("order_detail_id"),
    ).withColumnRenamed("event_time", "act_time").drop("ts")
    coupons = ch.columns(
        ch.table(changes, "order_detail_coupon", "insert"),
        "coupon_id", cou_detail=new("order_detail_id"),
    ).withColumnRenamed("event_time", "cou_time").drop("ts")
    return activities, coupons


def _promoted(
    details: DataFrame, changes: ch.Feed, bound: str | None, delay: str | None
) -> DataFrame:
    """Order details with their activity and coupon, where they have one."""
    activities, coupons = _promoting(changes)
    if delay:
        activities = activities.withWatermark("act_time", delay)
        coupons = coupons.withWatermark("cou_time", delay)
    with_activity = bounded_join(
        details, activities, F.col("id") == F.col("act_detail"), ("od_time", "act_time"), bound, "left"
    )
    return bounded_join(
        with_activity, coupons, F.col("id") == F.col("cou_detail"), ("od_time", "cou_time"), bound, "left"
    )


def order_placed(wide: DataFrame) -> DataFrame:
    """Order details as they were placed."""
    return (
        wide.where("type = 'insert'")
        .withColumnRenamed("source_type", "source_type_code")
        .withColumnRenamed("od_ts", "ts")
        .select(*s.ORDER_PLACED)
    )


def order_cancelled(wide: DataFrame) -> DataFrame:
    """Order details whose order has just been cancelled."""
    became_cancelled = F.col("old")["order_status"].isNotNull() & (
        F.col("order_status") == s.ORDER_CANCELLED_CODE
    )
    return (
        wide.where((F.col("type") == "update") & became_cancelled)
        .drop("date_id")
        .withColumnsRenamed(
            {
                "operate_date_id": "date_id",
                "operate_time": "cancel_time",
                "source_type": "source_type_code",
                "oi_ts": "ts",
            }
        )
        .select(*s.ORDER_CANCELLED)
    )


def payments(changes: ch.Feed, require_success: bool = False) -> DataFrame:
    """Payment records; `require_success` keeps successful updates only."""
    rows = ch.table(changes, "payment_info")
    if require_success:
        rows = rows.where(
            (F.col("type") == "update") & (new("payment_status") == s.PAYMENT_SUCCESS)
        )
    return ch.columns(
        rows, "callback_time", pay_order=new("order_id"), payment_type_code=new("payment_type")
    ).withColumnsRenamed({"ts": "pay_ts", "event_time": "pay_time"})


def payment_detail(
    placed: DataFrame,
    changes: ch.Feed,
    dictionary: DataFrame | None,
    require_success: bool = False,
    bound: str | None = None,
    join=keyed_join,
) -> DataFrame:
    """Placed order details with the payment of their order.

    In streams `join` is `streaming.meet.stateful_join`: placed details come late and out of
    order, as the joins upstream release them.
    """
    paid = lookup(
        payments(changes, require_success), dictionary, "payment_type_code", "payment_type_name"
    )
    wanted = [c for c in s.ORDER_PLACED if c in s.PAYMENT or c in ("id", "split_total_amount", "ts")]
    placed = placed.select(*wanted).withColumn("od_time", from_seconds("ts")).drop("ts")
    joined = join(placed, paid, ("order_id", "pay_order"), ("od_time", "pay_time"), bound)
    return joined.withColumnsRenamed(
        {"id": "order_detail_id", "split_total_amount": "split_payment_amount", "pay_ts": "ts"}
    ).select(*s.PAYMENT)


def order_refund(
    changes: ch.Feed,
    dictionary: DataFrame | None,
    bound: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Refund requests of orders that turned to refunding."""
    requests = ch.columns(
        ch.table(changes, "order_refund_info", "insert"),
        "id", "user_id", "order_id", "sku_id", "refund_num", "refund_amount",
        "refund_reason_txt", "create_time",
        refund_type_code=new("refund_type"),
        refund_reason_type_code=new("refund_reason_type"),
    ).withColumnRenamed("event_time", "ri_time")
    requests = lookup(requests, dictionary, "refund_type_code", "refund_type_name")
    requests = lookup(requests, dictionary, "refund_reason_type_code", "refund_reason_type_name")
    refunding = ch.columns(
        ch.table(changes, "order_info", "update").where(
            changed_to("order_status", s.ORDER_REFUNDING)
        ),
        "province_id", oi_id=new("id"),
    ).withColumnRenamed("event_time", "oi_time").drop("ts")
    if delay:
        requests = requests.withWatermark("ri_time", delay)
        refunding = refunding.withWatermark("oi_time", delay)
    joined = bounded_join(
        requests, refunding, F.col("order_id") == F.col("oi_id"), ("ri_time", "oi_time"), bound
    )
    return (
        joined.withColumn("date_id", text_date("create_time"))
        .withColumn("row_op_ts", F.current_timestamp())
        .select(*s.ORDER_REFUND)
    )


def refund_payment(
    changes: ch.Feed,
    dictionary: DataFrame | None,
    strict: bool = False,
    bound: str | None = None,
    delay: str | None = None,
) -> DataFrame:
    """Successful refund payments with their order and refund request.

    `strict` also asks for the status changes of all three records.
    """
    paid = ch.table(changes, "refund_payment").where(new("refund_status") == s.REFUND_SUCCESS)
    orders = ch.table(changes, "order_info", "update")
    requests = ch.table(changes, "order_refund_info")
    if strict:
        paid = paid.where((F.col("type") == "update") & changed("refund_status"))
        orders = orders.where(changed_to("order_status", s.ORDER_REFUNDED))
        requests = requests.where(
            (F.col("type") == "update") & changed_to("refund_status", s.REFUND_REQUEST_DONE)
        )

    paid = ch.columns(
        paid, "id", "order_id", "sku_id", "callback_time",
        payment_type_code=new("payment_type"), refund_amount=new("total_amount"),
    ).withColumnRenamed("event_time", "rp_time")
    paid = lookup(paid, dictionary, "payment_type_code", "payment_type_name")
    orders = ch.columns(orders, "user_id", "province_id", oi_id=new("id")).withColumnRenamed(
        "event_time", "oi_time"
    ).drop("ts")
    requests = ch.columns(
        requests, "refund_num", ri_order=new("order_id"), ri_sku=new("sku_id")
    ).withColumnRenamed("event_time", "ri_time").drop("ts")
    if delay:
        paid = paid.withWatermark("rp_time", delay)
        orders = orders.withWatermark("oi_time", delay)
        requests = requests.withWatermark("ri_time", delay)

    joined = bounded_join(
        paid, orders, F.col("order_id") == F.col("oi_id"), ("rp_time", "oi_time"), bound
    )
    joined = bounded_join(
        joined,
        requests,
        (F.col("order_id") == F.col("ri_order")) & (F.col("sku_id") == F.col("ri_sku")),
        ("rp_time", "ri_time"),
        bound,
    )
    return (
        joined.withColumn("date_id", text_date("callback_time"))
        .withColumn("row_op_ts", F.current_timestamp())
        .select(*s.REFUND_PAYMENT)
    )
