"""Coupons, favourites, comments and registrations: one change, one row."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidewell import schemas as s
from tidewell.functions.changes import changed_from_to, new
from tidewell.functions.time import text_date
from tidewell.operators import changes as ch
from tidewell.operators.joins import lookup


def coupon_get(changes: ch.Feed) -> DataFrame:
    """Coupons handed out."""
    return ch.columns(
        ch.table(changes, "coupon_use", "insert"),
        "id", "coupon_id", "user_id", "get_time", date_id=text_date(new("get_time")),
    ).select(*s.COUPON_GET)


def coupon_order(changes: ch.Feed) -> DataFrame:
    """Coupons put on an order."""
    rows = ch.table(changes, "coupon_use", "update").where(
        changed_from_to("coupon_status", s.COUPON_UNUSED, s.COUPON_USING)
    )
    return ch.columns(
        rows, "id", "coupon_id", "user_id", "order_id",
        date_id=text_date(new("using_time")), order_time=new("using_time"),
    ).select(*s.COUPON_ORDER)


def coupon_pay(changes: ch.Feed) -> DataFrame:
    """Coupons redeemed by a payment."""
    rows = ch.table(changes, "coupon_use", "update").where(new("used_time").isNotNull())
    return ch.columns(
        rows, "id", "coupon_id", "user_id", "order_id",
        date_id=text_date(new("used_time")), payment_time=new("used_time"),
    ).select(*s.COUPON_PAY)


def favor_add(changes: ch.Feed) -> DataFrame:
    return ch.columns(
        ch.table(changes, "favor_info", "insert"),
        "id", "user_id", "sku_id", "create_time", date_id=text_date(new("create_time")),
    ).select(*s.FAVOR_ADD)


def comment(changes: ch.Feed, dictionary: DataFrame | None) -> DataFrame:
    """Comments with the name of their grade."""
    rows = ch.columns(
        ch.table(changes, "comment_info", "insert"),
        "id", "user_id", "sku_id", "order_id", "create_time",
        date_id=text_date(new("create_time")), appraise_code=new("appraise"),
    )
    return lookup(rows, dictionary, "appraise_code", "appraise_name").select(*s.COMMENT)


def user_register(changes: ch.Feed) -> DataFrame:
    return ch.columns(
        ch.table(changes, "user_info", "insert"),
        "create_time", user_id=new("id"), date_id=text_date(new("create_time")),
    ).select(*s.USER_REGISTER)
