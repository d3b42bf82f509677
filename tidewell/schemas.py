"""Every declared schema of the warehouse, in one place.

Nothing is inferred: sources are read with these types, sinks are written with
these column lists.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# --------------------------------------------------------------------------
# Transport: one message of a topic.  `seq` is the arrival order (the offset).
# --------------------------------------------------------------------------
MESSAGE = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("seq", T.LongType())]
)

TOPIC_MESSAGE = T.StructType([T.StructField("topic", T.StringType()), *MESSAGE.fields])

# --------------------------------------------------------------------------
# Application log
# --------------------------------------------------------------------------
COMMON = _strings("mid", "uid", "vc", "ch", "ar", "is_new")

PAGE = T.StructType(
    [
        T.StructField("page_id", T.StringType()),
        T.StructField("last_page_id", T.StringType()),
        T.StructField("item", T.StringType()),
        T.StructField("item_type", T.StringType()),
        T.StructField("during_time", T.LongType()),
    ]
)

# Free-form parts stay VARIANT, so they are written back as the objects they were.
CORRUPT = "_corrupt"
RAW_LOG = T.StructType(
    [
        T.StructField("common", COMMON),
        T.StructField("page", PAGE),
        T.StructField("start", T.VariantType()),
        T.StructField("displays", T.ArrayType(T.VariantType())),
        T.StructField("actions", T.ArrayType(T.VariantType())),
        T.StructField("err", T.VariantType()),
        T.StructField("ts", T.LongType()),
    ]
)

# The cleaned page view, the main fact of the traffic layer.
PAGE_VIEW = T.StructType(
    [
        T.StructField("common", COMMON),
        T.StructField("page", PAGE),
        T.StructField("ts", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

# --------------------------------------------------------------------------
# Database changes
# --------------------------------------------------------------------------
TEXT_MAP = T.MapType(T.StringType(), T.StringType())

# Columns the detail tables take from each source table.
SOURCE_COLUMNS = {
    "cart_info": ["id", "user_id", "sku_id", "source_id", "source_type", "sku_num"],
    "order_detail": [
        "id", "order_id", "sku_id", "sku_name", "create_time", "source_id", "source_type",
        "sku_num", "order_price", "split_total_amount", "split_activity_amount",
        "split_coupon_amount",
    ],
    "order_info": ["id", "user_id", "province_id", "operate_time", "order_status"],
    "order_detail_activity": ["order_detail_id", "activity_id", "activity_rule_id"],
    "order_detail_coupon": ["order_detail_id", "coupon_id"],
    "payment_info": ["user_id", "order_id", "payment_type", "callback_time", "payment_status"],
    "order_refund_info": [
        "id", "user_id", "order_id", "sku_id", "refund_type", "refund_num", "refund_amount",
        "refund_reason_type", "refund_reason_txt", "create_time", "refund_status",
    ],
    "refund_payment": [
        "id", "order_id", "sku_id", "payment_type", "callback_time", "total_amount",
        "refund_status",
    ],
    "coupon_use": [
        "id", "coupon_id", "user_id", "order_id", "get_time", "using_time", "used_time",
        "coupon_status",
    ],
    "favor_info": ["id", "user_id", "sku_id", "create_time"],
    "comment_info": ["id", "user_id", "sku_id", "order_id", "create_time", "appraise"],
    "user_info": ["id", "create_time"],
}


def source_columns(*tables: str) -> list[str]:
    """Columns of some source tables (all without names), each once."""
    picked = [c for t in tables or SOURCE_COLUMNS for c in SOURCE_COLUMNS[t]]
    return list(dict.fromkeys(picked))


def _change(record: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("database", T.StringType()),
            T.StructField("table", T.StringType()),
            T.StructField("type", T.StringType()),
            T.StructField("data", record),
            T.StructField("old", record),
            T.StructField("ts", T.StringType()),  # epoch seconds
        ]
    )


# Any table: columns as a map.  For dimensions, whose columns are configured.
CHANGE = _change(TEXT_MAP)

# Known tables: columns as a struct, so that a query reads only the columns it
# names.  `data['id']` reads the same in both; in `old` an unchanged column is null.
TYPED_CHANGE = _change(_strings(*source_columns()))

DICTIONARY = T.StructType(
    [
        T.StructField("dic_code", T.StringType()),
        T.StructField("dic_name", T.StringType()),
        T.StructField("parent_code", T.StringType()),
        T.StructField("create_time", T.TimestampType()),
        T.StructField("operate_time", T.TimestampType()),
    ]
)

DIM_CONFIG = _strings("source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend")

DIM_CONFIG_CHANGE = T.StructType(
    [
        T.StructField("op", T.StringType()),
        T.StructField("before", DIM_CONFIG),
        T.StructField("after", DIM_CONFIG),
        T.StructField("seq", T.LongType()),
    ]
)

DIM_ROW = T.StructType(
    [
        T.StructField("sink_table", T.StringType()),
        T.StructField("pk", T.StringType()),
        T.StructField("data", TEXT_MAP),
        T.StructField("version", T.LongType()),
    ]
)

# --------------------------------------------------------------------------
# Detail tables (column order is the contract of each sink)
# --------------------------------------------------------------------------
CART_ADD = [
    "id", "user_id", "sku_id", "source_id", "source_type_code", "source_type_name", "sku_num", "ts",
]

ORDER_WIDE = [
    "id", "order_id", "user_id", "order_status", "sku_id", "sku_name", "province_id",
    "activity_id", "activity_rule_id", "coupon_id", "date_id", "create_time",
    "operate_date_id", "operate_time", "source_id", "source_type", "source_type_name",
    "sku_num", "split_original_amount", "split_activity_amount", "split_coupon_amount",
    "split_total_amount", "type", "old", "od_ts", "oi_ts", "row_op_ts",
]

ORDER_PLACED = [
    "id", "order_id", "user_id", "sku_id", "sku_name", "province_id", "activity_id",
    "activity_rule_id", "coupon_id", "date_id", "create_time", "source_id",
    "source_type_code", "source_type_name", "sku_num", "split_original_amount",
    "split_activity_amount", "split_coupon_amount", "split_total_amount", "ts", "row_op_ts",
]

ORDER_CANCELLED = [
    "cancel_time" if c == "create_time" else c for c in ORDER_PLACED
]

PAYMENT = [
    "order_detail_id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
    "activity_id", "activity_rule_id", "coupon_id", "payment_type_code",
    "payment_type_name", "callback_time", "source_id", "source_type_code",
    "source_type_name", "sku_num", "split_original_amount", "split_activity_amount",
    "split_coupon_amount", "split_payment_amount", "ts", "row_op_ts",
]

ORDER_REFUND = [
    "id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time",
    "refund_type_code", "refund_type_name", "refund_reason_type_code",
    "refund_reason_type_name", "refund_reason_txt", "refund_num", "refund_amount", "ts",
    "row_op_ts",
]

REFUND_PAYMENT = [
    "id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code",
    "payment_type_name", "date_id", "callback_time", "refund_num", "refund_amount", "ts",
    "row_op_ts",
]

COUPON_GET = ["id", "coupon_id", "user_id", "date_id", "get_time", "ts"]
COUPON_ORDER = ["id", "coupon_id", "user_id", "order_id", "date_id", "order_time", "ts"]
COUPON_PAY = ["id", "coupon_id", "user_id", "order_id", "date_id", "payment_time", "ts"]
FAVOR_ADD = ["id", "user_id", "sku_id", "date_id", "create_time", "ts"]
COMMENT = [
    "id", "user_id", "sku_id", "order_id", "date_id", "create_time", "appraise_code",
    "appraise_name", "ts",
]
USER_REGISTER = ["user_id", "date_id", "create_time", "ts"]

_NOT_TEXT = {
    "row_op_ts": T.TimestampType(),
    "old": _strings(*SOURCE_COLUMNS["order_info"]),
}


def detail_schema(columns: list[str]) -> T.StructType:
    """Stored type of a detail table: text, but for the stamp and the `old` values."""
    return T.StructType([T.StructField(c, _NOT_TEXT.get(c, T.StringType())) for c in columns])


# --------------------------------------------------------------------------
# Summary tables: key columns, then metrics (merge rule per metric)
# --------------------------------------------------------------------------
KEYWORD_KEYS = ["stt", "edt", "source", "keyword", "cur_date"]
KEYWORD_METRICS = ["keyword_count"]
TRAFFIC_KEYS = ["stt", "edt", "vc", "ch", "ar", "is_new", "cur_date"]
TRAFFIC_METRICS = ["uv_ct", "sv_ct", "pv_ct", "dur_sum", "uj_ct"]
WINDOW_KEYS = ["stt", "edt", "cur_date"]
PAGE_METRICS = ["home_uv_ct", "good_detail_uv_ct"]
LOGIN_METRICS = ["back_ct", "uu_ct"]
REGISTER_METRICS = ["register_ct"]
CART_METRICS = ["cart_add_uu_ct"]
PAYER_METRICS = ["payment_suc_unique_user_count", "payment_new_user_count"]

_SUMMARY_TYPES = {
    "stt": T.TimestampType(), "edt": T.TimestampType(), "cur_date": T.DateType(),
    "source": T.StringType(), "keyword": T.StringType(), "vc": T.StringType(),
    "ch": T.StringType(), "ar": T.StringType(), "is_new": T.StringType(),
}


def summary_schema(keys: list[str], metrics: list[str]) -> T.StructType:
    """Stored type of a summary table: typed keys, BIGINT metrics."""
    return T.StructType(
        [T.StructField(k, _SUMMARY_TYPES[k]) for k in keys]
        + [T.StructField(m, T.LongType()) for m in metrics]
    )


# --------------------------------------------------------------------------
# Status and type codes of the business database
# --------------------------------------------------------------------------
ORDER_UNPAID = "1001"
ORDER_PAID = "1002"
ORDER_CANCELLED_CODE = "1003"
ORDER_FINISHED = "1004"
ORDER_REFUNDING = "1005"
ORDER_REFUNDED = "1006"
COUPON_UNUSED = "1401"
COUPON_USING = "1402"
COUPON_USED = "1403"
PAYMENT_SUCCESS = "1602"
REFUND_SUCCESS = "0702"
REFUND_REQUEST_DONE = "0705"
KEYWORD_SEARCH = "SEARCH"
CONTROL_TYPES = ["bootstrap-start", "bootstrap-complete"]
