"""The star-schema and event tables seen as the warehouse's inputs.

Gives the page views, raw log messages, change records, dictionary and
dimension configuration that the queries run on.  Everything is derived by
Spark from whole tables; what varies per row comes from the row's own columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell import schemas as s
from tidewell.operators.changes import Feed
from tidewell.sources import literal

# Dictionary of the business database
DICTIONARY_ENTRIES = [
    ("1001", "unpaid", "10"),
    ("1002", "paid", "10"),
    ("1003", "cancelled", "10"),
    ("1004", "finished", "10"),
    ("1005", "refunding", "10"),
    ("1006", "refunded", "10"),
    ("1101", "alipay", "11"),
    ("1102", "wechat pay", "11"),
    ("1103", "union pay", "11"),
    ("1201", "good", "12"),
    ("1202", "fair", "12"),
    ("1203", "poor", "12"),
    ("1204", "automatic", "12"),
    ("1301", "quality", "13"),
    ("1302", "description", "13"),
    ("1303", "out of stock", "13"),
    ("1304", "wrong size", "13"),
    ("1305", "wrong order", "13"),
    ("1306", "not wanted", "13"),
    ("1307", "other", "13"),
    ("1401", "unused", "14"),
    ("1402", "using", "14"),
    ("1403", "used", "14"),
    ("1501", "refund only", "15"),
    ("1502", "return and refund", "15"),
    ("2401", "search", "24"),
    ("2402", "promotion", "24"),
    ("2403", "recommendation", "24"),
    ("2404", "activity", "24"),
]

# Dimension configuration log: op, source table, sink table, columns, key.
# The supplier entry is deleted again, so suppliers have no dimension.
DIM_CONFIG_LOG = [
    ("r", "region", "dim_region", "r_regionkey,r_name", "r_regionkey"),
    ("r", "nation", "dim_nation", "n_nationkey", "n_nationkey"),
    ("r", "supplier", "dim_supplier", "s_suppkey,s_name", "s_suppkey"),
    ("c", "part", "dim_sku", "p_partkey,p_name,p_brand", "p_partkey"),
    ("u", "nation", "dim_nation", "n_nationkey,n_name", "n_nationkey"),
    ("d", "supplier", "dim_supplier", "s_suppkey,s_name", "s_suppkey"),
]


# Declared types of the input tables: reading them starts no inference job.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


# Another way to get a table by its name, such as a stream of it.
Reader = Callable[[str], DataFrame]


def table(spark: SparkSession, folder: str, name: str, stream: int = 0) -> DataFrame:
    """A table; with `stream` as a stream of so many files of its folder at a time."""
    if stream:
        reader = spark.readStream.schema(TABLES[name]).option("maxFilesPerTrigger", stream)
        return reader.parquet(f"{folder}/{name}.parquet")
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def base_dic(spark: SparkSession) -> DataFrame:
    return literal.rows(spark, [(*e, None, None) for e in DICTIONARY_ENTRIES], s.DICTIONARY)


def dim_config_log(spark: SparkSession) -> DataFrame:
    rows = []
    for seq, (op, source, sink, columns, key) in enumerate(DIM_CONFIG_LOG):
        entry = (source, sink, columns, key, None)
        rows.append((op, entry, None, seq) if op == "d" else (op, None, entry, seq))
    return literal.rows(spark, rows, s.DIM_CONFIG_CHANGE)


# --------------------------------------------------------------------------
# Application log
# --------------------------------------------------------------------------
def _events(spark: SparkSession, folder: str, read: Reader | None = None) -> DataFrame:
    events = read("events") if read else table(spark, folder, "events")
    return (
        events
        .withColumn("k", F.regexp_extract("props", "[0-9]+", 0).cast("int"))
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )


def _visitor() -> Column:
    k = F.col("k")
    return F.struct(
        F.col("user_id").cast("string").alias("mid"),
        F.when(F.col("event_id") % 4 != 0, F.col("user_id").cast("string")).alias("uid"),
        F.concat(F.lit("v"), k % 3).alias("vc"),
        F.concat(F.lit("ch"), k % 4).alias("ch"),
        F.concat(F.lit("ar"), F.col("user_id") % 5).alias("ar"),
        F.when(k < 50, "1").otherwise("0").alias("is_new"),
    )


def _page_id() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "view", "home")
        .when(kind == "click", "good_detail")
        .when(kind == "purchase", "trade")
        .when(kind == "signup", "login")
        .otherwise("error")
    )


def _last_page_id() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind.isin("view", "signup"), None)
        .when((kind == "click") & (F.col("k") < 20), "login")
        .when(kind == "purchase", "search")
        .otherwise("home")
    )


def page_views(
    spark: SparkSession, folder: str, read: Reader | None = None, items: bool = False
) -> DataFrame:
    """Page views, one per event.

    With `items` purchases carry the name of the product whose search led to them; only the
    keyword summary reads it, so all other queries leave the products alone.
    """
    events = _events(spark, folder, read)
    if items:
        products = table(spark, folder, "part").select("p_partkey", "p_name")
        parts = products.agg(F.max("p_partkey") + 1).scalar()
        # Events without a search get keys that no product has, spread over all tasks.
        searched = F.when(F.col("event_type") == "purchase", F.col("event_id") % parts).otherwise(
            -1 - F.abs(F.col("event_id"))
        )
        events = events.withColumn("searched", searched).join(
            products, F.col("searched") == F.col("p_partkey"), "left"
        )
    else:
        events = events.withColumn("p_name", F.lit(None).cast("string"))
    return events.select(
        _visitor().alias("common"),
        F.struct(
            _page_id().alias("page_id"),
            _last_page_id().alias("last_page_id"),
            F.col("p_name").alias("item"),
            F.when(F.col("p_name").isNotNull(), "keyword").alias("item_type"),
            F.floor(F.col("value") * 100).cast("bigint").alias("during_time"),
        ).alias("page"),
        F.unix_millis("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def log_messages(spark: SparkSession, folder: str, read: Reader | None = None) -> DataFrame:
    """The raw log as JSON text.

    Views show items, clicks and purchases carry actions, some signups are
    application starts, errors carry an error object, and the errors of large
    `k` arrive as torn text.
    """
    kind, k = F.col("event_type"), F.col("k")

    def listed(name: str, count: Column) -> Column:
        ids = F.sequence(F.lit(1), count)
        return F.when(
            count > 0,
            F.transform(ids, lambda i: F.struct(i.alias(name), F.lit("promotion").alias("type"))),
        )

    events = _events(spark, folder, read)
    record = F.struct(
        _visitor().alias("common"),
        F.when(
            ~_is_start(),
            F.struct(
                _page_id().alias("page_id"),
                _last_page_id().alias("last_page_id"),
                F.floor(F.col("value") * 100).cast("bigint").alias("during_time"),
            ),
        ).alias("page"),
        F.when(_is_start(), F.struct(F.lit("icon").alias("entry"), k.alias("loading_time"))).alias(
            "start"
        ),
        F.when(kind == "view", listed("item", k % 4)).alias("displays"),
        F.when(kind.isin("click", "purchase"), listed("action_id", k % 3)).alias("actions"),
        F.when((kind == "error") | (_is_start() & (k < 10)), F.struct(k.alias("error_code"))).alias(
            "err"
        ),
        F.unix_millis("ts").alias("ts"),
    )
    text = F.to_json(record)
    torn = F.substring(text, 1, 20)
    return events.select(
        F.when((kind == "error") & (k >= 90), torn).otherwise(text).alias("value"),
        F.col("event_id").alias("seq"),
    )


def _is_start() -> Column:
    return (F.col("event_type") == "signup") & (F.col("k") < 30)


# --------------------------------------------------------------------------
# Database changes
# --------------------------------------------------------------------------
def _clock(time: str) -> str:
    return f"date_format({time}, 'yyyy-MM-dd HH:mm:ss')"


# Columns computed once per input row.
_PREPARED = {
    "orders": [
        "o_orderkey as k", "o_custkey as u", "o_orderstatus as flag",
        "cast(o_orderdate as timestamp) as at",
        "cast(o_orderdate as timestamp) + interval 10 minutes as operated",
        "cast(o_orderdate as timestamp) + interval 1 minute * cast(o_custkey % 30 as int) as called",
        "cast(o_orderdate as timestamp) - interval 1 day as got",
    ],
    "lineitem": [
        "*",
        "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        "date_format(l_shipdate, 'yyyyMMdd')) as line",
        "cast(l_shipdate as timestamp) as at", "cast(l_extendedprice as decimal(16,2)) as price",
        "cast(l_discount as decimal(4,2)) as share",
    ],
    "events": [
        "event_id", "user_id as u", "event_type", "cast(ts as timestamp) as at",
        "cast(regexp_extract(props, '[0-9]+', 0) as int) as k", "event_id % 3 = 0 as fresh",
    ],
}

_ORDER = {"id": "k", "user_id": "u", "province_id": "u % 25"}
_COUPON = {"id": "k", "coupon_id": "u % 10", "user_id": "u", "get_time": _clock("got")}
_EVENT = {"id": "event_id", "user_id": "u"}

# Source table: (input table, filter, change type, time, seq, new values, old values).
_SHOP_CHANGES = {
    "order_info": [
        ("orders", "true", "'insert'", "at", "k * 2", {**_ORDER, "order_status": "'1001'"}, None),
        ("orders", "true", "'update'", "operated", "k * 2 + 1",
         {**_ORDER, "operate_time": _clock("operated"),
          "order_status": "case flag when 'F' then '1003' when 'O' then '1005' else '1002' end"},
         {"order_status": "'1001'"}),
    ],
    "order_detail": [
        ("lineitem", "true", "'insert'", "at", "l_orderkey",
         {"id": "line", "order_id": "l_orderkey", "sku_id": "l_partkey",
          "sku_name": "concat('sku-', l_partkey)", "create_time": _clock("at"),
          "source_id": "l_suppkey", "source_type": "concat('240', l_suppkey % 5 + 1)",
          "sku_num": "cast(l_quantity as int)", "order_price": "price",
          "split_total_amount": "price * (cast(1 as decimal(4,2)) - share)",
          "split_activity_amount": "case when l_returnflag = 'R' then price * share end",
          "split_coupon_amount": "case when l_discount >= 0.08 then price * share end"}, None),
    ],
    "order_detail_activity": [
        ("lineitem", "l_returnflag = 'R'", "'insert'", "at", "l_orderkey",
         {"order_detail_id": "line", "activity_id": "l_suppkey % 7",
          "activity_rule_id": "l_partkey % 11"}, None),
    ],
    "order_detail_coupon": [
        ("lineitem", "l_discount >= 0.08", "'insert'", "at", "l_orderkey",
         {"order_detail_id": "line", "coupon_id": "l_partkey % 13"}, None),
    ],
    "payment_info": [
        ("orders", "flag = 'P'", "'insert'", "called", "k",
         {"user_id": "u", "order_id": "k", "payment_type": "concat('110', u % 4 + 1)",
          "payment_status": "'1601'", "callback_time": _clock("called")}, None),
    ],
    "order_refund_info": [
        ("lineitem", "l_returnflag = 'R'", "'insert'", "at", "l_orderkey",
         {"id": "line", "user_id": "l_suppkey", "order_id": "l_orderkey", "sku_id": "l_partkey",
          "refund_type": "concat('150', l_linenumber % 3 + 1)",
          "refund_num": "cast(l_quantity as int)", "refund_amount": "price",
          "refund_reason_type": "concat('130', l_suppkey % 8 + 1)",
          "refund_reason_txt": "concat('line ', l_linenumber)", "create_time": _clock("at")}, None),
    ],
    "refund_payment": [
        ("lineitem", "l_returnflag = 'R'", "'insert'", "at", "l_orderkey",
         {"id": "line", "order_id": "l_orderkey", "sku_id": "l_partkey",
          "payment_type": "concat('110', l_suppkey % 4 + 1)", "callback_time": _clock("at"),
          "total_amount": "price",
          "refund_status": "case when l_linestatus = 'F' then '0702' else '0701' end"}, None),
    ],
    "cart_info": [
        ("events", "event_type = 'purchase'", "if(fresh, 'insert', 'update')", "at", "event_id",
         {**_EVENT, "sku_id": "k", "source_id": "k", "source_type": "concat('240', k % 5 + 1)",
          "sku_num": "if(fresh, k % 9 + 1, k % 7)"},
         {"sku_num": "if(fresh, null, k % 5)"}),
    ],
    "favor_info": [
        ("events", "event_type = 'click'", "'insert'", "at", "event_id",
         {**_EVENT, "sku_id": "k", "create_time": _clock("at")}, None),
    ],
    "comment_info": [
        ("events", "event_type = 'error'", "'insert'", "at", "event_id",
         {**_EVENT, "sku_id": "k", "order_id": "event_id", "create_time": _clock("at"),
          "appraise": "concat('120', k % 5 + 1)"}, None),
    ],
    "user_info": [
        ("events", "event_type = 'signup'", "'insert'", "at", "event_id",
         {"id": "u", "create_time": _clock("at")}, None),
    ],
    "coupon_use": [
        ("orders", "true", "'insert'", "got", "k * 2", {**_COUPON, "coupon_status": "'1401'"}, None),
        ("orders", "flag in ('P', 'O')", "'update'", "at", "k * 2 + 1",
         {**_COUPON, "order_id": "k", "using_time": _clock("at"),
          "used_time": f"case when flag = 'P' then {_clock('called')} end",
          "coupon_status": "'1402'"},
         {"coupon_status": "'1401'"}),
    ],
}

# Master data, as untyped changes: bootstrap rows framed by control rows, part
# updates, deletes.  Times are small numbers: they only order the versions.
_SKU = {"p_partkey": "p_partkey", "p_name": "p_name", "p_brand": "p_brand", "p_size": "p_size"}
_REGION = {"r_regionkey": "r_regionkey", "r_name": "r_name"}
_NATION = {"n_nationkey": "n_nationkey", "n_name": "n_name", "n_regionkey": "n_regionkey"}
_MASTER_CHANGES = [
    ("region", "true", "'bootstrap-start'", 0, "-1", None, None),
    ("region", "true", "'bootstrap-insert'", 1, "r_regionkey", _REGION, None),
    ("region", "true", "'bootstrap-complete'", 2, "-1", None, None),
    ("nation", "true", "'insert'", 1, "n_nationkey", _NATION, None),
    ("nation", "n_regionkey = 2", "'delete'", 3, "n_nationkey", _NATION, None),
    ("part", "true", "'insert'", 1, "p_partkey", _SKU, None),
    ("part", "p_size > 25", "'update'", 2, "p_partkey",
     {**_SKU, "p_brand": "concat(p_brand, ' II')"}, {"p_brand": "p_brand"}),
    ("supplier", "true", "'insert'", 1, "s_suppkey",
     {"s_suppkey": "s_suppkey", "s_name": "s_name"}, None),
]


def _struct(columns: list[str], values: dict[str, str] | None) -> str:
    if values is None:
        return f"cast(null as struct<{', '.join(f'{c}: string' for c in columns)}>)"
    fields = [f"'{c}', cast({values.get(c, 'null')} as string)" for c in columns]
    return f"named_struct({', '.join(fields)})"


def _map(values: dict[str, str] | None) -> str:
    if values is None:
        return "cast(null as map<string, string>)"
    return f"map({', '.join(f'{k!r}, cast({v} as string)' for k, v in values.items())})"


def _changes(rows: DataFrame, name: str, kind: str, ts: str, seq: str, data: str, old: str):
    return rows.selectExpr(
        "'shop' as database", f"'{name}' as table", f"{kind} as type", f"{data} as data",
        f"{old} as old", f"cast(cast({ts} as bigint) as string) as ts",
        f"cast({seq} as bigint) as seq",
    )


def _union(branches: list[DataFrame]) -> DataFrame:
    log = branches[0]
    for branch in branches[1:]:
        log = log.unionAll(branch)
    return log


def change_feed(spark: SparkSession, folder: str, read: Reader | None = None) -> Feed:
    """Typed changes of one source table at a time."""

    def feed(name: str) -> DataFrame:
        columns = s.SOURCE_COLUMNS[name]
        branches = []
        for source, where, kind, time, seq, data, old in _SHOP_CHANGES[name]:
            rows = read(source) if read else table(spark, folder, source)
            rows = rows.selectExpr(*_PREPARED[source]).where(where)
            values, before = _struct(columns, data), _struct(columns, old)
            branches.append(
                _changes(rows, name, kind, f"unix_seconds({time})", seq, values, before)
            )
        return _union(branches)

    return feed


def master_change_log(spark: SparkSession, folder: str, read: Reader | None = None) -> DataFrame:
    """Untyped changes of the master data, as one log."""
    return _union(
        [
            _changes(
                (read(name) if read else table(spark, folder, name)).where(where), name, kind, str(ts), seq,
                _map(data), _map(old),
            )
            for name, where, kind, ts, seq, data, old in _MASTER_CHANGES
        ]
    )
