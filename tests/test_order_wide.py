"""The wide order rows in batch: right with repeated and missing keys, shuffled once."""

import json

import pytest
from pyspark.sql import functions as F

from tidewell import schemas as s
from tidewell.operators import changes as ch
from tidewell.operators.merge import latest
from tidewell.plans import trade
from tidewell.sources import tables

DETAILS = [  # id, order, source type
    ("d1", "o1", "2401"), ("d1", "o1", "2401"), ("d1", "o2", "2402"), ("d2", "o2", "9999"),
    ("d2", "o1", "2403"), (None, "o1", "2401"), (None, "o2", "2402"), ("d3", None, "2401"),
    ("d4", "o3", "2404"), ("d5", "none", "2401"),
]
ORDERS = [("o1", 10), ("o1", 20), ("o2", 15), ("o2", 5), ("o3", None), (None, 30)]
ACTIVITIES = [("d1", "a1"), ("d1", "a2"), ("d2", None), (None, "a3"), ("d9", "a9")]
COUPONS = [("d1", "c1"), ("d4", "c4"), ("d4", "c5"), (None, "c6")]


@pytest.fixture
def feed(spark):
    def rows(name, data, ts):
        return (json.dumps({"database": "shop", "table": name, "type": "insert", "data": data, "ts": None if ts is None else str(ts)}), 0)

    log = [rows("order_detail", {"id": i, "order_id": o, "source_type": c, "sku_num": "1", "order_price": "2"}, 1) for i, o, c in DETAILS]
    log += [rows("order_info", {"id": o, "order_status": f"s{ts}"}, ts) for o, ts in ORDERS]
    log += [rows("order_detail_activity", {"order_detail_id": d, "activity_id": a}, 1) for d, a in ACTIVITIES]
    log += [rows("order_detail_coupon", {"order_detail_id": d, "coupon_id": c}, 1) for d, c in COUPONS]
    return ch.feed(ch.parse(spark.createDataFrame(log, s.MESSAGE), s.TYPED_CHANGE))


def expected():
    found = []
    for i, o, c in DETAILS:
        acts = [a for d, a in ACTIVITIES if d == i and d] or [None]
        coupons = [x for d, x in COUPONS if d == i and d] or [None]
        if c != "9999":
            found += [(i, o, ts, a, x) for k, ts in ORDERS if k == o and k for a in acts for x in coupons]
    return found


def test_every_detail_meets_versions_and_promotions(spark, feed):
    got = trade.order_wide(feed, tables.base_dic(spark)).select(
        "id", "order_id", F.col("oi_ts").cast("int"), "activity_id", "coupon_id"
    )
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected()))


def test_the_newest_row_of_each_id(spark, feed):
    dic = tables.base_dic(spark)
    got = trade.order_wide_newest(feed, dic).select("id", "order_id", F.col("oi_ts").cast("int"), "activity_id", "coupon_id").collect()
    every = expected()
    best = {i: max(r[2] or -1 for r in every if r[0] == i) for i in {r[0] for r in every}}
    assert sorted(str(r.id) for r in got) == sorted(map(str, best))
    assert all(tuple(r) in every and (r[2] or -1) == best[r[0]] for r in got)
    old = latest(trade.order_wide(feed, dic), ["id"], F.col("oi_ts").cast("bigint")).drop("old")
    assert got and trade.order_wide_newest(feed, dic).columns == old.columns


@pytest.mark.parametrize("kinds", [("insert", "update"), ("update", "insert")])
def test_of_equal_times_the_placing_version_wins(spark, kinds):
    log = [("order_detail", "insert", {"id": "d1", "order_id": "o1", "source_type": "2401"})]
    log += [("order_info", kind, {"id": "o1", "order_status": kind}) for kind in kinds]
    texts = [(json.dumps({"table": n, "type": k, "data": d, "ts": None}), 0) for n, k, d in log]
    feed = ch.feed(ch.parse(spark.createDataFrame(texts, s.MESSAGE), s.TYPED_CHANGE))
    (row,) = trade.order_wide_newest(feed, tables.base_dic(spark)).collect()
    assert (row.id, row.type, row.order_status) == ("d1", "insert", "insert")


@pytest.mark.parametrize("newest", [False, True])
def test_wide_rows_are_shuffled_once(spark, tmp_path, newest):
    for name in ("orders", "lineitem"):
        spark.createDataFrame([], tables.TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    feed, dic = tables.change_feed(spark, str(tmp_path)), F.broadcast(tables.base_dic(spark))
    rows = trade.order_wide_newest(feed, dic) if newest else trade.order_wide(feed, dic)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        nodes = rows._jdf.queryExecution().explainString(mode).split("\n\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    shuffles = [n for n in nodes if n.partition("\n")[0].endswith(") Exchange")]
    assert shuffles and len([n for n in shuffles if "split_total_amount" in n]) == 1, shuffles
