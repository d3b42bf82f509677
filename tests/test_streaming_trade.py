"""The streaming trade, tool and dimension jobs give what the batch plans give."""

import json

import pytest
from pyspark.sql import functions as F

from tidewell import schemas as s
from tidewell.operators import changes as ch
from tidewell.operators.windows import as_text
from tidewell.plans import dim, summary, tool, trade
from tidewell.sources import tables
from tidewell.streaming import jobs

START = 1_700_000_000
CHAIN = [
    "changes", "dimensions", "cart_add", "order_wide", "order_placed", "order_cancelled", "payment",
    "order_refund", "refund_payment", "coupon_get", "coupon_order", "coupon_pay", "favor_add",
    "comment", "user_register", "register_measures", "register_window", "cart_measures",
    "cart_window", "payer_measures", "payer_window", "order_wide_keyed", "payment_keyed",
]


def clock(ts):
    import datetime

    return datetime.datetime.fromtimestamp(ts, datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def change(table, kind, ts, data, old=None):
    text = {k: None if v is None else str(v) for k, v in data.items()}
    return {"database": "shop", "table": table, "type": kind, "data": text, "old": old, "ts": str(ts)}


def fixture_changes():
    """Forty orders, ten minutes apart and in bursts, with everything that follows them."""
    out = []
    for i in range(40):
        t = START + i * 600
        user = i % 7
        status = {0: "1002", 1: "1003", 2: "1005"}[i % 3]
        order = {"id": i, "user_id": user, "province_id": i % 5, "order_status": "1001"}
        out.append(change("order_info", "insert", t, order))
        for n in range(4):  # without promotion, with activity, with coupon, with both
            line = f"{i}-{n}"
            out.append(change("order_detail", "insert", t + n, {
                "id": line, "order_id": i, "sku_id": n, "sku_name": f"sku {n}",
                "create_time": clock(t), "source_id": n, "source_type": f"240{1 + (i + n) % 5}",
                "sku_num": n + 1, "order_price": "10.5", "split_total_amount": "10.00"}))
            if n in (1, 3):
                out.append(change("order_detail_activity", "insert", t + 3, {
                    "order_detail_id": line, "activity_id": i % 4, "activity_rule_id": 7}))
            if n in (2, 3):
                # one in four single coupons is too late for the join state
                late = 1200 if i % 4 == 3 and n == 2 else 5
                out.append(change("order_detail_coupon", "insert", t + late, {
                    "order_detail_id": line, "coupon_id": i}))
        changed = {**order, "order_status": status, "operate_time": clock(t + 120)}
        out.append(change("order_info", "update", t + 120, changed, {"order_status": "1001"}))
        if status == "1002":
            delay = 1500 if i % 9 == 0 else 300
            out.append(change("payment_info", "insert", t + delay, {
                "user_id": user, "order_id": i, "payment_type": f"110{1 + i % 4}",
                "callback_time": clock(t + delay)}))
        if status == "1005":
            for n in (0, 1):
                apart = 3 if n == 0 else 60
                out.append(change("order_refund_info", "insert", t + 120 + apart, {
                    "id": f"r{i}-{n}", "user_id": user, "order_id": i, "sku_id": n,
                    "refund_type": "1501", "refund_num": 1, "refund_amount": "5.00",
                    "refund_reason_type": "1303", "refund_reason_txt": "why not",
                    "create_time": clock(t + 120 + apart)}))
            out.append(change("refund_payment", "insert", t + 124, {
                "id": f"p{i}", "order_id": i, "sku_id": 0, "payment_type": "1101",
                "callback_time": clock(t + 124), "total_amount": "5.00",
                "refund_status": "0702" if i % 2 else "0701"}))
        out.append(change("cart_info", "insert" if i % 2 else "update", t + 10, {
            "id": i, "user_id": user, "sku_id": 1, "source_id": 1, "source_type": "2401",
            "sku_num": i % 6}, None if i % 2 else {"sku_num": "2"}))
        out.append(change("favor_info", "insert", t + 11, {
            "id": i, "user_id": user, "sku_id": 3, "create_time": clock(t)}))
        out.append(change("comment_info", "insert", t + 12, {
            "id": i, "user_id": user, "sku_id": 3, "order_id": i, "create_time": clock(t),
            "appraise": f"120{1 + i % 5}"}))
        out.append(change("user_info", "insert", t + 13, {"id": i, "create_time": clock(t)}))
        coupon = {"id": i, "coupon_id": 1, "user_id": user, "get_time": clock(t)}
        out.append(change("coupon_use", "insert", t, {**coupon, "coupon_status": "1401"}))
        out.append(change("coupon_use", "update", t + 5, {
            **coupon, "order_id": i, "using_time": clock(t + 5), "coupon_status": "1402",
            "used_time": clock(t + 6) if i % 3 else None}, {"coupon_status": "1401"}))
        out.append(change("part", "insert" if i < 20 else "update", t, {
            "p_partkey": i % 20, "p_name": f"part {i}", "p_brand": None, "p_size": 1}))
        out.append(change("supplier", "insert", t, {"s_suppkey": i, "s_name": "x"}))
    out.append(change("region", "bootstrap-start", START, {}))
    out.append(change("region", "bootstrap-insert", START, {"r_regionkey": 1, "r_name": "it's"}))
    return sorted(out, key=lambda c: int(c["ts"]))


@pytest.fixture(scope="module")
def messages(spark):
    rows = [(json.dumps(c), n) for n, c in enumerate(fixture_changes())]
    return spark.createDataFrame(rows, s.MESSAGE)


@pytest.fixture(scope="module")
def batch(messages):
    return ch.feed(ch.parse(messages, s.TYPED_CHANGE))


@pytest.fixture(scope="module")
def dictionary(spark):
    return tables.base_dic(spark)


@pytest.fixture(scope="module")
def warehouse(spark, messages, dictionary, tmp_path_factory):
    """The change log arrives in two parts and a flush; every job runs after each."""
    root = str(tmp_path_factory.mktemp("trade"))
    w = jobs.Warehouse(spark, root, size="1 hour", trigger={"availableNow": True})
    dictionary.write.parquet(w.folder("base_dic"))
    tables.dim_config_log(spark).write.parquet(w.folder("table_process"))
    far = START + 10_000_000
    flush = [
        change("order_info", "insert", far, {"id": "flush"}),
        change("order_info", "update", far, {"id": "flush", "order_status": "1005"}, {"order_status": "1001"}),
        change("order_detail", "insert", far, {"id": "flush", "order_id": "flush", "source_type": "2401"}),
        change("order_detail_activity", "insert", far, {"order_detail_id": "flush"}),
        change("order_detail_coupon", "insert", far, {"order_detail_id": "flush"}),
    ]
    rows = [(json.dumps(c), 10**6 + n) for n, c in enumerate(flush)]
    parts = [messages.where("seq < 400"), messages.where("seq >= 400"),
             spark.createDataFrame(rows, s.MESSAGE)]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(w.folder("topic_db"))
        for name in CHAIN:
            query = jobs.JOBS[name](w)
            query.awaitTermination(240)
            assert query.exception() is None, name
    return w


def same(got, want):
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a = sorted(map(tuple, got.select(*columns).collect()), key=repr)
    b = sorted(map(tuple, want.select(*columns).collect()), key=repr)
    assert len(a) == len(b)
    assert a == b
    assert a


def stored(warehouse, name):
    return warehouse.detail(name, stream=False)


def settled(rows):
    return rows.drop("row_op_ts", "old").where("order_id <> 'flush'")


def test_order_details(warehouse, batch, dictionary):
    wide = trade.order_wide(batch, dictionary, jobs.ORDER_BOUND)
    same(settled(stored(warehouse, "order_wide")), settled(wide))
    same(settled(stored(warehouse, "order_placed")), settled(trade.order_placed(wide)))
    same(settled(stored(warehouse, "order_cancelled")), settled(trade.order_cancelled(wide)))


def test_late_partners_do_not_join(warehouse):
    late = stored(warehouse, "order_wide").where("id = '3-2'").select("coupon_id").distinct()
    assert [r[0] for r in late.collect()] == [None]


def test_upserted_orders_keep_the_latest_version(warehouse):
    rows = warehouse.upserted("order_wide").where("order_id <> 'flush'")
    assert rows.count() == rows.select("id").distinct().count()
    assert rows.where("type = 'insert'").count() == 0


def test_payments(warehouse, batch, dictionary):
    placed = trade.order_placed(trade.order_wide(batch, dictionary, jobs.ORDER_BOUND))
    want = trade.payment_detail(placed, batch, dictionary, bound=jobs.ORDER_BOUND)
    same(settled(stored(warehouse, "payment")), settled(want))
    every = trade.payment_detail(placed, batch, dictionary)
    assert settled(every).count() > settled(want).count()


def test_refunds(warehouse, batch, dictionary):
    want = trade.order_refund(batch, dictionary, jobs.REFUND_BOUND)
    same(settled(stored(warehouse, "order_refund")), settled(want))
    paid = trade.refund_payment(batch, dictionary, bound=jobs.REFUND_BOUND)
    same(settled(stored(warehouse, "refund_payment")), settled(paid))


@pytest.mark.parametrize(
    "name, plan",
    [("coupon_get", tool.coupon_get), ("coupon_order", tool.coupon_order),
     ("coupon_pay", tool.coupon_pay), ("favor_add", tool.favor_add),
     ("user_register", tool.user_register)],
)
def test_single_change_details(warehouse, batch, name, plan):
    same(stored(warehouse, name), plan(batch))


def test_looked_up_details(warehouse, batch, dictionary):
    same(stored(warehouse, "comment"), tool.comment(batch, dictionary))
    same(stored(warehouse, "cart_add"), trade.cart_add(batch, dictionary))


def test_windows(spark, warehouse, batch, dictionary):
    def table(name):
        return as_text(warehouse.summary(name).read(spark))

    same(table("register_window"), as_text(summary.register_window(tool.user_register(batch), "1 hour")))
    carts = trade.cart_add(batch, dictionary)
    same(table("cart_window"), as_text(summary.cart_window(carts, "1 hour")))
    same(
        table("payer_window"),
        as_text(summary.payer_window(warehouse.detail("payment", stream=False), "1 hour")),
    )


def test_dimensions(spark, warehouse, messages):
    batch = ch.parse(messages)
    got = warehouse.dimensions().read(spark).select("sink_table", "pk", F.explode("data"))
    config = tables.dim_config_log(spark)
    want = dim.dimension_state(batch, config).select("sink_table", "pk", F.explode("data"))
    same(got, want)
    sku = {r.p_partkey: r for r in warehouse.dimension("dim_sku").collect()}
    assert sku["3"].p_name == "part 23" and sku["3"].p_brand == ""
    region = warehouse.dimension("dim_region").collect()
    assert [tuple(r) for r in region] == [("1", "it's")]
    with pytest.raises(LookupError):  # its configuration was deleted
        warehouse.dimension("dim_supplier")


def test_lines_that_upstream_joins_held_back_are_paid(spark, dictionary, tmp_path):
    """Lines with neither, one and both partners in small parts: none comes too late for its
    payment, also when `order_wide` runs no batch without data between the parts."""
    bound, out = "60 seconds", []
    for i in range(50):
        t = START + 5 * i
        out.append(change("order_info", "insert", t, {"id": i, "user_id": i, "order_status": "1001"}))
        out.append(change("order_detail", "insert", t, {
            "id": i, "order_id": i, "sku_id": 1, "create_time": clock(t), "source_type": "2401", "sku_num": 1}))
        if i % 4 in (1, 3):
            out.append(change("order_detail_activity", "insert", t + 1, {"order_detail_id": i, "activity_id": 1}))
        if i % 4 in (2, 3):
            out.append(change("order_detail_coupon", "insert", t + 1, {"order_detail_id": i, "coupon_id": 1}))
        out.append(change("payment_info", "insert", t + 30, {
            "user_id": i, "order_id": i, "payment_type": "1101", "callback_time": clock(t + 30)}))
    parts = [[c for c in out if (int(c["ts"]) - START) // 50 == n] for n in range(6)]
    far = START + 10_000_000
    parts.append([
        change("order_info", "insert", far, {"id": "flush"}),
        change("order_detail", "insert", far, {"id": "flush", "order_id": "flush", "source_type": "2401"}),
        change("order_detail_activity", "insert", far, {"order_detail_id": "flush"}),
        change("order_detail_coupon", "insert", far, {"order_detail_id": "flush"}),
    ])
    w = jobs.Warehouse(
        spark, str(tmp_path), size="1 minute", order_bound=bound, trigger={"availableNow": True}
    )
    dictionary.write.parquet(w.folder("base_dic"))
    idle = "spark.sql.streaming.noDataMicroBatches.enabled"
    for n, part in enumerate(parts):
        rows = [(json.dumps(c), 1000 * n + k) for k, c in enumerate(part)]
        spark.createDataFrame(rows, s.MESSAGE).coalesce(1).write.mode("append").parquet(w.folder("topic_db"))
        for name in ("changes", "order_wide", "order_placed", "payment", "payer_measures", "payer_window"):
            spark.conf.set(idle, str(name != "order_wide" or part is parts[-1]).lower())
            try:
                query = jobs.JOBS[name](w)
                query.awaitTermination(240)
            finally:
                spark.conf.unset(idle)
            assert query.exception() is None, name
    paid = stored(w, "payment")
    assert sorted(int(r[0]) for r in paid.select("order_detail_id").collect()) == list(range(50))
    want = summary.payer_window(paid, "1 minute")
    same(as_text(w.summary("payer_window").read(spark)), as_text(want))
