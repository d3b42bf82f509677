"""Golden samples, and independent per-key simulations on random input."""

import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewell import schemas as s
from tidewell.functions import changes as fc
from tidewell.functions import time as ft
from tidewell.functions.text import keywords
from tidewell.operators import changes as ch
from tidewell.operators import dims, joins, logs, merge, state
from tidewell.operators.windows import as_text, tumble
from tidewell.plans import summary, tool, trade, traffic
from tidewell.sources import literal, tables

DAY = 86_400_000
MONDAY = 1_700_006_400_000  # midnight UTC


def page(mid, last, ts, seq=0, is_new="0", uid=None, page_id="home", during=5, item=None):
    return ((mid, uid, "v1", "c1", "a1", is_new), (page_id, last, item, "keyword", during), ts, seq)


def pages(spark, rows):
    return spark.createDataFrame(rows, s.PAGE_VIEW)


def random_pages(seed, hot=False):
    """Visitors over some days; with `hot` one of them owns a third of the rows."""
    rng = random.Random(seed)
    rows, ts = [], MONDAY
    for seq in range(900):
        ts += rng.choice([0, 1, 900, 4_000, 10_000, 60_000, 3_600_000])
        mid = "hot" if hot and rng.random() < 0.34 else f"m{rng.randrange(6)}"
        last = rng.choice([None, None, "home", "login"])
        rows.append(
            page(mid, last, ts, seq, rng.choice("01"), rng.choice([None, mid]),
                 rng.choice(["home", "good_detail", "cart"]))
        )
    rng.shuffle(rows)
    return rows


def by_visitor(rows, key=lambda r: r[0][0]):
    groups = defaultdict(list)
    for row in sorted(rows, key=lambda r: (r[2], r[3])):
        groups[key(row)].append(row)
    return groups.values()


def day(ts):
    return ts // DAY


SEEDS = [(1, False), (2, True), (3, True)]


@pytest.mark.parametrize("seed, hot", SEEDS)
def test_visitor_repair_like_a_state_machine(spark, seed, hot):
    rows = random_pages(seed, hot)
    want = {}
    for group in by_visitor(rows):
        first = None
        for r in group:
            flag = r[0][5]
            if flag == "1":
                if first is None:
                    first = day(r[2])
                elif first != day(r[2]):
                    flag = "0"
            elif first is None:
                first = day(r[2]) - 1
            want[r[3]] = flag
    got = state.repair_new_visitors(pages(spark, rows)).select("seq", "common.is_new").collect()
    assert {r[0]: r[1] for r in got} == want and len(got) == len(rows)


@pytest.mark.parametrize("seed, hot", SEEDS)
def test_unique_visitors_like_a_state_machine(spark, seed, hot):
    rows = random_pages(seed, hot)
    want = set()
    for group in by_visitor(rows):
        last = None
        for r in group:
            if r[1][1] is None and last != day(r[2]):
                last = day(r[2])
                want.add(r[3])
    got = traffic.unique_visitors(pages(spark, rows)).select("seq").collect()
    assert sorted(r[0] for r in got) == sorted(want)


@pytest.mark.parametrize("seed, hot", SEEDS)
@pytest.mark.parametrize("limit, cut", [(10_000, None), (4_000, 4_000), (3_600_000, None)])
def test_bounces_like_an_automaton(spark, seed, hot, limit, cut):
    rows = random_pages(seed, hot)
    want = set()
    for group in by_visitor(rows):
        open_start = None
        for r in group:
            if open_start is not None:
                if r[2] >= open_start[2] + limit or r[1][1] is None:
                    want.add(open_start[3])
                open_start = None
            if r[1][1] is None:
                open_start = r
        if open_start is not None:
            want.add(open_start[3])
    got = state.bounces(pages(spark, rows), limit, cut).select("seq").collect()
    assert sorted(r[0] for r in got) == sorted(want)


@pytest.mark.parametrize("seed, hot", SEEDS)
def test_login_window_like_a_state_machine(spark, seed, hot):
    rows = random_pages(seed, hot)
    want = defaultdict(lambda: [0, 0])
    kept = [r for r in rows if r[0][1] and r[1][1] in (None, "login")]
    for group in by_visitor(kept):
        last = None
        for r in group:
            if last != day(r[2]):
                back = last is not None and day(r[2]) - last >= 8
                want[r[2] // 10_000 * 10_000][0] += back
                want[r[2] // 10_000 * 10_000][1] += 1
                last = day(r[2])
    got = summary.login_window(pages(spark, rows)).select(
        F.unix_millis("stt"), "back_ct", "uu_ct"
    )
    assert {r[0]: [r[1], r[2]] for r in got.collect()} == dict(want)


@pytest.mark.parametrize("gap, back", [(7, 0), (8, 1)])
def test_a_user_comes_back_after_eight_days(spark, gap, back):
    rows = [page("1", None, MONDAY + 5, 0, uid="1"), page("1", None, MONDAY + gap * DAY + 9, 1, uid="1")]
    got = summary.login_window(pages(spark, rows)).agg(F.sum("back_ct"), F.sum("uu_ct")).first()
    assert tuple(got) == (back, 2)


@pytest.mark.parametrize("seed, hot", SEEDS)
def test_page_window_like_a_state_machine(spark, seed, hot):
    rows = random_pages(seed, hot)
    want = defaultdict(lambda: [0, 0])
    for n, name in enumerate(["home", "good_detail"]):
        for group in by_visitor([r for r in rows if r[1][0] == name]):
            last = None
            for r in group:
                if last != day(r[2]):
                    want[r[2] // 10_000 * 10_000][n] += 1
                    last = day(r[2])
    got = summary.page_window(pages(spark, rows)).select(
        F.unix_millis("stt"), "home_uv_ct", "good_detail_uv_ct"
    )
    assert {r[0]: [r[1], r[2]] for r in got.collect()} == dict(want)


def test_payers_keep_windows_of_repeat_payments(spark):
    start = MONDAY // 1000
    paid = [("a", start + 1), ("a", start + 2), ("a", start + 25), ("b", start + 26),
            ("a", start + 86_400 + 3), ("a", start + 86_400 + 44)]
    rows = spark.createDataFrame([(u, str(t)) for u, t in paid], "user_id string, ts string")
    got = summary.payer_window(rows).orderBy("stt").select(
        (F.unix_seconds("stt") - start).alias("at"), *s.PAYER_METRICS
    )
    assert [tuple(r) for r in got.collect()] == [
        (0, 1, 1), (20, 1, 1), (86_400, 1, 0), (86_440, 0, 0),
    ]


def test_cart_users_once_a_day_or_every_time(spark):
    start = MONDAY // 1000
    rows = spark.createDataFrame(
        [("a", str(start)), ("a", str(start + 1)), ("b", str(start + 2))], "user_id string, ts string"
    )
    assert [r[3] for r in summary.cart_window(rows).collect()] == [2]
    assert [r[3] for r in summary.cart_window(rows, every_add=True).collect()] == [3]


def test_golden_bounce(spark):
    rows = [page("101", None, 10_000), page("102", None, 12_000), page("102", "home", 15_000),
            page("102", "detail", 30_000)]
    got = traffic.user_jumps(pages(spark, rows)).select("common.mid", "ts").collect()
    assert [tuple(r) for r in got] == [("101", 10_000)]


def test_a_start_followed_exactly_at_the_limit_is_a_bounce(spark):
    rows = [page("1", None, 95_000, 0), page("1", "home", 105_000, 1),
            page("2", None, 95_001, 2), page("2", "home", 105_000, 3)]
    got = traffic.user_jumps(pages(spark, rows)).select("common.mid").collect()
    assert [r[0] for r in got] == ["1"]


# --------------------------------------------------------------------------
# Log routing
# --------------------------------------------------------------------------
def messages(spark, *texts):
    return spark.createDataFrame([(t, n) for n, t in enumerate(texts)], s.MESSAGE)


def test_log_routing(spark):
    common = {"mid": "1", "is_new": "0"}
    full = {"common": common, "page": {"page_id": "home"}, "displays": [{"i": 1}, {"i": {"j": 2}}],
            "actions": [{"a": 1}], "err": {"code": 5}, "ts": 1000}
    start = {"common": common, "start": {"entry": "icon"}, "displays": [{"i": 9}],
             "err": {"code": 6}, "ts": 2000}
    plain = {"common": common, "page": {"page_id": "cart"}, "ts": 3000}
    log = messages(spark, json.dumps(full), json.dumps(start), json.dumps(plain), '{"bad json', "", None)
    parsed = logs.parse(log)
    assert [r.value for r in logs.dirty(parsed).orderBy("seq").collect()] == ['{"bad json', ""]
    routed = defaultdict(list)
    for r in logs.route(traffic.clean_log(log)).orderBy("seq").collect():
        routed[r.topic].append(json.loads(r.value))
    assert routed[logs.ERROR] == [full, start]
    assert routed[logs.START] == [{k: v for k, v in start.items() if k != "err"}]
    assert routed[logs.DISPLAY] == [
        {"display": d, "common": common, "page": full["page"], "ts": 1000} for d in full["displays"]
    ]
    assert routed[logs.ACTION] == [{"action": {"a": 1}, "common": common, "page": full["page"]}]
    assert routed[logs.PAGE] == [
        {"common": common, "page": full["page"], "ts": 1000}, plain,
    ]


# --------------------------------------------------------------------------
# Changes
# --------------------------------------------------------------------------
def change_rows(spark, *records):
    schema = s.TYPED_CHANGE
    texts = [json.dumps({"table": t, "type": k, "data": d, "old": o, "ts": "100"}) for t, k, d, o in records]
    return ch.feed(ch.parse(messages(spark, *texts), schema))


def test_cart_quantities(spark):
    line = {"id": 1, "source_type": "2401"}
    feed = change_rows(
        spark,
        ("cart_info", "insert", {**line, "sku_num": 4}, None),
        ("cart_info", "update", {**line, "sku_num": 5}, {"sku_num": 2}),
        ("cart_info", "update", {**line, "sku_num": 2}, {"sku_num": 5}),
        ("cart_info", "update", {**line, "sku_num": 9}, {"id": 7}),
        ("cart_info", "insert", {**line, "sku_num": 1, "source_type": "9999"}, None),
        ("cart_info", "delete", {**line, "sku_num": 1}, None),
    )
    got = trade.cart_add(feed, tables.base_dic(spark))
    assert sorted(r.sku_num for r in got.collect()) == ["3", "4"]
    assert got.columns == s.CART_ADD


def test_maps_and_structs_read_alike(spark):
    text = json.dumps({"table": "coupon_use", "type": "update", "ts": "7",
                       "data": {"id": 1, "coupon_status": "1402", "using_time": "2022-11-13 20:26:00"},
                       "old": {"coupon_status": "1401"}})
    for schema in (s.CHANGE, s.TYPED_CHANGE):
        got = tool.coupon_order(ch.feed(ch.parse(messages(spark, text), schema))).collect()
        assert [(r.id, r.date_id, r.order_time, r.ts) for r in got] == [
            ("1", "2022-11-13", "2022-11-13 20:26:00", "7")
        ]


def test_payment_success_and_strict_refunds(spark):
    pay = {"order_id": 1, "payment_type": "1101", "callback_time": "2022-01-01 00:00:00"}
    feed = change_rows(
        spark,
        ("payment_info", "insert", {**pay, "payment_status": "1601"}, None),
        ("payment_info", "update", {**pay, "payment_status": "1602"}, {"payment_status": "1601"}),
        ("refund_payment", "update",
         {"id": 1, "order_id": 1, "sku_id": 2, "payment_type": "1101", "refund_status": "0702"},
         {"refund_status": "0701"}),
        ("order_info", "update", {"id": 1, "order_status": "1006"}, {"order_status": "1005"}),
        ("order_refund_info", "update", {"order_id": 1, "sku_id": 2, "refund_status": "0705"},
         {"refund_status": "0702"}),
        ("order_refund_info", "insert", {"order_id": 1, "sku_id": 2}, None),
    )
    assert trade.payments(feed).count() == 2
    assert trade.payments(feed, require_success=True).count() == 1
    dic = tables.base_dic(spark)
    assert trade.refund_payment(feed, dic).count() == 2
    assert trade.refund_payment(feed, dic, strict=True).count() == 1


def test_amount_has_scale_four(spark):
    row = spark.range(1).select(fc.amount(F.lit("2"), F.lit("10.5")).alias("a"),
                                fc.amount(F.lit("x"), F.lit("1")).alias("b")).first()
    assert tuple(row) == ("21.0000", None)


def test_control_rows_and_configuration(spark):
    feed = ch.parse(messages(
        spark,
        '{"table":"t","type":"bootstrap-start","data":{},"ts":"1"}',
        '{"table":"t","type":"bootstrap-insert","data":{"id":"1","name":"n","sku_name":null},"ts":"1"}',
        '{"table":"t","type":"delete","data":{"id":"2","name":"m","sku_name":"it\'s"},"ts":"2"}',
        '{"table":"other","type":"insert","data":{"id":"3"},"ts":"2"}',
        '{"table":"t","type":"insert","data":"text","ts":"2"}',
    ))
    config = literal.rows(
        spark, [("c", None, ("t", "dim_t", "sku_name,id", None, None), 1)], s.DIM_CONFIG_CHANGE
    )
    rows = dims.dimension_rows(feed, dims.current_config(config)).orderBy("seq").collect()
    assert [(r.sink_table, r.pk, r.data) for r in rows] == [
        ("dim_t", "1", {"id": "1", "sku_name": ""}), ("dim_t", "2", {"id": "2", "sku_name": "it's"}),
    ]
    assert dims.sink_schema("sku_name,id").names == ["sku_name", "id"]


def test_configuration_log_folds_to_the_latest_entries(spark):
    config = dims.current_config(tables.dim_config_log(spark)).collect()
    assert {r.source_table: r.sink_columns for r in config} == {
        "region": "r_regionkey,r_name", "nation": "n_nationkey,n_name", "part": "p_partkey,p_name,p_brand",
    }


# --------------------------------------------------------------------------
# Merges, joins, functions
# --------------------------------------------------------------------------
def test_sum_merge(spark):
    rows = spark.createDataFrame(
        [(1, 1, "jim", 2), (2, 1, "grace", 2), (3, 2, "tom", 2), (4, 3, "bush", 3), (5, 3, "helen", 3)],
        "siteid int, citycode int, username string, pv bigint",
    )
    got = merge.aggregate_key_merge(rows.unionAll(rows), ["siteid", "citycode", "username"], {"pv": "sum"})
    assert sorted(r.pv for r in got.collect()) == [4, 4, 4, 6, 6]


def test_mixed_merge(spark):
    rows = spark.createDataFrame(
        [("a", 1, "old", 5, 5, 5), ("a", 2, "new", 7, 7, 7)],
        "k string, v int, last string, cost int, hi int, lo int",
    )
    rules = {"last": "replace", "cost": "sum", "hi": "max", "lo": "min"}
    got = merge.aggregate_key_merge(rows, ["k"], rules, "v").collect()
    assert [tuple(r) for r in got] == [("a", "new", 12, 7, 5)]
    with pytest.raises(ValueError):
        merge.aggregate_key_merge(rows, ["k"], rules)
    with pytest.raises(ValueError):
        merge.aggregate_key_merge(rows, ["k"], {"cost": "avg"})


def test_keywords(spark):
    texts = [
        "Apple iPhone (A2104) 256GB", "iPhone深空灰色 A手", None, "--", "ÉTÉ x",
        "Größe ação niño", "Привет Ωμέγα سلام", "𠀀𠀁𠀂z",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(keywords("t")).collect()
    assert [r[0] for r in rows] == [
        ["apple", "iphone", "a2104", "256gb"], ["iphone", "深空", "空灰", "灰色", "a", "手"],
        None, [], ["été", "x"],
        ["größe", "ação", "niño"], ["привет", "ωμέγα", "سلام"], ["𠀀𠀁", "𠀁𠀂", "z"],
    ]


def test_keyword_window(spark):
    rows = [page("1", "search", MONDAY + 1500, 0, item="red Red dress"),
            page("1", "search", MONDAY + 9999, 1, item="dress"),
            page("1", "home", MONDAY + 9999, 2, item="blue"),
            page("1", "search", MONDAY + 10_000, 3, item="red")]
    got = as_text(summary.keyword_window(pages(spark, rows))).orderBy("stt", "keyword")
    assert [(r.stt[-5:], r.edt[-5:], r.source, r.keyword, r.keyword_count) for r in got.collect()] == [
        ("00:00", "00:10", "SEARCH", "dress", 2), ("00:00", "00:10", "SEARCH", "red", 2),
        ("00:10", "00:20", "SEARCH", "red", 1),
    ]


def test_traffic_counts_bounces_ten_seconds_later(spark):
    view = pages(spark, [page("1", None, MONDAY, 0, during=None)])
    got = summary.traffic_window(view, traffic.unique_visitors(view), traffic.user_jumps(view))
    rows = got.orderBy("stt").select(*s.TRAFFIC_METRICS).collect()
    assert [tuple(r) for r in rows] == [(1, 1, 1, 0, 0), (0, 0, 0, 0, 1)]


def test_time_functions(spark):
    ms = 1_668_342_360_123  # 2022-11-13 12:26:00.123 UTC
    row = spark.range(1).select(
        ft.date_text(F.lit(ms)), ft.date_time_text(F.lit(ms)), ft.partition_date_text(F.lit(ms)),
        ft.yesterday(F.lit(ms)).cast("string"), ft.millis_of_text(F.lit("2022-11-13")),
        ft.millis_of_text(F.lit("2022-11-13 12:26:00"), True), ft.text_date(F.lit("no date")),
        ft.days_between(ft.day_of_millis(F.lit(ms)), F.lit("2022-11-01").cast("date")),
        ft.from_millis_whole_seconds(F.lit(ms)).cast("string"),
    ).first()
    assert tuple(row) == (
        "2022-11-13", "2022-11-13 12:26:00", "20221113", "2022-11-12", 1_668_297_600_000,
        1_668_342_360_000, None, 12, "2022-11-13 12:26:00",
    )


def test_days_follow_the_session_zone(spark):
    late_evening = MONDAY + 17 * 3_600_000  # next day in +8
    rows = pages(spark, [page("1", None, MONDAY + 3_600_000, 0), page("1", None, late_evening, 1)])
    assert traffic.unique_visitors(rows).count() == 1
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        assert traffic.unique_visitors(rows).count() == 2
        shifted = tumble(
            rows.select(ft.from_millis("ts").alias("t")), "t", [], {"n": F.count("*")}, "1 day", "16 hours"
        )
        assert sorted(str(r.cur_date) for r in shifted.collect()) == ["2023-11-15", "2023-11-16"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_bounded_join(spark):
    left = spark.sql("select 1 k, timestamp'2024-01-01 00:00:00' a union all select 2, timestamp'2024-01-01'")
    right = spark.sql("select 1 j, timestamp'2024-01-01 00:15:05' b union all select 2, timestamp'2024-01-01 00:15:06'")
    on = F.col("k") == F.col("j")
    assert [r.k for r in joins.bounded_join(left, right, on, ("a", "b"), "905 seconds").collect()] == [1]
    assert joins.bounded_join(left, right, on, ("a", "b"), "905 seconds", "left").count() == 2
    assert joins.bounded_join(left, right, on, ("a", "b"), None).count() == 2


# --------------------------------------------------------------------------
# Plans
# --------------------------------------------------------------------------
def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_visitors_shrink_before_the_shuffle(spark):
    rows = pages(spark, random_pages(1))
    text = plan(traffic.unique_visitors(rows))
    assert "row_number(), 1, Partial" in text
    assert text.count("Exchange") == 1
    assert "partial_min(ts" in plan(summary.page_window(rows))


def test_no_window_without_a_partition(spark):
    rows = pages(spark, random_pages(1))
    for df in (traffic.user_jumps(rows), summary.login_window(rows), state.repair_new_visitors(rows)):
        assert "SinglePartition" not in plan(df)


def test_the_dictionary_is_broadcast_on_its_size(spark):
    feed = tables.change_feed(spark, "/root/testdata/sf0.001")
    dic = tables.base_dic(spark)
    assert "BroadcastHashJoin [source_type" in plan(trade.order_wide(feed, dic))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10")
    try:
        assert "Broadcast" not in plan(trade.order_wide(feed, dic))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scans_read_only_what_a_query_names(spark, tmp_path):
    views, log = str(tmp_path / "pages"), str(tmp_path / "changes")
    pages(spark, random_pages(1)).write.parquet(views)
    text = plan(summary.page_window(spark.read.schema(s.PAGE_VIEW).parquet(views)))
    assert "ReadSchema: struct<common:struct<mid:string>,page:struct<page_id:string>,ts:bigint>" in text

    feed = change_rows(spark, ("cart_info", "insert", {"id": 1}, None), ("user_info", "insert", {"id": 1}, None))
    rows = feed("cart_info").unionAll(feed("user_info"))
    rows.write.partitionBy("table").parquet(log)
    stored = ch.feed(spark.read.schema(s.TYPED_CHANGE).parquet(log))
    text = plan(tool.user_register(stored))
    assert "data:struct<id:string,create_time:string>" in text
    assert "PartitionFilters: [isnotnull(table" in text and "PushedFilters: [IsNotNull(type)" in text
