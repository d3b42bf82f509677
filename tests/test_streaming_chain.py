"""Chained streams lose nothing: joins that wait by the wall clock, codes that come later,
payments that arrive in any order, keyed tables that are folded and read as streams."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import schemas as s
from tidewell.operators.joins import name_codes
from tidewell.operators.windows import as_text
from tidewell.plans import summary
from tidewell.sinks.batches import commit, globbed
from tidewell.sinks.keyed import KeyedTable
from tidewell.sources import tables
from tidewell.streaming import jobs
from tidewell.streaming.meet import meet
from test_streaming_trade import START, change, clock, same

IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


def arrive(spark, w, changes, seq):
    rows = [(json.dumps(c), seq + k) for k, c in enumerate(changes)]
    spark.createDataFrame(rows, s.MESSAGE).coalesce(1).write.mode("append").parquet(w.folder("topic_db"))


def run(w, *names):
    for name in names:
        query = jobs.JOBS[name](w)
        query.awaitTermination(200)
        assert query.exception() is None, name


def test_a_batch_of_hours_loses_no_payment(spark, tmp_path):
    """480 orders a minute apart, in two parts of four hours; the payment job reads between the
    data batch of `order_wide` and the batch that releases its held-back lines."""
    w = jobs.Warehouse(spark, str(tmp_path), size="1 hour", trigger={"availableNow": True})
    tables.base_dic(spark).write.parquet(w.folder("base_dic"))
    placed, paid = [], []
    for i in range(480):
        t = START + 60 * i
        placed.append([
            change("order_info", "insert", t, {"id": i, "user_id": i % 50, "order_status": "1001"}),
            change("order_detail", "insert", t, {
                "id": i, "order_id": i, "sku_id": 1, "create_time": clock(t), "source_type": "2401", "sku_num": 1}),
        ])
        if i % 3 == 0:
            placed[-1].append(change("order_detail_activity", "insert", t + 1, {"order_detail_id": i, "activity_id": 1}))
        paid.append(change("payment_info", "insert", t + 300, {
            "user_id": i % 50, "order_id": i, "payment_type": "1101", "callback_time": clock(t + 300)}))
    far = START + 10_000_000
    flush = [
        change("order_info", "insert", far, {"id": "flush"}),
        change("order_detail", "insert", far, {"id": "flush", "order_id": "flush", "source_type": "2401"}),
        change("order_detail_activity", "insert", far, {"order_detail_id": "flush"}),
        change("order_detail_coupon", "insert", far, {"order_detail_id": "flush"}),
    ]
    parts = [
        [c for order in placed[:240] for c in order] + paid[:240],
        [c for order in placed[240:] for c in order] + paid[240:],
        flush,
    ]
    for n, part in enumerate(parts):
        arrive(spark, w, part, 10_000 * n)
        for name in ("changes", "order_wide", "order_placed", "payment", "payer_measures", "payer_window"):
            spark.conf.set(IDLE, str(name != "order_wide" or part is flush).lower())
            try:
                run(w, name)
            finally:
                spark.conf.unset(IDLE)
    got = w.detail("payment", stream=False)
    assert sorted(int(r[0]) for r in got.select("order_detail_id").collect()) == list(range(480))
    same(as_text(w.summary("payer_window").read(spark)), as_text(summary.payer_window(got, "1 hour")))


def test_a_code_that_is_added_later_is_found_without_a_restart(spark, tmp_path):
    w = jobs.Warehouse(spark, str(tmp_path), trigger={"processingTime": "0 seconds"})
    tables.base_dic(spark).write.parquet(w.folder("base_dic"))

    def cart(i, code):
        return change("cart_info", "insert", START + i, {"id": i, "user_id": 1, "sku_id": 1, "source_type": code, "sku_num": 1})

    arrive(spark, w, [cart(1, "2401"), cart(2, "9999")], 0)
    land = jobs.JOBS["changes"](w)
    land.processAllAvailable()
    query = jobs.JOBS["cart_add"](w)
    try:
        query.processAllAvailable()
        assert [r["id"] for r in w.detail("cart_add", stream=False).collect()] == ["1"]
        new = spark.createDataFrame([("9999", "new shop", None, None, None), ("2401", "renamed", None, None, None)], s.DICTIONARY)
        new.withColumn("operate_time", F.to_timestamp(F.lit("2100-01-01"))).write.mode("append").parquet(w.folder("base_dic"))
        arrive(spark, w, [cart(3, "9999"), cart(4, "2401")], 10)
        land.processAllAvailable()
        query.processAllAvailable()
        rows = {r["id"]: r["source_type_name"] for r in w.detail("cart_add", stream=False).collect()}
        assert rows.keys() == {"1", "3", "4"} and rows["3"] == "new shop" and rows["4"] == "renamed"
    finally:
        query.stop()
        land.stop()


@pytest.mark.parametrize("seed", [1, 2])
def test_payers_in_any_order_of_arrival(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(str(rng.randrange(12)), str(START + rng.randrange(4 * 86_400))) for _ in range(300)]
    w = jobs.Warehouse(spark, str(tmp_path), size="1 hour", trigger={"availableNow": True})
    empty = {c: F.lit(None).cast("string") for c in s.PAYMENT if c not in ("user_id", "ts", "row_op_ts")}
    paid = spark.createDataFrame(rows, "user_id string, ts string").withColumns(
        {**empty, "row_op_ts": F.lit(None).cast("timestamp")}
    ).select(*s.PAYMENT)
    for n, part in enumerate(paid.randomSplit([1.0] * 4, seed)):
        commit(part, w.folder("payment"), n)
        run(w, "payer_measures", "payer_window")
    got = w.summary("payer_window")
    same(as_text(got.read(spark)), as_text(summary.payer_window(paid, "1 hour")))
    day = got.read(spark).select(F.min("cur_date")).first()[0]
    one = got.read(spark, cur_date=str(day))
    assert {r["cur_date"] for r in one.collect()} == {day}
    assert all(f"cur_date={day}" in f for f in one.inputFiles()) and one.inputFiles()


def test_rows_meet_within_the_bound_in_whatever_batch(spark, tmp_path):
    rng = random.Random(3)
    left = [(str(rng.choice([1, 1, 1, 2, 3, None])), i, START + rng.randrange(400)) for i in range(120)]
    right = [(str(rng.choice([1, 1, 2, 4])), -i, START + rng.randrange(400)) for i in range(120)]
    want = sorted((a[1], b[1]) for a in left for b in right if a[0] == b[0] != "None" and abs(a[2] - b[2]) <= 60)
    left = [(None if k == "None" else k, i, t) for k, i, t in left]
    schema = "{0}k string, {0} long, {0}s long"
    for n in range(3):
        for rows, c in ((left, "l"), (right, "r")):
            # The right side comes one batch before the left.
            part = rows[40 * n : 40 * n + 40] if c == "r" else rows[40 * (n - 1) : 40 * n] if n else []
            if c == "l" and n == 2:
                part = rows[40:]
            spark.createDataFrame(part, schema.format(c)).write.mode("append").parquet(f"{tmp_path}/{c}")
        sides = [
            spark.readStream.schema(schema.format(c)).parquet(f"{tmp_path}/{c}").withColumn(f"{c}t", F.timestamp_seconds(f"{c}s"))
            for c in "lr"
        ]
        met = meet(*sides, ("lk", "rk"), ("lt", "rt"), "60 seconds")
        met.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(
            f"{tmp_path}/out"
        ).awaitTermination(120)
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("l", "r").collect()) == want


KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def test_buckets_are_rewritten_only_where_keys_change(spark, tmp_path):
    table = KeyedTable(str(tmp_path), KV, ["k"], version=["v"], buckets=8, fold_every=1, deletes=True)
    table.write(spark.createDataFrame([(f"k{i}", 1) for i in range(40)], KV), 0)
    assert len(table._bases(spark)) == 8 and table._deltas(spark) == []
    table.write(spark.createDataFrame([("k3", 5), ("k4", 0)], KV), 1)
    rows = dict(map(tuple, table.read(spark).collect()))
    assert len(rows) == 40 and rows["k3"] == 5 and rows["k4"] == 1
    assert len(globbed(spark, f"{tmp_path}/kind=base/batch={1:012d}/bucket=*")) <= 2
    # A removed key stays removed when an older row comes late, and comes back with a newer one.
    gone = spark.createDataFrame([("k3", 6, True), ("k9", 2, True)], "k string, v long, _deleted boolean")
    table.write(gone, 2)
    table.write(spark.createDataFrame([("k3", 4), ("k9", 7)], KV), 3)
    rows = dict(map(tuple, table.read(spark).collect()))
    assert "k3" not in rows and rows["k9"] == 7 and len(rows) == 39
    table.write(gone, 2)  # repeated after a failure
    assert dict(map(tuple, table.read(spark).collect())) == rows


def test_folding_by_the_job_and_a_stream_out_of_the_table(spark, tmp_path):
    schema = T.StructType([*KV.fields, T.StructField("day", T.StringType())])
    table = KeyedTable(f"{tmp_path}/t", schema, ["k", "day"], ["day"], rules={"v": "sum"}, fold_every=3)
    total = 0
    for n in range(8):
        table.write(spark.createDataFrame([("a", n, f"d{n % 2}"), ("b", 1, "d0")], schema), n)
        total += n + 1
        out = table.changes(spark).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c")
        out.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination(120)
        assert table.read(spark).select(F.sum("v")).first()[0] == total
    assert len(table._deltas(spark)) == 2  # the last fold was after batch 5
    seen = spark.read.parquet(f"{tmp_path}/out")
    assert seen.select(F.sum("v")).first()[0] == total and seen.select("batch").distinct().count() == 8
    assert table.read(spark, day="d1").select(F.sum("v")).first()[0] == 1 + 3 + 5 + 7


def test_the_rows_of_a_batch_are_not_broadcast(spark, capsys):
    """A batch without input releases what the joins held and seems empty to Spark; the dictionary
    must be the side that is broadcast, however small the batch seems."""
    rows = spark.createDataFrame([("2401", None)], "source_type string, source_type_name string")
    dictionary = spark.createDataFrame([(str(c), f"n{c}") for c in range(2400, 2500)], "dic_code string, dic_name string")
    named = name_codes(rows, dictionary, {"source_type": "source_type_name"})
    named.explain()
    plan = capsys.readouterr().out
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert named.collect() == [("2401", "n2401")]
