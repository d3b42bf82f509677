"""What streams leave on disk: rows stored once, small state, no files of what has ended."""

import datetime
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.plans import trade
from tidewell.session import tuned
from tidewell.sinks.batches import globbed, land
from tidewell.sinks.keyed import KeyedTable
from tidewell.sources import tables
from tidewell.streaming import jobs
from tidewell.streaming.replay import Replay

LINES = 80


@pytest.fixture
def folder(spark, tmp_path):
    """Orders of two lines; every fourth line has an activity, every fifth a coupon."""
    day = [datetime.datetime(2024, 1, 1) + datetime.timedelta(days=i) for i in range(LINES)]
    orders = [(k, k % 7, "FOP"[k % 3], 1.0, day[k], "") for k in range(LINES // 2)]
    orders += [(None, 1, "F", 1.0, day[0], ""), orders[3]]
    lines = [
        (i // 2, i, i % 9, i % 2, 2.0, 3.5, 0.09 if i % 5 == 0 else 0.01, 0.0, "R" if i % 4 == 0 else "N", "F", day[i])
        for i in range(LINES)
    ]
    lines += [lines[8], lines[20], (None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "N", "F", day[5])]
    for name, rows in (("orders", orders), ("lineitem", lines)):
        spark.createDataFrame(rows, tables.TABLES[name]).coalesce(2).write.parquet(f"{tmp_path}/t/{name}.parquet")
    return f"{tmp_path}/t"


def test_lines_that_the_left_joins_release_are_not_stored_for_their_orders(spark, folder):
    session = tuned(spark, "UTC")
    replay = Replay(session, folder)
    query = jobs.JOBS["order_wide"](replay.w)
    query.awaitTermination(200)
    last = [p for p in query.recentProgress if p["stateOperators"]][-1]
    orders, *left = [x["numRowsUpdated"] for x in last["stateOperators"]]
    assert sum(left) > LINES // 2 and orders == 0
    logs = globbed(session, f"{replay.w.checkpoint('order_wide')}/state/*/*/*.changelog")
    assert logs
    for path in logs:
        with open(path.removeprefix("file:"), "rb") as f:
            assert f.read(4) == b"\x28\xb5\x2f\xfd"  # zstd
    # The rows are those of the batch query.
    dic = tables.base_dic(session)
    want = trade.order_wide(tables.change_feed(session, folder), dic).drop("row_op_ts", "old")
    got = replay.w.detail("order_wide", stream=False).where("order_id <> '-1'").drop("row_op_ts", "old")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_replay_forgets_jobs_that_have_ended(spark, folder):
    session = tuned(spark, "UTC")
    replay = Replay(session, folder)
    placed = replay.detail("order_wide", "order_placed")
    assert globbed(session, replay.w.checkpoint("*")) == []
    assert globbed(session, replay.w.folder("order_wide")) and placed.count() > 0


def shuffles(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {n for n in names if n.startswith("shuffle_")}


def test_the_shuffles_of_stored_batches_are_dropped(spark, tmp_path):
    for _ in range(4):
        spark.range(100).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    rows = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").repartition(3)
    before, made, left = shuffles(spark), set(), set()

    def finish(batch):
        left.update(shuffles(spark) & made)  # of the batches before this one
        batch.foreach(lambda _: None)
        made.update(shuffles(spark) - before)
        return batch.hint("rebalance", "id")

    land(rows, f"{tmp_path}/out", f"{tmp_path}/c", finish, trigger={"availableNow": True}).awaitTermination(200)
    assert made and not left
    until = time.monotonic() + 20
    while shuffles(spark) - before and time.monotonic() < until:  # dropped aside
        time.sleep(0.2)
    assert not shuffles(spark) - before
    assert spark.read.parquet(f"{tmp_path}/out").count() == 400


def test_upserts_and_folds_leave_no_shuffles(spark, tmp_path):
    for n in range(3):
        spark.range(100).withColumns({"k": F.col("id").cast("string"), "v": F.lit(n).cast("long")}).select("k", "v").write.mode(
            "append").parquet(f"{tmp_path}/in")
    before = shuffles(spark)
    table = KeyedTable(f"{tmp_path}/t", KV, ["k"], version=["v"], buckets=4, fold_every=1)
    rows = spark.readStream.schema(KV).parquet(f"{tmp_path}/in").repartition(3)
    table.upsert(rows, "append", {"availableNow": True}).awaitTermination(200)
    until = time.monotonic() + 20
    while shuffles(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffles(spark) - before
    assert table.read(spark).agg(F.count("*"), F.sum("v")).first() == (100, 200)


KV = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def test_a_folded_table_is_read_without_a_shuffle(spark, tmp_path):
    def plan(rows):
        return rows._jdf.queryExecution().executedPlan().toString()

    table = KeyedTable(f"{tmp_path}/t", KV, ["k"], version=["v"], buckets=4, fold_every=1, deletes=True)
    for n in range(3):
        table.write(spark.createDataFrame([(None, n), (f"k{n}", 1), ("k", n), ("k", n + 7)], KV), n)
    assert "Exchange" not in plan(table.read(spark))
    assert sorted(map(str, table.read(spark).collect())) == sorted(
        map(str, spark.createDataFrame([(None, 2), ("k", 9), ("k0", 1), ("k1", 1), ("k2", 1)], KV).collect())
    )
    # Batches after the fold still need it, and so do partitions that share a key.
    later = KeyedTable(f"{tmp_path}/u", KV, ["k"], version=["v"], buckets=4, fold_every=2)
    for n in range(3):
        later.write(spark.createDataFrame([("k", n)], KV), n)
    assert "Exchange" in plan(later.read(spark)) and later.read(spark).collect() == [("k", 2)]
    day = T.StructType([*KV.fields, T.StructField("day", T.StringType())])
    moved = KeyedTable(f"{tmp_path}/w", day, ["k"], ["day"], version=["v"], fold_every=1)
    moved.write(spark.createDataFrame([("k", 1, "d1")], day), 0)
    moved.write(spark.createDataFrame([("k", 2, "d2")], day), 1)
    assert [tuple(r) for r in moved.read(spark).collect()] == [("k", 2, "d2")]
