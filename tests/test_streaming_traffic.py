"""The streaming traffic jobs give what the batch plans give."""

import pytest
from pyspark.sql import functions as F

from tidewell import schemas as s
from tidewell.operators import logs
from tidewell.operators.windows import as_text
from tidewell.plans import summary, traffic
from tidewell.sources import tables
from tidewell.streaming import jobs

FOLDER = "/root/testdata/sf0.001"
PARTS = [(0, 400), (400, 10**8)]
CHAIN = [
    "traffic", "dirty", "unique_visitor", "user_jump", "keyword_window", "traffic_window",
    "page_measures", "page_window", "login_measures", "login_window",
]
FLUSH = "flush"


def run(job, warehouse):
    query = job(warehouse)
    query.awaitTermination(240)
    assert query.exception() is None


def same(got, want):
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a = sorted(map(tuple, got.select(*columns).collect()), key=repr)
    b = sorted(map(tuple, want.select(*columns).collect()), key=repr)
    assert len(a) == len(b)
    assert a == b


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    """The log arrives in parts; every job runs once after each part."""
    root = str(tmp_path_factory.mktemp("traffic"))
    w = jobs.Warehouse(spark, root, size="1 day", trigger={"availableNow": True})
    messages = tables.log_messages(spark, FOLDER)
    record = '{"common":{"mid":"%s","uid":"%s","is_new":"0"},"page":{"page_id":"home"},"ts":%d}'
    flush = spark.createDataFrame([(record % (FLUSH, FLUSH, 1709251200000), 10**9)], s.MESSAGE)
    parts = [messages.where((F.col("seq") >= a) & (F.col("seq") < b)) for a, b in PARTS] + [flush]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(w.folder("topic_log"))
        for name in CHAIN:
            run(jobs.JOBS[name], w)
    return w


@pytest.fixture(scope="module")
def batch_pages(spark):
    """Page views of the same log, by the batch plan."""
    log = traffic.clean_log(tables.log_messages(spark, FOLDER))
    return logs.pages(log)


def own(rows):
    return rows.where(F.col("common.mid") != FLUSH)


def test_routing_equals_batch(spark, warehouse):
    log = traffic.clean_log(tables.log_messages(spark, FOLDER))
    want = logs.route(log).select("topic", "seq", "value")
    got = spark.read.parquet(warehouse.folder("traffic")).where("seq < 1000000000")
    same(got.select("topic", "seq", "value"), want)


def test_dirty_records(spark, warehouse):
    want = logs.dirty(logs.parse(tables.log_messages(spark, FOLDER)))
    same(spark.read.parquet(warehouse.folder(logs.DIRTY)), want)


def test_unique_visitors(spark, warehouse, batch_pages):
    got = spark.read.parquet(warehouse.folder("unique_visitor"))
    same(own(got), traffic.unique_visitors(batch_pages))


def test_bounces(spark, warehouse, batch_pages):
    got = spark.read.parquet(warehouse.folder("user_jump"))
    same(own(got), traffic.user_jumps(batch_pages))


def test_traffic_window(spark, warehouse, batch_pages):
    got = warehouse.summary("traffic_window").read(spark).where("vc is not null")
    want = summary.traffic_window(
        batch_pages, traffic.unique_visitors(batch_pages), traffic.user_jumps(batch_pages), "1 day"
    )
    same(as_text(got), as_text(want))


def test_page_window(spark, warehouse, batch_pages):
    got = warehouse.summary("page_window").read(spark).where("cur_date < '2024-03-01'")
    same(as_text(got), as_text(summary.page_window(batch_pages, "1 day")))


def test_login_window(spark, warehouse, batch_pages):
    got = warehouse.summary("login_window").read(spark).where("cur_date < '2024-03-01'")
    same(as_text(got), as_text(summary.login_window(batch_pages, "1 day")))


def test_compaction_keeps_the_result(spark, warehouse):
    table = warehouse.summary("login_window")
    before = sorted(map(tuple, table.read(spark).collect()))
    table.compact(spark)
    assert sorted(map(tuple, table.read(spark).collect())) == before
    # a repeated old batch is ignored once it is part of the base
    table.write(table.read(spark).limit(0), 0)
    assert sorted(map(tuple, table.read(spark).collect())) == before
