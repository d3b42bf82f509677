"""Keyed tables, append sinks, late records."""


import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell import schemas as s
from tidewell.operators import changes as ch
from tidewell.operators import state as batch
from tidewell.sinks import messages as sink
from tidewell.sinks.keyed import KeyedTable
from tidewell.sources import dictionary, streams, tables
from tidewell.streaming import state, windows

SITES = T.StructType(
    [T.StructField("siteid", T.IntegerType()), T.StructField("citycode", T.ShortType()),
     T.StructField("username", T.StringType()), T.StructField("pv", T.LongType())]
)


def table_rows(table, spark):
    return sorted(tuple(r) for r in table.read(spark).collect())


def run_once(stream, start):
    query = start(stream)
    query.awaitTermination(120)
    assert query.exception() is None


def test_replacing_upserts(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType()),
                           T.StructField("day", T.StringType())])
    table = KeyedTable(str(tmp_path / "t"), schema, ["k", "day"], ["day"])
    assert table_rows(table, spark) == []

    def put(batch, *rows):
        table.write(spark.createDataFrame(rows, schema), batch)

    put(0, ("a", 1, "d1"), ("b", 2, "d1"))
    put(1, ("a", 5, "d1"), ("a", 9, "d2"))
    assert table_rows(table, spark) == [("a", 5, "d1"), ("a", 9, "d2"), ("b", 2, "d1")]
    put(1, ("a", 5, "d1"), ("a", 9, "d2"))  # the batch is repeated after a failure
    put(2)  # an empty batch
    want = [("a", 5, "d1"), ("a", 9, "d2"), ("b", 2, "d1")]
    assert table_rows(table, spark) == want
    table.compact(spark)
    assert table_rows(table, spark) == want
    put(3, ("b", 3, "d1"))
    assert table_rows(table, spark) == [("a", 5, "d1"), ("a", 9, "d2"), ("b", 3, "d1")]
    table.compact(spark)
    assert table_rows(table, spark) == [("a", 5, "d1"), ("a", 9, "d2"), ("b", 3, "d1")]
    table.drop_folded(spark)
    assert table._deltas(spark) == [] and table._folded(spark) == 3
    put(4, ("c", 4, "d2"))
    assert table_rows(table, spark)[-1] == ("c", 4, "d2")
    pruned = table.read(spark).where("day = 'd2'")
    assert "PartitionFilters: [isnotnull(day" in pruned._jdf.queryExecution().executedPlan().toString()


def test_a_write_without_its_marker_is_not_read(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    table = KeyedTable(str(tmp_path / "t"), schema, ["k"])
    table.write(spark.createDataFrame([("a", 1)], schema), 0)
    torn = f"{table.path}/kind=delta/batch={1:012d}"
    spark.createDataFrame([("a", 2)], schema).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(torn)
    assert table_rows(table, spark) == [("a", 1)]


def test_versions_win_over_batches(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    table = KeyedTable(str(tmp_path / "t"), schema, ["k"], version=["v"])
    table.write(spark.createDataFrame([("a", 7)], schema), 0)
    table.write(spark.createDataFrame([("a", 3)], schema), 1)
    assert table_rows(table, spark) == [("a", 7)]


def test_summing_table_from_text_objects_and_rows(spark, tmp_path):
    """The three ways to feed an aggregate table: JSON text, typed rows, a stream."""
    table = KeyedTable(
        str(tmp_path / "t"), SITES, ["siteid", "citycode", "username"], rules={"pv": "sum"}
    )
    loose = "siteid string, citycode string, username string, pv string"
    text = spark.createDataFrame([('{"siteid":"10","citycode":"1001","username":"ww","pv":"100"}',)], "v string")
    parsed = text.select(F.from_json("v", loose).alias("r")).select(
        *[F.col(f"r.{f.name}").cast(f.dataType).alias(f.name) for f in SITES.fields]
    )
    typed = spark.createDataFrame([(19, 18, "night", 650), (100, 1002, "lqx", 101)], SITES)
    table.write(parsed, 0)
    table.write(typed, 1)
    assert table_rows(table, spark) == [
        (10, 1001, "ww", 100), (19, 18, "night", 650), (100, 1002, "lqx", 101),
    ]
    table.compact(spark)
    table.write(parsed, 2)
    assert table_rows(table, spark)[0] == (10, 1001, "ww", 200)


def test_summing_stream(spark, tmp_path):
    source, table = str(tmp_path / "in"), KeyedTable(
        str(tmp_path / "t"), SITES, ["siteid", "citycode", "username"], rules={"pv": "sum"}
    )
    rows = spark.createDataFrame([(1, 1, "jim", 2), (2, 1, "grace", 2)], SITES)
    for _ in range(2):
        rows.write.mode("append").parquet(source)
        stream = streams.table(spark, source, SITES, stream=True)
        run_once(stream, lambda df: table.upsert(df, mode="append", trigger={"availableNow": True}))
    assert table_rows(table, spark) == [(1, 1, "jim", 4), (2, 1, "grace", 4)]


def test_messages_there_and_back(spark, tmp_path):
    rows = spark.createDataFrame([("1", None, "x")], "id string, user_id string, sku_id string")
    text = sink.to_messages(rows, ["sku_id", "id"]).withColumn("seq", F.lit(1).cast("bigint"))
    assert text.first().value == '{"sku_id":"x","id":"1"}'
    path = str(tmp_path / "topic")
    sink.append(text, path)
    back = streams.detail_rows(streams.messages(spark, path), rows.schema)
    assert [tuple(r) for r in back.collect()] == [("1", None, "x")]


def test_text_files_as_topic(spark, tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    (path / "a.json").write_text('{"table":"t","type":"insert","ts":"1"}\n\n{"table":"u","type":"x","ts":"2"}\n')
    got = ch.parse(streams.text_lines(spark, str(path)))
    assert [r.table for r in got.where("table is not null").collect()] == ["t", "u"]


def test_dictionary_from_files(spark, tmp_path):
    path = str(tmp_path / "dic")
    tables.base_dic(spark).write.parquet(path)
    assert dictionary.from_files(spark, path).where("dic_code = '1101'").first().dic_name == "alipay"


def test_configuration_from_a_change_log(spark, tmp_path):
    path = str(tmp_path / "table_process")
    tables.dim_config_log(spark).write.parquet(path)
    assert streams.config_changes(spark, path).count() == len(tables.DIM_CONFIG_LOG)


@pytest.mark.parametrize("fmt", ["kafka"])
def test_kafka_is_a_format_option(spark, fmt):
    """Without the connector Spark says that the source is missing."""
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka(spark, "broker:9092", "topic_log")


# --------------------------------------------------------------------------
# Late records
# --------------------------------------------------------------------------
def visits(spark, *seconds, vc="v1"):
    rows = [((f"m{n}", None, vc, "c", "a", "0"), ("cart", "home", None, None, 1), n * 1000, n)
            for n in seconds]
    return spark.createDataFrame(rows, s.PAGE_VIEW)


def test_late_records_correct_a_reported_window(spark, tmp_path):
    """Thirteen seconds of lateness in every feed, then a record is dropped.

    Spark drops by the watermark of the batch before, so the dropped record
    comes two batches after the one that moved the watermark.
    """
    paths = [str(tmp_path / name) for name in ("pages", "uniques", "jumps")]
    table = KeyedTable(
        str(tmp_path / "t"), s.summary_schema(s.TRAFFIC_KEYS, s.TRAFFIC_METRICS), s.TRAFFIC_KEYS,
        ["cur_date"],
    )

    def arrive(*seconds):
        # All three feeds are live; a bounce counts ten seconds after its page.
        for path, shift in zip(paths, (0, 0, 10)):
            visits(spark, *(n - shift for n in seconds)).write.mode("append").parquet(path)
        feeds = [streams.table(spark, p, s.PAGE_VIEW, True) for p in paths]
        query = table.upsert(windows.traffic_window(*feeds), trigger={"availableNow": True})
        query.awaitTermination(120)
        assert query.exception() is None
        return {r.stt.second: r.pv_ct for r in table.read(spark).collect()}

    assert arrive(1, 5) == {0: 2}
    assert arrive(21) == {0: 2, 20: 1}
    assert arrive(9) == {0: 3, 20: 1}  # reported before, corrected now
    assert arrive(40) == {0: 3, 20: 1, 40: 1}
    assert arrive(41) == {0: 3, 20: 1, 40: 2}
    assert arrive(3) == {0: 3, 20: 1, 40: 2}  # beyond the lateness
    assert arrive(29) == {0: 3, 20: 2, 40: 2}  # its window is still open


def test_a_gap_in_the_page_feed_keeps_pending_bounces(spark, tmp_path):
    """Pages jump an hour ahead before the bounces of the time before arrive."""
    paths = [str(tmp_path / name) for name in ("pages", "uniques", "jumps")]
    table = KeyedTable(
        str(tmp_path / "t"), s.summary_schema(s.TRAFFIC_KEYS, s.TRAFFIC_METRICS), s.TRAFFIC_KEYS,
        ["cur_date"],
    )

    def arrive(pages, uniques, jumps):
        for path, seconds in zip(paths, (pages, uniques, jumps)):
            visits(spark, *seconds).write.mode("append").parquet(path)
        feeds = [streams.table(spark, p, s.PAGE_VIEW, True) for p in paths]
        query = table.upsert(windows.traffic_window(*feeds), trigger={"availableNow": True})
        query.awaitTermination(120)
        assert query.exception() is None

    arrive([1, 5], [1], [])
    arrive([3601], [3601], [])
    arrive([3602], [3602], [])
    arrive([3603], [3603], [1, 5])
    assert sum(r.uj_ct for r in table.read(spark).collect()) == 2


def test_golden_bounce_stream(spark, tmp_path):
    path, out = str(tmp_path / "pages"), str(tmp_path / "out")

    def view(mid, name, last, ts):
        return ((mid, None, None, None, None, None), (name, last, None, None, None), ts, ts)

    parts = [
        [view("101", "home", None, 10_000), view("102", "home", None, 12_000)],
        [view("102", "good_list", "home", 15_000)],
        [view("102", "good_list", "detail", 30_000)],
        [view("103", "x", "y", 90_000)],
    ]
    for part in parts:
        spark.createDataFrame(part, s.PAGE_VIEW).write.mode("append").parquet(path)
        stream = state.bounces(streams.table(spark, path, s.PAGE_VIEW, True))
        run_once(stream, lambda df: sink.append(
            df, out, str(tmp_path / "cp"), trigger={"availableNow": True}))
    got = spark.read.schema(s.PAGE_VIEW).parquet(out).select("common.mid", "ts").collect()
    assert [tuple(r) for r in got] == [("101", 10_000)]


def test_bounces_have_no_python_group_per_visitor(spark, tmp_path, capsys):
    """Rows of several batches, equal times and a slice's end: as the batch form, in Spark's operators."""
    path, out = str(tmp_path / "pages"), str(tmp_path / "out")
    names = ["home", None]
    rows = [
        ((str(k % 7), None, None, None, None, None), ("x", names[k * k % 5 % 2], None, None, None), ts, k)
        for k, ts in enumerate(sorted(k * 7919 % 200_000 // 1000 * 1000 for k in range(300)))
    ]
    for part in (rows[:100], rows[100:220], rows[220:]):
        spark.createDataFrame(part, s.PAGE_VIEW).coalesce(1).write.mode("append").parquet(path)
        stream = state.bounces(streams.table(spark, path, s.PAGE_VIEW, True))
        run_once(stream, lambda df: sink.append(
            df, out, str(tmp_path / "cp"), trigger={"availableNow": True}))
    far = [(("far", None, None, None, None, None), ("x", "home", None, None, None), 10**9, -1)]
    spark.createDataFrame(far, s.PAGE_VIEW).write.mode("append").parquet(path)
    run_once(state.bounces(streams.table(spark, path, s.PAGE_VIEW, True)), lambda df: sink.append(
        df, out, str(tmp_path / "cp"), trigger={"availableNow": True}))
    got = sorted(r.seq for r in spark.read.schema(s.PAGE_VIEW).parquet(out).collect())
    want = batch.bounces(spark.createDataFrame(rows, s.PAGE_VIEW)).collect()
    assert got == sorted(r.seq for r in want) and len(got) > 10
    stream.explain()
    assert "InPandas" not in capsys.readouterr().out
