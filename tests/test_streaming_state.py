"""State of streams: one store for each task of a join, days that are seen once."""

import datetime

from pyspark.sql import functions as F

from tidewell.sinks.messages import append
from tidewell.streaming import state
from tidewell.streaming.meet import meet

DAY = 86_400_000
START = 20_000 * DAY


def stream(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def finish(rows, path):
    append(rows, f"{path}/out", f"{path}/checkpoint", trigger={"availableNow": True}).awaitTermination()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/out")


def test_a_join_opens_one_store_for_each_task(spark, tmp_path):
    at = datetime.datetime(2024, 1, 1)
    sides = []
    for name in ("left", "right"):
        rows = spark.createDataFrame([(str(i), at) for i in range(20)], f"{name}_key string, {name}_time timestamp")
        rows.coalesce(1).write.parquet(f"{tmp_path}/{name}")
        sides.append(stream(spark, f"{tmp_path}/{name}", rows.schema))
    met = meet(*sides, ("left_key", "right_key"), ("left_time", "right_time"), "5 seconds")
    assert finish(met, str(tmp_path)).count() == 20
    parts = [p for p in (tmp_path / "checkpoint/state/0").iterdir() if p.name.isdigit()]
    assert parts and not [p for part in parts for p in part.glob("*-key*")]


def test_a_day_comes_out_once_though_its_rows_come_late(spark, tmp_path):
    """The second file holds later rows of days that the first one showed, and a new day."""
    files = [
        [("a", "home", START + 50, 1), ("a", "home", START + 20, 2), ("a", "home", START + DAY, 3),
         (None, "home", START, 4), ("b", None, START + 5, 6), ("b", None, START + 5, 5)],
        [("a", "home", START + 10, 7), ("a", "cart", START + 10, 8), ("a", "home", START + 2 * DAY, 9),
         (None, "home", START + 1, 10), ("b", None, None, 11)],
        [("a", "home", START + DAY + 1, 12), ("b", None, None, 13)],
    ]
    for rows in files:
        frame = spark.createDataFrame(rows, "mid string, page_id string, ts long, seq long")
        frame.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    pages = stream(spark, f"{tmp_path}/in", frame.schema).withColumns(
        {"event_time": F.timestamp_millis("ts"), "day": F.to_date(F.timestamp_millis("ts"))}
    )
    found = finish(state.first_of_day(pages, "mid", ["page_id"], delay="3 days"), str(tmp_path))
    assert sorted(r.seq for r in found.collect()) == [2, 3, 4, 5, 8, 9, 11]


def test_a_hot_visitor_of_many_arrow_batches(spark, tmp_path):
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 60_000).cast("string")).alias("mid"),
        (F.lit(START + 299_999) - F.col("id")).alias("ts"), F.col("id").alias("seq"),
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    at = {"event_time": F.timestamp_millis("ts"), "day": F.to_date(F.timestamp_millis("ts"))}
    found = finish(
        state.first_of_day(stream(spark, f"{tmp_path}/in", rows.schema).withColumns(at), "mid"), str(tmp_path)
    )
    best = rows.groupBy("mid").agg(F.max("seq").alias("seq"))
    assert sorted(map(tuple, found.select("mid", "seq").collect())) == sorted(map(tuple, best.collect()))
