"""Topics and tables as batch or streaming sources.

A topic is a folder of files (Parquet, JSON or text) or a Kafka topic.  The
position of a query in its source lives in the query's checkpoint, so there are
no consumer groups.  The Kafka format needs its connector on the class path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.schemas import DIM_CONFIG_CHANGE, MESSAGE, PAGE_VIEW, TOPIC_MESSAGE


def _reader(spark: SparkSession, stream: bool):
    return spark.readStream if stream else spark.read


def table(
    spark: SparkSession, path: str, schema: T.StructType, stream: bool = False,
    fmt: str = "parquet", **options: str,
) -> DataFrame:
    """A folder of rows with a declared type."""
    return _reader(spark, stream).schema(schema).format(fmt).options(**options).load(path)


def messages(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """Messages of one topic folder: (value, seq)."""
    return table(spark, path, MESSAGE, stream, **options)


def topic(
    spark: SparkSession, path: str, name: str, stream: bool = False, **options: str
) -> DataFrame:
    """Messages of one topic in a folder partitioned by topic."""
    rows = table(spark, path, TOPIC_MESSAGE, stream, **options)
    return rows.where(F.col("topic") == name).select("value", "seq")


def text_lines(spark: SparkSession, path: str, stream: bool = False, **options: str) -> DataFrame:
    """Files of JSON lines.

    The time of the file is the arrival number of all its lines; within a file
    the records' own times give the order.
    """
    lines = _reader(spark, stream).format("text").options(**options).load(path)
    return lines.select(
        "value", F.unix_micros("_metadata.file_modification_time").alias("seq")
    )


def kafka(
    spark: SparkSession, servers: str, name: str, stream: bool = True, **options: str
) -> DataFrame:
    """Messages of a Kafka topic; the offset gives their order."""
    reader = _reader(spark, stream).format("kafka").options(**options)
    rows = reader.option("kafka.bootstrap.servers", servers).option("subscribe", name).load()
    return rows.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"))


def page_views(page_messages: DataFrame) -> DataFrame:
    """Typed page views from the page topic."""
    record = F.from_json("value", T.StructType([f for f in PAGE_VIEW.fields if f.name != "seq"]))
    return page_messages.where("value is not null").select(F.inline(F.array(record)), "seq")


def detail_rows(detail_messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed detail rows from a detail topic."""
    record = F.from_json("value", schema)
    return detail_messages.where("value is not null").select(F.inline(F.array(record)))


def config_changes(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """Change log of the dimension configuration.

    A first snapshot is rows of `op` 'r'; later changes are appended after it.
    """
    return table(spark, path, DIM_CONFIG_CHANGE, stream)
