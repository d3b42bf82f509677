"""Append sinks: JSON messages and typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def to_messages(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows as JSON text, in the declared column order of the sink."""
    picked = columns or rows.columns
    return rows.select(F.to_json(F.struct(*picked)).alias("value"))


def append(
    rows: DataFrame,
    path: str,
    checkpoint: str | None = None,
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
    trigger: dict | None = None,
    **options: str,
) -> StreamingQuery | None:
    """Append to a folder: exactly once for streams, a plain append for batches."""
    if not rows.isStreaming:
        writer = rows.write.format(fmt).mode("append").options(**options)
        (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
        return None
    writer = rows.writeStream.format(fmt).outputMode("append").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(**_trigger(trigger)).option("checkpointLocation", checkpoint).start(path)


def to_kafka(
    messages: DataFrame, servers: str, name: str, checkpoint: str | None = None,
    trigger: dict | None = None, **options: str,
) -> StreamingQuery | None:
    """Send messages to a Kafka topic (at least once; needs the connector)."""
    values = messages.select("value")
    options = {"kafka.bootstrap.servers": servers, "topic": name, **options}
    if not values.isStreaming:
        values.write.format("kafka").options(**options).save()
        return None
    writer = values.writeStream.format("kafka").options(**options).trigger(**_trigger(trigger))
    return writer.option("checkpointLocation", checkpoint).start()


def _trigger(trigger: dict | None) -> dict:
    return trigger or {"processingTime": "3 seconds"}
