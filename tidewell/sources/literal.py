"""Rows given in the program."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def rows(spark: SparkSession, values: list[tuple], schema: T.StructType) -> DataFrame:
    """A local relation: Spark knows its exact size, so joins can rely on it."""
    records = [_record(v, schema) for v in values]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(schema)))


def _record(value, schema: T.StructType):
    if value is None or isinstance(value, dict):
        return value
    return {
        f.name: _record(v, f.dataType) if isinstance(f.dataType, T.StructType) else v
        for f, v in zip(schema.fields, value)
    }
