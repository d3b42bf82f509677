"""The dictionary table, from files or from the business database."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.schemas import DICTIONARY

def from_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(DICTIONARY).format(fmt).load(path)


def from_database(spark: SparkSession, url: str, table: str = "base_dic", **options: str) -> DataFrame:
    """Over JDBC; driver class and credentials come as options."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()
