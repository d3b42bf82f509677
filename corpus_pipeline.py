"""The corpus pipeline: raw documents to packed training sequences.

Each stage takes what its predecessor kept and returns the columns of `documents`; the last
returns the pieces of the packed documents. Between stages the rows are written as Parquet
and read again, so a lost executor never costs more than its own stage.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import decontaminate, jaccard, packing, suffixdedup, toxicity
from tidewell.llm.common import MAX_RECORDS, stored

#: Rows in an Arrow batch of the pipeline. A stage's last step is written by its caller; with
#: Spark's 10,000 a batch would be all texts of a task at once, in the JVM and in Python.
BATCH_ROWS = 1000


def bounded(stage):
    """A stage under the pipeline's batches: a setting of the session it runs in, whatever writes it."""

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if int(spark.conf.get(MAX_RECORDS)) > BATCH_ROWS or int(spark.conf.get(MAX_RECORDS)) <= 0:
            spark.conf.set(MAX_RECORDS, BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run_stage


@bounded
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the labelled rows that are still here teach."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@bounded
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates stays."""
    return jaccard.first_documents(docs)


@bounded
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes are cut out; documents stay, those left empty as well."""
    rest = suffixdedup.deduplicate(docs)
    changed = rest.withColumns({"text": F.col("kept"), "n_chars": F.length("kept").cast("long")})
    return changed.select(*docs.columns)


@bounded
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    judged = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return judged.where(~F.col("contaminated")).select(*docs.columns)


@bounded
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document in a sequence of a permitted length."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("suffix-array dedup", cut_repeats),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

#: No SQL says what the classifier, the joins and the packing do; tests hold each stage
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
