"""The pipeline's stages one by one, the registered queries against SQL, and the guard."""

import glob
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from test_jaccard import brute as components
from test_suffixdedup import brute as kept_bytes
from tidewell.llm import queries, toxicity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_follow_their_operators(spark, sf, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "n-gram Jaccard join", "suffix-array dedup", "benchmark decontamination", "best-fit packing"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")

    clean = corpus_pipeline.stored(stages["toxicity"](spark, docs, sf), "t")
    scored = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(docs.select("doc_id", "text"), labels).collect()}
    assert {r["doc_id"] for r in clean.collect()} == {i for i, p in scored.items() if not p}

    firsts = corpus_pipeline.stored(stages["n-gram Jaccard join"](spark, clean, sf), "j")
    want = components([(r["doc_id"], r["text"]) for r in clean.collect()])
    assert {r["doc_id"] for r in firsts.collect()} == {i for i, (_, c) in want.items() if i == c}

    cut = corpus_pipeline.stored(stages["suffix-array dedup"](spark, firsts, sf), "s")
    want = kept_bytes(sorted((r["doc_id"], (r["text"] or "").encode()) for r in firsts.collect()), 100)
    got = {r["doc_id"]: r for r in cut.collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert len(r["text"].encode()) <= want[i][0] - want[i][1] and r["n_chars"] == len(r["text"])

    rest = corpus_pipeline.stored(stages["benchmark decontamination"](spark, cut, sf), "d")
    hit = duckdb.connect()
    hit.register("documents", cut.toPandas())
    hit.register("benchmark", spark.read.parquet(f"{sf}/benchmark.parquet").toPandas())
    dirty = hit.execute(f"SELECT doc_id FROM ({queries.OP2_SQL}) WHERE contaminated").fetchall()
    assert {r["doc_id"] for r in rest.collect()} == got.keys() - {i for (i,) in dirty}
    for stage in (clean, firsts, cut, rest):
        assert stage.columns == COLUMNS

    packed = stages["best-fit packing"](spark, rest, sf).collect()
    assert {r["doc_id"] for r in packed} == {r["doc_id"] for r in rest.collect()}


def test_first_documents_of_repeated_rows(spark):
    rows = [(1, "a b c d e f g", "x"), (1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (None, None, "z"), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, d string")
    kept = corpus_pipeline.jaccard.first_documents(df)
    assert sorted(map(str, kept.collect())) == sorted(map(str, df.where("doc_id is null or doc_id <> 2").distinct().collect()))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {path.rpartition('/')[2][:-8]} AS SELECT * FROM '{path}'")
    got, want = entry.queries()[name](spark, sf).toPandas(), con.execute(entry.oracle_sql()[name]).df()
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    texts = [sorted(map(tuple, x[names].astype(str).to_numpy())) for x in (got, want)]
    assert texts[0] == texts[1]


def test_all_are_registered():
    found = entry.queries()
    assert "pipeline" in found
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in found) == 1


def test_executors_need_no_package(tmp_path):
    """A session started elsewhere, whose workers cannot import the package."""
    code = f"""
import sys
sys.path.insert(0, {str(entry.__file__.rpartition('/')[0])!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from tidewell.llm import counts
df = spark.createDataFrame([("a b",), (None,)], "text string")
print("ROWS", sorted(map(tuple, counts.histogram(df).collect())))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=240, env={k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"})
    assert "ROWS [(0, 1), (2, 1)]" in done.stdout, done.stderr[-2000:]
