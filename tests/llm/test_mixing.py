"""Targets, epochs and the sampled rest of the mix against plain Python."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from tidewell.llm import mixing, queries

SCHEMA = "doc_id long, source string, text string"


def shares(sizes, weights=(1, 2, 3), most=3):
    """Targets by sharing again and again, in exact fractions."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped, total = {}, sum(sizes.values())
    while True:
        rest = total - sum(capped.values())
        open_ = [s for s in names if s not in capped]
        each = {s: Fraction(rest * w[s], sum(w[t] for t in open_)) for s in open_}
        above = [s for s in open_ if each[s] > most * sizes[s]]
        if not above:
            return each | capped
        capped |= {s: most * sizes[s] for s in above}


def brute(rows):
    """rows: (id, source, text); (id, size, source_size, target, taken) sorted as text."""
    docs = []
    for i, s, t in rows:
        t = t or ""
        odd = len(re.findall(r"[0-9#*$%&|<>{}=_+~^@]", t))
        weight = max(0.1, 1.0 - 2.0 * odd / max(len(t), 1))
        digest = hashlib.md5(f"7:{'' if i is None else i}:{t}".encode()).hexdigest()
        key = -math.log((int(digest[:13], 16) + 0.5) / 2.0**52) / weight
        docs.append((key, i is not None, i or 0, digest, i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t))))
    sizes = defaultdict(int)
    for d in docs:
        sizes[d[5]] += d[6]
    goal = shares(sizes)
    before, out = Counter(), []
    for d in sorted(docs, key=lambda d: d[:4]):
        size, s = d[6], d[5]
        epochs = goal[s] // sizes[s] if sizes[s] else 0
        rest = goal[s] - epochs * sizes[s]
        once = size > 0 and 2 * before[s] + size <= 2 * rest
        before[s] += size
        out.append((d[4], size, sizes[s], round(float(goal[s]), 6), int(size * (epochs + once))))
    return sorted(map(str, out))


def result(df):
    rows = df.select("id", "size", "source_size", "target", "taken").collect()
    return sorted(str((*r[:3], round(r["target"], 6), r["taken"])) for r in rows)


def test_whole_table(spark, sf, docs):
    rows = [tuple(r) for r in docs.select("doc_id", "source", "text").collect()]
    assert result(mixing.mix(docs)) == brute(rows)
    got = queries.op12_mixing(spark, sf)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_small_sources_stop_and_the_rest_is_shared_again(spark):
    rows = [(i, "big", "w " * (i % 9)) for i in range(400)]
    rows += [(1000 + i, f"s{i % 7}", "a b c #1 2") for i in range(30)] + [(2000, "t", "x"), (2001, None, "x y")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = mixing.mix(df)
    assert result(got) == brute(rows)
    by = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("m"))
    for r in by.collect():
        assert abs(r["taken"] - r["target"]) <= r["m"] / 2
    assert got.where("taken > 3 * size").count() == 0


def test_nulls_empty_and_long_texts_ties_and_repeated_rows(spark):
    rows = [(None, None, None), (None, "a", ""), (3, "a", None), (4, "", "x " * 300_000), (4, "b", "x y")]
    rows += [(5, "b", "one two three")] * 12 + [(6, "c", " \t\n"), (None, "b", "z")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"size": F.lit("x"), "key": F.lit(1), "_at": F.lit(2)})
    assert result(mixing.mix(df)) == brute(rows)
    assert mixing.mix(df.limit(0)).count() == 0
    assert result(mixing.mix(df.where("source = 'c'"))) == brute([(6, "c", " ")])


def test_reruns_and_layout_agree(spark, docs):
    one = result(mixing.mix(docs.repartition(5)))
    assert one == result(mixing.mix(docs.coalesce(1)))


def test_quality_steers_the_sample(spark):
    rows = [(i, "a" if i % 2 else "b", "w w w w") for i in range(4000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(df, weights=(1, 3), quality=F.when(F.col("doc_id") % 4 < 2, 9.0).otherwise(1.0))
    # a takes half of its documents: the good ones much more often.
    chosen = got.where("source = 'a' and chosen").select((F.col("id") % 4 < 2).alias("good")).collect()
    assert len(chosen) == 1000 and sum(r["good"] for r in chosen) > 750


def test_the_mix_itself(spark):
    rows = [(i, "s" if i % 3 else "t", f"w{i} " * (1 + i % 5)) for i in range(60)] + [(0, "t", "w0 ")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("copies", F.lit("mine"))
    plan = mixing.mix(df, weights=(1, 9)).collect()
    mixed = mixing.mixture(df, weights=(1, 9))
    assert mixed.columns == df.columns
    words = mixed.select(F.sum(F.size(F.split(F.trim("text"), " ")))).first()[0]
    assert words == sum(r["taken"] for r in plan)
