"""Collocations against plain Python, with tiles, tails and parts of every size."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewell.llm import phrases, queries

SCHEMA = "lang string, text string"


def brute(rows, min_count=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    gone = set()
    for (lang, p), a in found.items():
        if len(p) == 3:
            gone |= {(lang, q) for q in (p[:2], p[1:]) if 100 * a >= 50 * f[lang, q]}
    out = {}
    for (lang, p), a in found.items():
        if (lang, p) not in gone:
            cuts = [(10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        str((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
        for lang, all_ in out.items()
        for i, (s, a, p, l, r) in enumerate(sorted(all_)[:top])
    )


def result(df):
    return sorted(str(tuple(r)) for r in df.collect())


def prose(rng, words, n):
    mark = lambda: rng.choice([" "] * 9 + [". ", "\n", ",", "\t", "  ", "?! "])
    return "".join(rng.choice(words) + mark() for _ in range(n))


def test_whole_table(spark, sf, docs):
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    got = queries.op13_phrases(spark, sf)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert result(got) == brute(rows)


@pytest.mark.parametrize("head, tile, full", [(1 << 18, 1 << 10, 1 << 15), (16, 4, 3), (4, 4, 1), (1, 1, 1)])
def test_tiles_and_tails_of_every_size(spark, monkeypatch, head, tile, full):
    for name, value in (("HEAD", head), ("TILE", tile), ("FULL", full), ("HELD", 500), ("PART", 300)):
        monkeypatch.setattr(phrases, name, value)
    rng = random.Random(head)
    words = ["Aa", "b", "c", "é", "ÉÀ", "dd", "e-f", "G", "[x]", "日本"] + [f"w{i}" for i in range(40)]
    rows = [(rng.choice(["en", "de", None, "und"]), prose(rng, words[: rng.choice([3, 10, 50])], rng.randrange(200))) for _ in range(120)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(phrases.phrases(df)) == brute(rows)
    assert result(phrases.phrases(df, top=7)) == brute(rows, top=7)
    assert phrases.phrases(df, top=None).count() == len(brute(rows, top=10**9))


def test_nulls_empty_long_and_repeated_texts_and_clashing_columns(spark):
    rows = [(None, None), ("en", ""), ("en", None), ("en", " .,\n"), ("fr", "un deux trois. " * 60_000)]
    rows += [("en", "same words again")] * 30 + [("en", "no end of piece here " * 3000)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA + ", rank int, word int, x int")
    assert result(phrases.phrases(df)) == brute(rows)
    assert phrases.phrases(df.limit(0)).count() == 0


def test_counts_of_cells():
    rng = np.random.default_rng(1)
    x, y = rng.zipf(1.3, 200_000) % 5000, rng.zipf(1.3, 200_000) % 5000
    x[:500] |= phrases.TAIL
    got = dict(zip(zip(*(c.tolist() for c in phrases.count_cells(x, y)[:2])), phrases.count_cells(x, y)[2].tolist()))
    assert got == Counter(zip(x.tolist(), y.tolist()))


def test_large_products_are_exact(spark):
    big = 3 * 10**12
    known = spark.createDataFrame([(0, "a", big + 7, "en"), (1, "b", big + 9, "en")], "key long, word string, f long, lang string")
    twos = spark.createDataFrame([(0, 0, 1, big)], "key long, x long, y long, f long")
    long = spark.createDataFrame([], "x long, y long, a long")
    totals = spark.createDataFrame([("en", 10**15)], "lang string, n long")
    (row,) = phrases._scored(known, twos, long, totals, 50, 10).collect()
    assert row["score"] == 10**6 * big * big // ((big + 7) * (big + 9)) and row["n"] == 10**15
