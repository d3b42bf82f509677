"""Phrase and proximity matches against brute force."""

import hashlib
import random
import re

from tidewell.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def windows(items):
    for i, text in items:
        w = words(text)
        for s in range(max(1, len(w) - 9) if w else 0):
            yield str(i) if i is not None else "null", tuple(w[s : s + 10])


def brute(docs, items, slop=0):
    wins = list(windows(items))
    out = {}
    for i, text in docs:
        w = words(text)
        hit, named = set(), set()
        for item, win in wins:
            for s in range(-slop if slop else 0, len(w)):
                spots = (range(s + k - slop, s + k + slop + 1) for k in range(len(win)))
                if all(any(0 <= p < len(w) and w[p] == t for p in r) for r, t in zip(spots, win, strict=True)):
                    hit.update(range(s - slop, s + len(win) + slop))
                    named.add(item)
        out[i] = (len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit))
    return out


def result(df):
    names = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return {r["doc_id"]: tuple(r[c] for c in names) for r in df.collect()}


def corpus(rng):
    make = lambda n: [rng.choice(["Ab", "ab", "cé", "CÉ", "d1", "e", "f"]) for _ in range(n)]
    items = [" ".join(make(n)) for n in (10, 14, 25, 3, 1, 9, 12)] + [None, "", "...", "zz only here"]
    docs = [" ".join(make(rng.randrange(40))) for _ in range(30)]
    for k in range(20):
        part = rng.choice(items[:3]).split()
        at = rng.randrange(len(part) - 9)
        docs.append(" ".join([*make(5), *part[at : at + rng.randrange(9, 13)], *make(3)]).upper() + "!" * k)
    return list(enumerate([*docs, None, "", "?!", "the zz, ONLY here."])), list(enumerate(items))


def test_windows_short_items_and_edges(spark):
    docs, items = corpus(random.Random(4))
    got = decontaminate.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    want = brute(docs, items)
    assert result(got) == want
    assert any(v[4] for v in want.values()) and not all(v[4] for v in want.values())


def test_proximity_finds_words_that_moved(spark):
    base = [f"w{i}" for i in range(12)]
    near = base[:4] + ["extra"] + base[4:]
    docs = spark.createDataFrame(
        [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(reversed(base)))], "doc_id long, text string"
    )
    items = spark.createDataFrame([(7, " ".join(base[:10]))], "item_id long, text string")
    flags = lambda slop: {
        r["doc_id"]: r["contaminated"] for r in decontaminate.decontaminate(docs, items, slop=slop).collect()
    }
    assert flags(0) == {1: True, 2: False, 3: False}
    assert flags(1) == {1: True, 2: True, 3: False}


def test_repeated_and_null_ids_clashing_columns_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(15))
    rows = [(1, text, 9, "x"), (1, text, 9, "x"), (None, text, 9, "y"), (1, "other", 9, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_hit int, term string")
    items = spark.createDataFrame([(None, text), (3, text), (3, text)], "item_id long, text string")
    got = decontaminate.decontaminate(docs, items)
    assert sorted((str(r["doc_id"]), r["term"], r["n_hit"], r["n_items"]) for r in got.collect()) == [
        ("1", "x", 15, 2), ("1", "x", 15, 2), ("1", "z", 0, 0), ("None", "y", 15, 2)
    ]
    assert decontaminate.decontaminate(docs.limit(0), items).count() == 0
    assert {r["n_hit"] for r in decontaminate.decontaminate(docs, items.limit(0)).collect()} == {0}
