"""The Jaccard join against all pairs, and its parts."""

import random
import re

import numpy as np

from tidewell.llm import jaccard
from tidewell.llm.components import connected
from tidewell.llm.rows import bit_map, only, without


def brute(rows, percent=75):
    def lower(text):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)

    sets = {}
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets[i] = {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    p, q = root(a), root(b)
                    label[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), root(i)) for i in ids}


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_whole_table_equals_all_pairs(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    assert result(jaccard.near_duplicates(docs.select("doc_id", "text"))) == want
    assert any(i != c for i, (_, c) in want.items())


def family(rng, size, edits, vocabulary=400, length=60):
    """Chains of near copies: each is edited from one before, so links are transitive."""
    made = [[f"w{rng.randrange(vocabulary)}" for _ in range(length)]]
    while len(made) < size:
        words = list(rng.choice(made))
        for _ in range(rng.randrange(edits + 1)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(vocabulary)}"
        made.append(words)
    return [" ".join(w) for w in made]


def test_large_families_in_small_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "GROUP", 7)
    monkeypatch.setattr(jaccard, "QUERIES", 5)
    rng = random.Random(11)
    texts = family(rng, 90, 3) + family(rng, 40, 5) + [f"lone {i} " * 9 for i in range(5)]
    texts += ["Lone 1 " * 9, None, "", " \t\n", "one two", "ONE two", "one two three", "É a b", "é a b"]
    rng.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    assert result(jaccard.near_duplicates(df)) == brute(list(enumerate(texts)))


def test_exact_threshold(spark):
    # 7 shared shingles; unions of 9 and 10 of them: 77.8 % links, 70 % does not.
    base = " ".join(f"a{i}" for i in range(11))
    rows = [(5, base + " x y"), (3, base), (8, base + " p q r"), (9, base.upper() + " X Y")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(jaccard.near_duplicates(df)) == brute(rows)


def test_null_and_repeated_ids_clashing_columns_and_empty(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(1, text, 0, "x"), (1, text, 0, "x"), (None, text + " end", 1, "y"), (4, None, 2, None), (4, "other", 3, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int, d string")
    got = sorted(map(tuple, jaccard.near_duplicates(df).select("doc_id", "d", "n_shingles", "component_id").collect()), key=str)
    assert got == sorted(
        [(1, "x", 26, None), (1, "x", 26, None), (None, "y", 27, None), (4, None, 0, 4), (4, "z", 1, 4)], key=str
    )
    assert jaccard.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    got = {r["d"]: r["component"] for r in connected(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_shingles_of_a_buffer():
    texts = ["a b c d e f", "", "A  B\tc", "a b c"]
    data = "".join(texts).encode()
    ends = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    doc, value = jaccard.shingle_sets(np.frombuffer(data, np.uint8), ends)
    assert doc.tolist() == [0, 0, 2, 3]
    assert value[2] == value[3]


def template_pages(rng, count, own):
    """Documents of 100 words of one template and `own` words of their own, some of them shared with one other."""
    template = [f"t{i}" for i in range(100)]
    docs = []
    for i in range(count):
        words = [f"p{i // 2}x{j}" for j in range(own // 2)] + [f"o{i}x{j}" for j in range(own - own // 2)]
        docs.append((i, " ".join(template + words)))
    rng.shuffle(docs)
    return docs


def test_pages_of_one_template_do_not_all_meet(spark, monkeypatch):
    rng, seen = random.Random(4), []

    def spy(df, name, stored=jaccard.stored):
        out = stored(df, name)
        if name == "pairs":
            seen.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", spy)
    for count in (100, 200):
        rows = template_pages(rng, count, 30) + [(1000 + i, t) for i, t in template_pages(rng, 20, 4)]
        found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()}
        assert got == brute(rows)
    # Two passes each: at most two groups for a document, where all pairs would be thousands.
    assert len(seen) == 4 and max(seen[:2]) <= 240 and max(seen[2:]) <= 440, seen


def test_rows_in_question_are_told_by_their_numbers_alone(spark):
    rows = [(i, "text " * 50) for i in range(200)]
    df = spark.createDataFrame(rows, "d long, text string")
    dropped = df.where("d % 3 = 0").select("d")
    kept = without(df, dropped)
    assert sorted(r["d"] for r in kept.collect()) == [i for i in range(200) if i % 3]
    assert kept.dtypes == df.dtypes and {r["text"] for r in kept.collect()} == {"text " * 50}
    marked = only(df, bit_map(dropped), True)
    assert {r["d"] for r in marked.collect()} >= {i for i in range(200) if i % 3 == 0}
    # No whole text goes through Python.
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "fits(d" in plan
