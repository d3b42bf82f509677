"""Suffix-array dedup against a window-by-window brute force."""

import hashlib
import random

import numpy as np
import pytest

from tidewell.llm import suffixdedup as sd


def brute(rows, length):
    """rows of (key, bytes) in order: bytes kept and number of runs, by key."""
    seen, out = set(), {}
    for key, data in rows:
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if w in seen:
                gone[s : s + length] = True
            seen.add(w)
        edges = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone]) if len(data) else b""
        out[key] = (len(data), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def result(df):
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_whole_table_equals_brute_force(docs):
    rows = sorted((r["doc_id"], (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect())
    got = result(sd.deduplicate(docs.select("doc_id", "text"), keep_text=False))
    assert got == brute(rows, 100)
    assert any(n for _, n, _, _ in got.values())


def test_small_texts_ties_and_odd_bytes(spark):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdé ") for _ in range(260))
    other = "".join(rng.choice("xyzñ ") for _ in range(300))
    texts = [
        passage,
        "a" * 450,
        "ab" * 200 + "tail",
        other[:150] + passage + other[150:],
        passage[:140] + "!" + passage[140:],
        None,
        "",
        "short",
        other,
        passage,
        "é" * 120,
        "x" + "é" * 120,
    ]
    texts += [passage[i : i + 130] + str(i) for i in range(0, 130, 7)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = brute([(i, (t or "").encode()) for i, t in enumerate(texts)], 100)
    assert result(sd.deduplicate(df)) == want


def test_null_and_repeated_ids_extra_columns_and_empty(spark):
    long = "the quick brown fox jumps over the lazy dog and runs away into the dark green forest at night, " * 2
    rows = [(1, long, 5), (1, long, 5), (None, long, 6), (2, "z" + long, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int")
    got = {(r["doc_id"], r["n_removed"]) for r in sd.deduplicate(df, keep_text=False).collect()}
    size = len(long)
    first = brute([(None, long.encode()), (1, long.encode()), (2, b"z" + long.encode())], 100)
    assert got == {(k, v[1]) for k, v in first.items()}
    assert first[1][1] == size
    assert sd.deduplicate(df.limit(0)).count() == 0
    assert "d" not in sd.deduplicate(df).columns


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_batches_and_an_index_that_goes_on_give_the_same(spark, docs, tmp_path, batches):
    base = docs.where("doc_id < 120").selectExpr("doc_id as d", "coalesce(text, '') as text")
    whole = sd.repeated_strings(base, batches=batches)
    covered = lambda df: {
        (r["d"], p) for r in df.collect() for p in range(r["a"], r["b"])
    }
    folder = f"file://{tmp_path}/index"
    old, new = base.where("d < 70"), base.where("d >= 70")
    first = sd.repeated_strings(old, batches=batches, index=folder)
    second = sd.repeated_strings(new, batches=batches, index=folder, indexed=old)
    assert covered(first) | covered(second) == covered(whole)
    assert covered(whole)


def test_an_index_goes_on_with_batches_of_other_sizes(spark, docs, tmp_path, monkeypatch):
    """The first run has many buckets, the later ones would have fewer by their own size."""
    base = docs.where("doc_id < 120").select("doc_id", "text")
    want = result(sd.deduplicate(base, keep_text=False))
    monkeypatch.setattr(sd, "BUCKET_BYTES", 4096)
    folder, got, start = f"file://{tmp_path}/index", {}, 0
    for end in (90, 100, 120):
        new, old = base.where(f"doc_id >= {start} and doc_id < {end}"), base.where(f"doc_id < {start}")
        got |= result(sd.deduplicate(new, keep_text=False, index=folder, indexed=old))
        start = end
    assert got == want and any(got[i][1] for i in range(90, 120) if i in got)
    # The last run once more from where it began, and not from its own entries.
    again = sd.deduplicate(
        base.where("doc_id >= 100"), keep_text=False, index=folder, indexed=base.where("doc_id < 100"), version=2
    )
    assert result(again) == {i: x for i, x in want.items() if i >= 100}
    with pytest.raises(ValueError):
        sd.deduplicate(base, index=folder, indexed=base)


def test_a_repeated_task_does_not_meet_its_own_entries(spark, docs, tmp_path, monkeypatch):
    base = docs.where("doc_id < 60").selectExpr("doc_id as d", "coalesce(text, '') as text")
    want = sorted(map(tuple, sd.repeated_strings(base).collect()))
    monkeypatch.setattr(sd, "stored", lambda df, name, to=sd.stored: (df.collect(), to(df, name))[1])
    got = sd.repeated_strings(base, index=f"file://{tmp_path}/index")  # each task runs twice
    assert sorted(map(tuple, got.collect())) == want
