"""Neighbours against brute-force cosines, held-out accuracy, and odd inputs."""

import zlib

import numpy as np
import pytest

from tidewell.llm import labelled, quality, toxicity

BAD = ["grumble", "snarl", "hiss"]


@pytest.fixture(scope="module")
def world(spark):
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for i in range(600):
        w = [f"w{rng.integers(300)}" for _ in range(rng.integers(5, 60))]
        toxic = bool(rng.random() < 0.3)
        junk = bool(rng.random() < 0.3)
        if toxic:
            w[:: max(2, len(w) // 4)] = rng.choice(BAD, len(w[:: max(2, len(w) // 4)]))
        if junk:
            w = [x for x in w for _ in range(4)]
        texts.append(" ".join(w))
        labels.append((i, int(not junk), int(toxic)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), labels


def accuracy(df, truth):
    held = [r for r in df.collect() if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in held)
    assert all(0 <= r["score"] <= 1 for r in held)
    return np.mean([r["predicted"] == truth[r["doc_id"]] for r in held])


def test_held_out_accuracy(world):
    docs, labels, rows = world
    assert accuracy(toxicity.toxicity(docs, labels), {i: t for i, _, t in rows}) > 0.95
    assert accuracy(quality.quality(docs, labels), {i: q for i, q, _ in rows}) > 0.95


def test_block_max_neighbours_are_exact():
    rng = np.random.default_rng(3)
    vectors = []
    for _ in range(300):
        t = np.sort(rng.choice(50, rng.integers(1, 9), replace=False))
        w = rng.random(len(t)) + 0.1
        vectors.append((t, w / np.sqrt((w * w).sum())))
    vectors += vectors[:20]  # ties
    ids = rng.permutation(len(vectors))
    index = toxicity.BlockMaxIndex(vectors, ids, 50, block=16)
    dense = np.zeros((len(vectors), 50))
    for r, (t, w) in enumerate(vectors):
        dense[r, t] = w
    for t, w in vectors[:60]:
        cosines = (dense[:, t] @ w).round(9)
        want = [ids[i] for i in np.lexsort((ids, -cosines)) if cosines[i] > 0][:10]
        places, got = index.nearest(t, w, 10)
        assert index.ids[places].tolist() == want
        assert np.allclose(got, np.sort(cosines)[::-1][: len(got)])


def test_votes_equal_brute_force(world):
    docs, labels, _ = world
    model = quality.fit(docs, labels)
    vectors = model.project([r["text"] for r in docs.limit(40).collect()])
    for v, p in zip(vectors, model.votes(vectors), strict=True):
        cosines = model.vectors @ v
        near = np.argsort(-cosines, kind="stable")[: quality.NEIGHBOURS]
        w = np.maximum(cosines[near], 1e-6).astype(float) ** 4 * model.weights[near]
        assert abs(p - (w @ model.y[near]) / w.sum()) < 1e-4


def test_monotone_calibration():
    x, p = labelled.monotone(np.array([0.1, 0.2, 0.3, 0.4]), np.array([0, 1, 0, 1.0]), np.ones(4))
    assert (np.diff(p) >= 0).all() and len(x) == 3


@pytest.mark.parametrize("method", [toxicity.toxicity, quality.quality])
def test_odd_inputs(spark, world, method):
    _, labels, _ = world
    rows = [(None, "w1 grumble", 1.0, 2), (7, None, 0.0, 3), (7, None, 0.0, 3), (8, "", None, 4), (9, "w2 " * 30_000, 0.5, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double, near int")
    got = method(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r["score"] <= 1 for r in got)
    assert sorted(r["near"] for r in got) == [2, 3, 3, 4, 5]
    none = method(docs, labels.limit(0)).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.0, 0)}
    assert method(docs.limit(0), labels).count() == 0


def test_labels_of_the_held_out_fifth_are_not_learned(spark, world):
    docs, labels, rows = world
    flipped = spark.createDataFrame(
        [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in rows],
        "doc_id long, quality int, toxic int",
    )
    scores = lambda x: {r["doc_id"]: r["score"] for r in toxicity.toxicity(docs, x).collect()}
    assert scores(labels) == scores(flipped)
