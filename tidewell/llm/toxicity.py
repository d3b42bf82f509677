"""Toxicity from the nearest labelled examples, by exact TF-IDF cosine.

Fitting: a bounded sample of labelled rows (MAX_EXAMPLES of each label) gives the terms that
toxic examples have more often than others (chi-square); the number of documents with each
of these terms is counted over the whole table and gives the inverse frequencies. The
examples' vectors make an inverted index in blocks of BLOCK similar examples; for each
term and block it keeps the largest weight.

Scoring: for a document the sums of these maxima bound each block. Blocks are opened by
falling bound until no bound reaches the k-th best cosine, so the neighbours are exact.
Neighbours vote with weights that fall with their distance, and a rising step function,
fitted on the examples against each other, turns votes into probabilities.

The model is a few MB whatever the input, and scoring is a map over all rows: nothing is
shuffled, and a lost task repeats its own rows only.

Defined cases: a null or empty text, or one without any of the terms, has no direction; its
score is the share of toxic among the examples that have none either. Ties between
neighbours go to the smaller example id. Repeated rows get equal results. Without labelled
rows of both labels every score is the share of the label that is there (0.0 without any).
Input columns named like an output are replaced; the text is not returned.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_batches
from .labelled import (
    document_counts,
    examples,
    held_out,
    label_weights,
    monotone,
    scored_schema,
    tokens_of,
    with_columns,
)

#: At most so many labelled rows of each label are fitted on.
MAX_EXAMPLES = 2048
#: At most so many terms; a term is a word or the first four letters of a longer word.
MAX_TERMS = 4096
#: The chi-square is that of one in a million: a vocabulary holds many rare words by chance.
MIN_CHI2, MIN_RATIO, MIN_EXAMPLES = 24.0, 3.0, 5
NEIGHBOURS, BLOCK = 15, 64
STEM = 4


def named_terms(text: str) -> Counter:
    """Counts of the words and of the stems (marked by ~) of a text."""
    words = Counter(tokens_of(text))
    stems: Counter = Counter()
    for w, n in words.items():
        if len(w) > STEM:
            stems["~" + w[:STEM]] += n
    return words + stems


@dataclass
class Terms:
    """Selected terms; gives counts of theirs in a text."""

    words: dict[str, int] = field(default_factory=dict)
    stems: dict[str, int] = field(default_factory=dict)

    @staticmethod
    def of(names: list[str]) -> Terms:
        out = Terms()
        for i, t in enumerate(names):
            if t[0] == "~" and len(t) == STEM + 1:
                out.stems[t[1:]] = i
            else:
                out.words[t] = i
        return out

    def __len__(self) -> int:
        return len(self.words) + len(self.stems)

    def counts(self, text: str | None) -> dict[int, int]:
        found: dict[int, int] = {}
        word, stem = self.words.get, self.stems.get
        for w, n in Counter(tokens_of(text or "")).items():
            i = word(w)
            if i is not None:
                found[i] = found.get(i, 0) + n
            if len(w) > STEM:
                i = stem(w[:STEM])
                if i is not None:
                    found[i] = found.get(i, 0) + n
        return found


def select_terms(texts: list[str], y: np.ndarray, limit: int = MAX_TERMS) -> list[str]:
    """Terms bound to label 1, by chi-square of presence."""
    with_term: dict[str, list[int]] = {}
    for text, label in zip(texts, y, strict=True):
        for t in named_terms(text):
            with_term.setdefault(t, [0, 0])[int(label)] += 1
    n1 = max(1, int(y.sum()))
    n0 = max(1, len(y) - n1)
    kept = []
    for t, (b, a) in with_term.items():
        if a < MIN_EXAMPLES or a / n1 < MIN_RATIO * (b + 0.5) / n0:
            continue
        n, c, d = n0 + n1, n1 - a, n0 - b
        chi2 = n * (a * d - b * c) ** 2 / max(1, (a + b) * (c + d) * n1 * n0)
        if chi2 >= MIN_CHI2:
            kept.append((-chi2, t))
    return [t for _, t in sorted(kept)[:limit]]


class BlockMaxIndex:
    """Unit vectors in blocks of similar ones, with the largest weight of each term and block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], ids: np.ndarray, n_terms: int, block: int = BLOCK):
        lead = np.array([t[np.argmax(w)] if len(t) else -1 for t, w in vectors], np.int64)
        order = np.lexsort((ids, lead))
        self.ids = ids[order]
        self.blocks = [order[i : i + block] for i in range(0, len(order), block)]
        self.bounds = np.zeros((n_terms, len(self.blocks)), np.float32)
        self.local = np.full((len(self.blocks), n_terms), -1, np.int32)
        self.weights: list[np.ndarray] = []
        for b, members in enumerate(self.blocks):
            terms = np.unique(np.concatenate([vectors[m][0] for m in members] or [np.zeros(0, np.int64)]))
            self.local[b, terms] = np.arange(len(terms))
            dense = np.zeros((len(members), len(terms)))
            for r, m in enumerate(members):
                dense[r, self.local[b, vectors[m][0]]] = vectors[m][1]
            self.weights.append(dense)
            if len(terms):
                # One rounding unit above the maximum: a bound in single precision stays a bound.
                self.bounds[terms, b] = np.nextafter(dense.max(axis=0).astype(np.float32), np.float32(2))
        self.starts = np.cumsum([0] + [len(m) for m in self.blocks])

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (in self.ids) and cosines of the k nearest, smaller ids first on ties."""
        bounds = weights @ self.bounds[terms]
        at, cosines, least = [], [], -1.0
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or bounds[b] < least - 1e-6:
                break
            column = self.local[b, terms]
            there = column >= 0
            got = self.weights[b][:, column[there]] @ weights[there]
            at.append(np.arange(self.starts[b], self.starts[b + 1]))
            cosines.append(got)
            if sum(map(len, cosines)) >= k:
                both = np.concatenate(cosines)
                least = np.partition(both, len(both) - k)[len(both) - k]
        if not at:
            return np.zeros(0, np.int64), np.zeros(0)
        places, both = np.concatenate(at), np.concatenate(cosines).round(9)
        best = np.lexsort((self.ids[places], -both))[:k]
        best = best[both[best] > 0]
        return places[best], both[best]


@dataclass
class Model:
    terms: Terms
    names: list[str]
    idf: np.ndarray
    index: BlockMaxIndex | None
    y: np.ndarray  # in the order of index.ids
    weights: np.ndarray
    none: float  # score of a text without direction
    points: tuple[np.ndarray, np.ndarray]

    def vector(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        counts = self.terms.counts(text)
        t = np.fromiter(counts.keys(), np.int64, len(counts))
        w = (1 + np.log(np.fromiter(counts.values(), float, len(counts)))) * self.idf[t]
        return t, w / (np.sqrt((w * w).sum()) or 1.0)

    def votes(self, places: np.ndarray, cosines: np.ndarray) -> float:
        near = self.weights[places] / (1.05 - cosines)
        return float((near * self.y[places]).sum() / near.sum())

    def score(self, text: str | None, skip: int | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        """Probability, ids of the neighbours, terms found. `skip`: an example left out."""
        t, w = self.vector(text)
        if not len(t) or self.index is None:
            return self.none, np.zeros(0, np.int64), t
        places, cosines = self.index.nearest(t, w, NEIGHBOURS + (skip is not None))
        if skip is not None:
            others = self.index.ids[places] != skip
            places, cosines = places[others], cosines[others]
        if not len(places):
            return self.none, np.zeros(0, np.int64), t
        p = self.votes(places, cosines)
        return p if skip is not None else float(np.interp(p, *self.points)), self.index.ids[places], t


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = MAX_EXAMPLES) -> Model:
    known = examples(docs, labels, label, limit)
    y = known["y"].to_numpy(float) if len(known) else np.zeros(0)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        empty = np.zeros(0)
        return Model(Terms(), [], empty, None, empty, empty, share, (np.array([0.0]), np.array([share])))
    texts = known["text"].tolist()
    names = select_terms(texts, y)
    terms = Terms.of(names)
    df, n = document_counts(docs, len(names), terms.counts)
    idf = np.log((n + 1) / (df + 1)) + 1
    stands = label_weights(labels, label, y)
    model = Model(terms, names, idf, None, y, stands, 0.0, (np.array([0.0]), np.array([0.0])))
    vectors = [model.vector(t) for t in texts]
    has = np.array([len(t) > 0 for t, _ in vectors])
    away = ~has
    model.none = float((stands[away] * y[away]).sum() + 0.5) / float(stands[away].sum() + 1)
    if has.any():
        kept = np.flatnonzero(has)
        index = BlockMaxIndex([vectors[i] for i in kept], kept, len(names))
        model.index, model.y, model.weights = index, y[index.ids], stands[index.ids]
        loo = np.array([model.score(texts[i], skip=int(i))[0] for i in kept])
        model.points = monotone(loo, y[kept], stands[kept])
        index.ids = known["id"].to_numpy(np.int64)[index.ids]
    return model


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The columns of `docs` but the text, with score, predicted, neighbours, terms."""
    outputs = ("score", "predicted", "neighbours", "terms")
    rows = docs.select(*[c for c in docs.columns if c not in outputs])

    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            got = [model.score(x) for x in texts.to_pylist()]
            yield with_columns(
                batch,
                score=pa.array([g[0] for g in got], pa.float64()),
                predicted=pa.array([int(g[0] >= threshold) for g in got], pa.int32()),
                neighbours=pa.array([g[1].tolist() for g in got], pa.list_(pa.int64())),
                terms=pa.array([sorted(model.names[i] for i in g[2]) for g in got], pa.list_(pa.string())),
            )

    more = ("score double", "predicted int", "neighbours array<long>", "terms array<string>")
    return rows.mapInArrow(run, scored_schema(rows, *more))


def toxicity(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Fit on `labels` and score every row of `docs` (id_column, text)."""
    scored = score_documents(docs, fit(docs, labels))
    return scored.withColumn("held_out", held_out(id_column))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that do not score as toxic, with all their columns; one map, no shuffle."""
    model = fit(docs, labels)

    def run(batches):
        for batch, texts in text_batches(batches, "text"):
            yield batch.filter(pa.array([model.score(x)[0] < threshold for x in texts.to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
