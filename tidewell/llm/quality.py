"""Quality by the votes of labelled neighbours in a latent-semantic space.

Terms come in two fields, counted alike: WORDS (words and runs of signs, lower-cased) and LAYOUT
(the shape of each word as written, how often each distinct word occurs, and words
that follow their like). Every term counts: each is hashed to one of a fixed number of columns,
none is selected. Each field is a vector of unit length: WORDS by TF-IDF with the inverse
document frequencies of the whole table, LAYOUT, whose terms most documents share, by TF.

Fitting: a bounded sample of labelled rows (MAX_EXAMPLES of each label) gives the matrix
whose leading singular vectors are the latent space. The examples' vectors (a few thousand
rows of DIMENSIONS numbers) travel to all tasks: their size is bounded by the parameters.

Scoring is a map over all rows: the documents of a slice are projected and multiplied with
all examples in blocks, the NEIGHBOURS nearest vote with their similarity, and a rising
step function fitted on the examples turns votes into probabilities. Cosines are exact.

Defined cases: a null or empty text has no direction and gets the share of label 1 among labelled examples without direction, smoothed towards 0.5. Ties
between neighbours go to the earlier example (smaller id). Repeated rows get equal results.
Without labelled rows of both labels every score is the share of the label that is there
(0.0 without any). Very long texts are read whole, an empty table gives an empty result.
Input columns named like an output are replaced; the text is not returned.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

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
#: Columns of the two fields; terms that share one count together.
WORDS, LAYOUT = 1 << 14, 1 << 12
DIMENSIONS, NEIGHBOURS = 64, 25
BLOCK = 256
#: Signs that may end a word; they stay as they are.
ENDS = ".,;:!?"


def kind(c: str) -> str:
    return "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c


def shape(core: str) -> str:
    """How a word is written, run by run: Aa, A, a, 0, and signs as they are."""
    if core.isalpha() and (core.islower() or core.isupper()):
        return kind(core)
    if core.isalpha() and core[1:].islower():
        return "Aa"
    return "".join(k for k, _ in groupby(map(kind, core)))


def column(term: str, columns: int) -> int:
    return zlib.crc32(term.encode("utf-8", "surrogatepass")) % columns


class Reader:
    """Gives the counts of the columns of both fields, and remembers the words of its task."""

    LIMIT = 1 << 17  # then it forgets them all: a matter of memory, not of results

    def __init__(self):
        self.known: dict[str, tuple[list[int], int]] = {}
        self.times = np.array([WORDS + column(f"times {k}", LAYOUT) for k in range(64)])
        self.again = np.array([WORDS + column("again", LAYOUT)])
        self.total = np.zeros(WORDS + LAYOUT)

    def word(self, word: str) -> tuple[list[int], int]:
        """Columns of the tokens of a new word, and of its shape."""
        core = word.rstrip(ENDS)
        end = word[len(core) :]
        tokens = [core.lower(), *tokens_of(end)] if core.isalpha() else tokens_of(word)
        found = [column(t, WORDS) for t in tokens], WORDS + column(shape(core) + end, LAYOUT)
        if len(self.known) >= self.LIMIT:
            self.known.clear()
        self.known[word] = found
        return found

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Columns that occur, in order (those of WORDS first), and their counts."""
        written = (text or "").split()
        counted = Counter(written)
        known, word = self.known.get, self.word
        found = [known(w) or word(w) for w in counted]
        n = np.fromiter(counted.values(), np.int64, len(found))
        tokens = np.array([c for f in found for c in f[0]], np.int64)
        layout = np.array([f[1] for f in found], np.int64)
        # The exponent of a whole number is its number of bits.
        times = self.times[np.frexp(n)[1]]
        again = sum(map(str.__eq__, written, written[1:]))
        np.add.at(self.total, tokens, np.repeat(n, [len(f[0]) for f in found]))
        np.add.at(self.total, layout, n)
        np.add.at(self.total, times, 1)
        self.total[self.again] += again
        at = np.flatnonzero(self.total)
        counts = self.total[at]
        self.total[at] = 0
        return at, counts


def word_columns(text: str | None) -> list[int]:
    """Distinct columns of WORDS in a text."""
    return list({column(t, WORDS) for t in set(tokens_of(text or ""))})


@dataclass
class Model:
    idf: np.ndarray
    space: np.ndarray  # columns x DIMENSIONS
    vectors: np.ndarray  # examples x DIMENSIONS, unit length
    y: np.ndarray
    weights: np.ndarray
    none: float
    points: tuple[np.ndarray, np.ndarray]

    def sparse(self, text: str | None, read: Reader) -> tuple[np.ndarray, np.ndarray]:
        """Columns and weights of a text; each field has unit length."""
        t, n = read.features(text)
        w = (1 + np.log(n)) * self.idf[t]
        for field in np.split(w, [np.searchsorted(t, WORDS)]):
            field /= np.sqrt(field @ field) or 1.0
        return t, w.astype(np.float32)

    def project(self, texts: list, read: Reader | None = None) -> np.ndarray:
        """Unit vectors; zero where a text has no direction."""
        read = read or Reader()
        out = np.zeros((len(texts), self.space.shape[1]), np.float32)
        for r, text in enumerate(texts):
            t, w = self.sparse(text, read)
            if len(t):
                out[r] = w @ self.space[t]
        size = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return np.divide(out, size, out=np.zeros_like(out), where=size > 1e-6)

    def votes(self, vectors: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Share of label 1 among the nearest, weighted by similarity. `own`: rows to leave out."""
        out = np.empty(len(vectors))
        for lo in range(0, len(vectors), BLOCK):
            cosines = vectors[lo : lo + BLOCK] @ self.vectors.T
            if own is not None:
                cosines[np.arange(len(cosines)), own[lo : lo + BLOCK]] = -1
            k = min(NEIGHBOURS, cosines.shape[1])
            least = -np.partition(-cosines, k - 1, axis=1)[:, k - 1 : k]
            # All above the k-th, and of those equal to it the first ones.
            above = cosines > least
            level = cosines == least
            room = k - above.sum(axis=1, keepdims=True)
            near = above | (level & (np.cumsum(level, axis=1) <= room))
            w = np.where(near, np.maximum(cosines, 1e-6).astype(float) ** 4, 0) * self.weights
            out[lo : lo + BLOCK] = (w @ self.y) / w.sum(axis=1)
        return out

    def scores(self, texts: list, read: Reader | None = None) -> np.ndarray:
        if not len(self.y):
            return np.full(len(texts), self.none)
        vectors = self.project(texts, read)
        some = np.abs(vectors).sum(axis=1) > 0
        out = np.full(len(texts), self.none)
        if some.any():
            out[some] = np.interp(self.votes(vectors[some]), *self.points)
        return out


def leading_space(rows: list[tuple[np.ndarray, np.ndarray]], n_terms: int, size: int) -> np.ndarray:
    """Right singular vectors of the sparse rows, by subspace iteration from a fixed start.

    A block of rows is dense at a time.
    """
    size = min(size, n_terms, len(rows))

    def blocks():
        for lo in range(0, len(rows), BLOCK):
            dense = np.zeros((min(BLOCK, len(rows) - lo), n_terms), np.float32)
            for r, (t, w) in enumerate(rows[lo : lo + BLOCK]):
                dense[r, t] = w
            yield dense

    base = np.random.default_rng(7).standard_normal((n_terms, size + 16)).astype(np.float32)
    for _ in range(4):
        base = np.linalg.qr(sum(dense.T @ (dense @ base) for dense in blocks()))[0]
    _, _, right = np.linalg.svd(np.concatenate([dense @ base for dense in blocks()]), full_matrices=False)
    return np.ascontiguousarray((base @ right.T)[:, :size])


def fitted(texts: list[str], y: np.ndarray, stands: np.ndarray, df: np.ndarray, n: int) -> Model:
    """The model of labelled texts, given the document frequencies of WORDS in n documents."""
    none = np.zeros((0, 1))
    idf = np.concatenate([np.log((n + 1) / (df + 1)) + 1, np.ones(LAYOUT)])
    model = Model(idf, none, none, y, stands, 0.5, ())
    read = Reader()
    model.space = leading_space([model.sparse(t, read) for t in texts], WORDS + LAYOUT, DIMENSIONS)
    vectors = model.project(texts, read)
    some = np.abs(vectors).sum(axis=1) > 0
    away = stands[~some]
    model.none = float(((away * y[~some]).sum() + 0.5) / (away.sum() + 1))
    model.vectors, model.y, model.weights = vectors[some], y[some], stands[some]
    if len(model.y):
        loo = model.votes(model.vectors, np.arange(len(model.y)))
        model.points = monotone(loo, model.y, model.weights)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = MAX_EXAMPLES) -> Model:
    known = examples(docs, labels, label, limit)
    y = known["y"].to_numpy(float) if len(known) else np.zeros(0)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        none = np.zeros((0, 1), np.float32)
        return Model(np.zeros(0), none, none, np.zeros(0), np.zeros(0), share, (np.zeros(1), np.zeros(1)))
    df, n = document_counts(docs, WORDS, word_columns)
    return fitted(known["text"].tolist(), y, label_weights(labels, label, y), df, n)


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The columns of `docs` but the text, with score and predicted."""
    rows = docs.select(*[c for c in docs.columns if c not in ("score", "predicted")])

    def run(batches):
        read = Reader()
        for batch, texts in text_batches(batches, "text"):
            p = model.scores(texts.to_pylist(), read)
            yield with_columns(batch, score=pa.array(p), predicted=pa.array((p >= threshold).astype(np.int32)))

    return rows.mapInArrow(run, scored_schema(rows, "score double", "predicted int"))


def quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Fit on `labels` and score every row of `docs` (id_column, text)."""
    return score_documents(docs, fit(docs, labels)).withColumn("held_out", held_out(id_column))
