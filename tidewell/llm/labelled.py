"""What both neighbour classifiers share: labelled examples, features, document frequencies."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_batches

#: Words, and runs of other visible characters (at most six of a run count).
TOKEN = re.compile(r"[^\W_]+|[^\w\s]{1,6}|_+")


def tokens_of(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def held_out(id_column: str) -> Column:
    """True for the fifth of the rows that no label is learned from."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 5 == 0, F.lit(False))


def examples(docs: DataFrame, labels: DataFrame, label: str, limit: int, id_column: str = "doc_id") -> pd.DataFrame:
    """At most `limit` labelled rows of each label, outside the held-out fifth: id, text, y.

    The rows with the smallest hashes of their id are taken, so the choice is repeatable and
    bounded whatever the size of the tables. Rows without text or with a label other than
    0 and 1 teach nothing. Only ids travel to the limit; the texts are fetched afterwards.
    Of a repeated id the text that sorts first is read, of an id with both labels both rows.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
        .select(F.col(id_column).alias("_id"), F.col(label).alias("_y"), F.xxhash64(id_column).alias("_h"))
        .distinct()
    )
    there = known.join(docs.select(F.col(id_column).alias("_id")).distinct(), "_id", "left_semi")
    chosen = None
    for y in (0, 1):
        part = there.where(F.col("_y") == y).orderBy("_h", "_id").limit(limit)
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = chosen.collect()  # bounded by 2 x limit
    if not rows:
        return pd.DataFrame({"id": [], "text": [], "y": []})
    picked = docs.sparkSession.createDataFrame([(r["_id"], r["_y"]) for r in rows], "_id long, _y int")
    texts = (
        docs.select(F.col(id_column).alias("_id"), F.col("text").alias("_text"))
        .where(F.col("_text").isNotNull())
        .join(F.broadcast(picked), "_id")
        .groupBy("_id", "_y")
        .agg(F.min("_text").alias("_text"))
    )
    found = texts.toPandas().sort_values(["_id", "_y"])
    return pd.DataFrame(
        {"id": found["_id"].tolist(), "text": found["_text"].tolist(), "y": found["_y"].astype(int).tolist()}
    )


def document_counts(docs: DataFrame, n_terms: int, ids_of: Callable[[str], Iterable[int]]) -> tuple[np.ndarray, int]:
    """In how many of all documents each of `n_terms` (bounded) terms occurs, and their number.

    `ids_of` gives the distinct terms of a text. Each task sends one row per term it has
    seen, so a term of every document is no hot key.
    """

    def count(batches):
        seen = np.zeros(n_terms + 1, np.int64)
        for _, texts in text_batches(batches, "text"):
            for text in texts.to_pylist():
                seen[n_terms] += 1
                ids = list(ids_of(text))
                if ids:
                    seen[ids] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["i", "n"])

    total = np.zeros(n_terms + 1)
    found = docs.select("text").mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    total[found["i"].to_numpy(np.int64)] = found["n"].to_numpy()
    return total[:-1], int(total[-1])


def label_weights(labels: DataFrame, label: str, y: np.ndarray, id_column: str = "doc_id") -> np.ndarray:
    """For each example, how many labelled rows of its label it stands for."""
    counts = (
        labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(label).cast("int").alias("y"))
        .count()
        .collect()
    )
    whole = {r["y"]: r["count"] for r in counts}
    return np.array([max(1.0, whole.get(int(v), 0) / max(1, int((y == v).sum()))) for v in y], float)


def monotone(scores: np.ndarray, y: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares rising step function of y over scores, as points for interpolation."""
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []  # sum of y, weight, sum of scores
    for s, v, w in zip(scores[order], y[order], weights[order], strict=True):
        blocks.append([float(v * w), float(w), float(s * w)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            b = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], b, strict=True)]
    x = np.array([b[2] / b[1] for b in blocks])
    p = np.array([(b[0] + 0.5) / (b[1] + 1.0) for b in blocks])
    return x, np.maximum.accumulate(p)


def scored_schema(docs: DataFrame, *more: str) -> str:
    return ", ".join([f"`{c}` {t}" for c, t in docs.dtypes if c != "text"] + list(more))


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The slice without its text, and more columns."""
    names = [n for n in batch.schema.names if n != "text"]
    return pa.RecordBatch.from_arrays(
        [batch.column(batch.schema.get_field_index(n)) for n in names] + list(columns.values()), names + list(columns)
    )
