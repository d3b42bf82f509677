"""Rows in order, rows in question: what operators that look documents up share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import mix
from .common import stored

#: Bits of a map of rows in question: 4 MB, whatever the number of rows.
FILTER_BITS = 1 << 25


def numbered(docs: DataFrame, text: str, id_column: str) -> tuple[DataFrame, bool]:
    """`docs` with d, a number that rises with the order of documents and names one each.

    d is the id itself where ids are unique and not null (then True is returned); else
    documents are ordered by id (null first) and a hash of the text, and rows that are equal
    in both are one document.
    """
    ids = docs.groupBy(F.col(id_column).alias("_id")).count()
    plain = ids.where("count > 1 or _id is null").limit(1).count() == 0
    if plain:
        return docs.withColumn("d", F.col(id_column).cast("long")), True
    keys = docs.select(F.col(id_column).alias("_id"), F.xxhash64(text).alias("_h")).distinct()
    keys = stored(
        keys.orderBy(F.asc_nulls_first("_id"), "_h").withColumn("d", F.monotonically_increasing_id()), "documents"
    )
    marked = docs.withColumns({"_id": F.col(id_column), "_h": F.xxhash64(text)})
    met = marked.alias("m").join(
        keys.alias("k"), F.col("m._id").eqNullSafe(F.col("k._id")) & (F.col("m._h") == F.col("k._h"))
    )
    return met.select("m.*", "k.d").drop("_id", "_h"), False


def bit_map(rows: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit map of the numbers d of `rows`, of a fixed size whatever their number."""

    def mark(batches):
        words = np.zeros(bits // 64, np.int64)
        for batch in batches:
            h = mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)) % np.uint64(bits)
            np.bitwise_or.at(words, (h >> np.uint64(6)).astype(np.int64), np.int64(1) << (h & np.uint64(63)).astype(np.int64))
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], ["at", "bits"])

    found = (
        rows.select("d").mapInArrow(mark, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toPandas()
    )
    words = np.zeros(bits // 64, np.int64)
    words[found["at"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    return words


def marked_in(words: np.ndarray, d: np.ndarray) -> np.ndarray:
    h = mix(d.astype(np.uint64)) % np.uint64(len(words) * 64)
    return (words[(h >> np.uint64(6)).astype(np.int64)] >> (h & np.uint64(63)).astype(np.int64)) & 1 > 0


def marked(batches, words: np.ndarray, there: bool):
    """The rows of Arrow batches whose number d is (or is not) marked in the bit map."""
    for batch in batches:
        d = batch.column(batch.schema.get_field_index("d")).to_numpy(zero_copy_only=False)
        yield batch.filter(pa.array(marked_in(words, d) == there))


def only(docs: DataFrame, words: np.ndarray, there: bool) -> DataFrame:
    """Rows whose number is (or is not) marked in the bit map.

    Python sees the numbers alone: whole texts in its batches would take memory on both sides.
    """

    @F.arrow_udf("boolean")
    def fits(d: pa.Array) -> pa.Array:
        return pa.array(marked_in(words, d.to_numpy(zero_copy_only=False)) == there)

    return docs.where(fits("d"))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of `docs` whose number d is not among those of `dropped` (stored).

    Rows the bit map does not know pass by at once; only the others meet in an anti-join.
    """
    words = bit_map(dropped)
    return only(docs, words, False).unionByName(doubtful(docs, dropped, words))


def doubtful(docs: DataFrame, dropped: DataFrame, words: np.ndarray) -> DataFrame:
    """The rows of `without` that the bit map of `dropped` cannot tell apart from dropped ones."""
    return only(docs, words, True).join(dropped.select("d").distinct(), "d", "left_anti").select(*docs.columns)


def slices_of(sorted_keys: np.ndarray) -> tuple[list[int], list[slice]]:
    """The keys of a sorted array and the slice of each."""
    if not len(sorted_keys):
        return [], []
    at = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
    ends = np.concatenate([at[1:], [len(sorted_keys)]])
    return sorted_keys[at].tolist(), [slice(int(a), int(b)) for a, b in zip(at, ends, strict=True)]
