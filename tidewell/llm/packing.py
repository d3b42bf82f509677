"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents are counted in tokens (with an end token), those above the longest sequence are
cut into pieces of that length, and pieces are dealt evenly over tasks. Each task packs its
own pieces, longest first: a piece goes into the open bin it leaves least room in; if none
fits, the bin size whose cost per token it can still be filled with is least is opened. At
the end each bin shrinks to the shortest permitted length that holds its contents. A task
holds lengths only, at most PIECES of them on average; texts stay where they are.

Cost of a sequence of c tokens: c + c * c / SQUARE + FIXED (linear work, attention, overhead).

Defined cases: a null or empty text is one end token. Nothing is dropped or cut short: each
token of each document is in exactly one bin. Ties go to the bin opened first, and pieces
of equal length to the smaller id. Repeated rows are packed each. An empty table gives none.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored, text_batches
from .tokens import encoder, tokenizer_path

LENGTHS = (512, 1024, 2048, 4096, 8192)
SQUARE, FIXED = 16384.0, 64.0
PIECES = 20_000


def cost(c: int) -> float:
    return c + c * c / SQUARE + FIXED


def pack(sizes: list[int], lengths: tuple[int, ...] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece (sizes falling), and the final length of each bin."""
    lengths = tuple(sorted(lengths))
    rest = sum(sizes)
    room: list[tuple[int, int]] = []  # (room, bin), sorted
    used: list[int] = []
    bins, offsets = [], []
    for n in sizes:
        rest -= n
        i = bisect_left(room, (n, -1))
        if i < len(room):
            left, b = room.pop(i)
        else:
            left = min((c for c in lengths if c >= n), key=lambda c: (cost(c) / min(c, n + rest), c))
            b = len(used)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        if left > n:
            insort(room, (left - n, b))
    return bins, offsets, [lengths[bisect_left(lengths, u)] for u in used]


def token_lengths(docs: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) with the end token, stored: texts are read and encoded once."""
    path = path or tokenizer_path()
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))

    def count(batches):
        for batch, texts in text_batches(batches, "text", encode=True):
            n = encoder(path).counts(texts.to_pylist()) + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n)], ["doc_id", "n_tokens"])

    return stored(rows.mapInArrow(count, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long"), "lengths")


def pack_lengths(lengths_of: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """One row per piece: doc_id, piece, first_token, n_tokens, bin_id, bin_offset, bin_length."""
    longest = max(lengths)
    n = F.col("n_tokens")
    pieces = lengths_of.select(
        "doc_id", "n_tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n_tokens - 1) div {longest}"))).alias("piece")
    ).select(
        "doc_id",
        "piece",
        (F.col("piece") * longest).alias("first_token"),
        F.least(n - F.col("piece") * longest, F.lit(longest)).alias("n_tokens"),
    )
    total = lengths_of.agg(F.sum(F.expr(f"(n_tokens - 1) div {longest} + 1"))).head()[0] or 0
    shards = max(partitions(lengths_of.sparkSession), -(-total // PIECES))
    kind = dict(lengths_of.dtypes)["doc_id"]

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        rows = pa.Table.from_batches(got).combine_chunks()
        rows = rows.sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets, ends = pack(rows["n_tokens"].to_pylist(), lengths)
        bins = np.array(bins)
        table = (
            rows.append_column("bin_id", pa.array((task << 32) + bins))
            .append_column("bin_offset", pa.array(offsets, pa.int64()))
            .append_column("bin_length", pa.array(np.array(ends, np.int64)[bins]))
        )
        yield from table.to_batches(max_chunksize=10_000)

    # Dealt by the place of a row in the stored table, so equal ids are spread as well.
    dealt = pieces.withColumn("_place", F.monotonically_increasing_id()).repartition(shards, "_place").drop("_place")
    return dealt.mapInArrow(
        run,
        f"doc_id {kind}, piece long, first_token long, n_tokens long, bin_id long, bin_offset long, bin_length long",
    )


def pack_documents(
    docs: DataFrame,
    lengths: tuple[int, ...] = LENGTHS,
    id_column: str = "doc_id",
    text: str = "text",
    path: str | None = None,
) -> DataFrame:
    """Encode `docs` and pack them (see `pack_lengths`)."""
    return pack_lengths(token_lengths(docs, id_column, text, path), lengths)
