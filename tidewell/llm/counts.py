"""Token counts: an exact histogram of encoded lengths, and what follows from it.

Each task sends one row per length it has met, so the shuffle grows with the number of
distinct lengths. Sums over all longer (or shorter) documents are taken in two levels,
inside blocks of BLOCK lengths and over the blocks, so no task gets the whole histogram.

Defined cases: null and empty texts have length 0 and are counted. Repeated rows count each
time. An empty table has an empty histogram, no quantiles, and totals of zero.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, text_batches
from .tokens import encoder, tokenizer_path

BLOCK = 1024


def histogram(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """(length, n_docs) of the encoded texts, written once: what follows reads it more than once."""
    path = path or tokenizer_path()

    def count(batches):
        seen: dict[int, int] = {}
        for _, texts in text_batches(batches, "text", encode=True):
            for n, c in zip(*np.unique(encoder(path).counts(texts.to_pylist()), return_counts=True), strict=True):
                seen[int(n)] = seen.get(int(n), 0) + int(c)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["length", "n"]
        )

    rows = docs.select(F.col(text).alias("text")).mapInArrow(count, "length long, n long")
    return stored(rows.groupBy("length").agg(F.sum("n").alias("n_docs")), "histogram")


def length_sums(hist: DataFrame) -> DataFrame:
    """For every length L: documents and tokens of at least L and at most L, the total when
    all are cut to L, and the share of documents of at most L."""
    rows = hist.select(
        "length", "n_docs", (F.col("length") * F.col("n_docs")).alias("tokens"), F.expr(f"length div {BLOCK}").alias("block")
    )
    blocks = rows.groupBy("block").agg(F.sum("n_docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    none = F.lit(0).cast("long")
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_docs").over(later), none).alias("later_docs"),
        F.coalesce(F.sum("block_tokens").over(later), none).alias("later_tokens"),
        F.sum("block_docs").over(everything).alias("all_docs"),
        F.sum("block_tokens").over(everything).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.join(blocks, "block").select(
        "length",
        "n_docs",
        (F.sum("n_docs").over(inside) + F.col("later_docs")).alias("docs_at_least"),
        (F.sum("tokens").over(inside) + F.col("later_tokens")).alias("tokens_at_least"),
        "all_docs",
        "all_tokens",
    )
    below = F.col("all_tokens") - F.col("tokens_at_least")
    at_most = F.col("all_docs") - F.col("docs_at_least") + F.col("n_docs")
    return summed.select(
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (below + F.col("length") * F.col("docs_at_least")).alias("truncated_total"),
        at_most.alias("docs_at_most"),
        (at_most / F.col("all_docs")).alias("share_at_most"),
    )


def quantiles(sums: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least this share of documents does not exceed."""
    pick = [F.min(F.when(F.col("share_at_most") >= s, F.col("length"))).alias(str(s)) for s in shares]
    return sums.agg(*pick).unpivot([], [F.col(f"`{s}`") for s in shares], "share", "length")


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, total): tokens left when every document is cut to each limit."""
    pick = [
        F.coalesce(F.sum(F.least(F.col("length"), F.lit(n)) * F.col("n_docs")), F.lit(0).cast("long")).alias(str(n))
        for n in limits
    ]
    return hist.agg(*pick).unpivot([], [F.col(f"`{n}`") for n in limits], "limit", "total")
