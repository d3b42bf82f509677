"""Mixing sources to target weights.

Every source gets a share of all words by its weight. A share above `max_epochs` times the
source stops there and what is left goes to the others by weight, until none is above. A
source takes whole epochs of all its documents first. The rest of its target is sampled
without replacement after Efraimidis and Spirakis: each document draws an exponential key
divided by its quality weight, the smallest keys come first, and documents are taken along the
running sum of their sizes while at least half of a document fits. The draw is a hash of id
and text, so reruns agree. All of it is DataFrame functions; running sums go by ranges of the
order (`order.running`), so a source with most of the rows is many tasks.

Defined cases: null and empty texts have size 0 and are taken 0 times in part, though whole
epochs count for them as for all others. Null sources are one source, ordered last. Sources
without words have target 0. Null ids draw by their text. Repeated rows count each time; of
rows equal in id, text and source any one may be the one that is taken once more. An empty
table gives an empty mix. Very long texts are whole documents like all others: the error of a
source is at most half of the document at the cut. Columns of `docs` other than the named ones
are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, split_words, stored
from .order import running

#: Weights of the sources in the order of their names, repeated as often as needed.
WEIGHTS = (1, 2, 3)
#: No source is read more often than this.
MAX_EPOCHS = 3
SEED = 7
BIG = "decimal(38,0)"


def text_quality(text: Column) -> Column:
    """Between 0.1 and 1: less the more digits and symbols there are."""
    whole = F.coalesce(text, F.lit(""))
    odd = F.length(whole) - F.length(F.regexp_replace(whole, r"[0-9#*$%&|<>{}=_+~^@]+", ""))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(2.0) * odd / F.greatest(F.length(whole), F.lit(1)))


def draw(id_column: str, text: str, seed: int) -> Column:
    """A hash of id and text as hex digits, null as empty."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_column, text)]
    return F.md5(F.concat(F.lit(f"{seed}:"), parts[0], F.lit(":"), parts[1]))


def exponential_key(digits: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from the first 52 bits of a hash; weights must be above 0."""
    u = (F.conv(F.substring(digits, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target, _epochs, _rest) from rows (source, size).

    The shares rise together until each round's capped sources stay the same. A round is one
    aggregate over the sources; every round but the last caps at least one more.
    """
    sources = stored(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    nth = F.col("_at") % len(weights)
    ranked = running(sources, [], [F.asc_nulls_last("source")]).select(
        "source", "source_size", F.get(F.array(*map(F.lit, weights)), nth).cast("long").alias("weight")
    )
    ranked = stored(ranked, "sources")
    size, weight = F.col("source_size").cast(BIG), F.col("weight").cast(BIG)
    everything = ranked.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    words, shares, n_capped = everything["t"] or 0, everything["w"] or 1, -1
    level, capped = (words, shares), F.lit(False)
    while True:
        above = weight * F.lit(level[0]).cast(BIG) > size * F.lit(max_epochs * level[1]).cast(BIG)
        found = ranked.where(above).agg(F.count("*").alias("n"), F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
        if found["n"] == max(n_capped, 0):
            break
        n_capped, capped = found["n"], above
        level = (words - max_epochs * found["s"], shares - found["w"])
    share = (weight * F.lit(level[0]).cast(BIG)).cast("double") / F.lit(float(level[1]))
    target = F.when(capped, (F.col("source_size") * max_epochs).cast("double")).otherwise(share)
    whole = F.floor(target / F.greatest(F.col("source_size"), F.lit(1)))
    epochs = F.when(F.col("source_size") == 0, 0).when(capped, max_epochs).otherwise(whole).cast("long")
    return ranked.select("source", "source_size", target.alias("target"), epochs.alias("_epochs")).withColumn(
        "_rest", F.col("target") - F.col("_epochs") * F.col("source_size")
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    text: str = "text",
    source: str = "source",
    id_column: str = "doc_id",
    quality: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, source, digest, size, source_size, target, epochs, chosen, taken.

    `quality` is a column above 0 (default: `text_quality`). The mix holds a document
    `epochs` times, and once more where it is `chosen`; `taken` counts its words in the mix.
    """
    weight = text_quality(F.col(text)) if quality is None else quality.cast("double")
    drawn = docs.select(
        F.col(id_column).alias("id"),
        F.col(source).alias("source"),
        draw(id_column, text, seed).alias("digest"),
        F.size(split_words(F.col(text), WHITE_SPACE)).cast("long").alias("size"),
        weight.alias("weight"),
    )
    sized = stored(drawn.select("id", "source", "digest", "size", exponential_key(F.col("digest"), F.col("weight")).alias("key")), "sizes")
    goals = targets(sized, weights, max_epochs)
    order = [F.col("key"), F.col("id"), F.col("digest")]
    placed = running(sized, ["source"], order, "size").alias("d")
    met = placed.join(goals.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source")))
    chosen = (F.col("size") > 0) & (2 * F.col("_before") + F.col("size") <= 2 * F.col("_rest"))
    return met.select(
        "id", "d.source", "digest", "size", "source_size", "target", F.col("_epochs").alias("epochs"), chosen.alias("chosen")
    ).withColumn("taken", F.col("size") * (F.col("epochs") + F.col("chosen").cast("long")))


def mixture(
    docs: DataFrame, text: str = "text", source: str = "source", id_column: str = "doc_id", seed: int = SEED, **options
) -> DataFrame:
    """The rows of the mix itself: those of `docs`, each as often as it is taken.

    Rows equal in id, text and source share their copies: one of them stands for all.
    """
    plan = mix(docs, text=text, source=source, id_column=id_column, seed=seed, **options)
    copies = plan.groupBy("id", "source", "digest").agg(F.sum(F.col("epochs") + F.col("chosen").cast("long")).alias("_copies"))
    own = docs.select(F.struct(*docs.columns).alias("_row"), draw(id_column, text, seed).alias("_digest"))
    keyed = own.select("_row", F.col(f"_row.{id_column}").alias("_id"), F.col(f"_row.{source}").alias("_source"), "_digest")
    once = keyed.dropDuplicates(["_id", "_source", "_digest"])
    same = (
        F.col("_id").eqNullSafe(F.col("id")) & F.col("_source").eqNullSafe(F.col("source")) & (F.col("_digest") == F.col("digest"))
    )
    found = once.join(copies.where("_copies > 0"), same)
    return found.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))).select("_row.*")
