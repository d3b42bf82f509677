"""Benchmark decontamination by a distributed positional inverted index.

1. Benchmark items become windows of ten words; the words of the windows are counted in the
   training texts (partial sums, one row per word and task is shuffled).
2. Each window is opened from its two rarest words. Their postings (word, document,
   position) are stored as a table in the shared folder, all other words are not.
3. Postings of the rarest word, moved back by its place in the window, are starts; they are
   intersected with the moved postings of the second word on (document, window, start).
4. Only for documents that still have a start, the postings of all window words are built,
   and a start stays when every word of its window has a posting at its place: a join on
   (document, position, word) and a count.

With `slop` above 0 a word may stand up to `slop` places from its own place (proximity).
All steps are DataFrame functions; the largest exchange is postings of rare words. The
benchmark side is joined by whatever strategy Spark finds for its measured size.

Defined cases: a null or empty text has no words and no hits; an item without words has no
windows; an item of fewer words than a window is one window of its own length. Repeated
items count one by one in n_items, repeated documents (same id and text) get equal rows.
Null ids are allowed on both sides; a null item_id is written as `null` among the ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_IN_WORD, ascii_lower, split_words, stored

WINDOW = 10


def item_windows(items: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id") -> DataFrame:
    """One row per item and window: item_id, w (hash of its words), words."""
    words = split_words(ascii_lower(F.coalesce(F.col(text), F.lit(""))), NOT_IN_WORD)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    return (
        items.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item_id"), words.alias("words"))
        .where(F.size("words") > 0)
        .select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start") + 1, F.lit(window)).alias("words"))
        .select("item_id", F.xxhash64("words").alias("w"), "words")
    )


def keyed(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """k1, k2 stand for a document: its id (or -1) and a hash of id and text."""
    return docs.select(
        F.coalesce(F.col(id_column), F.lit(-1)).alias("k1"),
        F.xxhash64(id_column, text).alias("k2"),
        F.coalesce(F.col(text), F.lit("")).alias("body"),
    )


def postings(rows: DataFrame, *key: str) -> DataFrame:
    """Every word of `body` with its position. A leading separator moves all positions alike."""
    return (
        rows.select(*key, F.posexplode(F.split("body", NOT_IN_WORD)).alias("pos", "term"))
        .where("term != ''")
        .withColumn("term", ascii_lower(F.col("term")))
    )


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """All occurrences: k1, k2, w, start, size. `docs` has k1, k2, body (see `keyed`)."""
    windows = item_windows(items, window).select("w", "words").distinct()
    places = windows.select("w", F.size("words").alias("size"), F.posexplode("words").alias("off", "term"))
    terms = places.select("term").distinct()

    # Summed in each task before anything is shuffled or joined, so a frequent word is no hot key.
    counts = postings(docs).groupBy("term").agg(F.count("*").alias("n")).join(terms, "term")
    rare = Window.partitionBy("w").orderBy("n", "term", "off")
    ranked = (
        places.join(counts, "term", "left")
        .withColumn("n", F.coalesce("n", F.lit(0).cast("long")))
        .withColumn("least", F.min("n").over(Window.partitionBy("w")))
        .where("least > 0")
        .withColumn("rank", F.row_number().over(rare))
    )
    openers = stored(ranked.where("rank <= 2").select("w", "size", "off", "term", "rank"), "openers")

    index = stored(
        postings(docs, "k1", "k2").join(openers.select("term").distinct(), "term").select("term", "k1", "k2", "pos"),
        "postings",
    )
    moved = index.join(openers, "term").withColumn("start", F.col("pos") - F.col("off"))
    first = moved.where("rank = 1").select("k1", "k2", "w", "size", "start")
    second = moved.where("rank = 2").select("k1", "k2", "w", F.lit(True).alias("near"), "start")
    if slop:
        second = second.withColumn("start", F.explode(F.sequence(F.col("start") - slop, F.col("start") + slop)))
    alone = F.col("size") == 1
    opened = (
        first.where(~alone)
        .join(second.distinct(), ["k1", "k2", "w", "start"], "left_semi")
        .unionByName(first.where(alone))
        .select("k1", "k2", "w", "size", "start")
    )
    opened = stored(opened.distinct(), "starts")

    found_in = docs.join(opened.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi")
    there = postings(found_in, "k1", "k2").join(terms, "term", "left_semi").distinct()
    wanted = opened.join(places.drop("size"), "w")
    wanted = wanted.withColumn("pos", F.col("start") + F.col("off"))
    if slop:
        wanted = wanted.withColumn("pos", F.explode(F.sequence(F.col("pos") - slop, F.col("pos") + slop)))
    met = wanted.join(there, ["k1", "k2", "pos", "term"]).select("k1", "k2", "w", "start", "size", "off").distinct()
    return (
        met.groupBy("k1", "k2", "w", "start", "size").agg(F.count("*").alias("n")).where("n = size").drop("n")
    )


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    slop: int = 0,
    text: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """`docs` with n_words, n_hit, n_items, items_sha256 and contaminated.

    n_hit counts the words inside any occurrence; with `slop` the words of the whole stretch
    that a window may take. Input columns of these names are replaced.
    """
    rows = keyed(docs, text, id_column)
    found = stored(matches(rows, items, window, slop), "occurrences")
    hit = (
        found.select(
            "k1", "k2", F.explode(F.sequence(F.col("start") - slop, F.col("start") + F.col("size") - 1 + slop)).alias("pos")
        )
        .distinct()
        .groupBy("k1", "k2")
        .agg(F.count("*").alias("n_hit"))
    )
    with_items = (
        found.select("k1", "k2", "w")
        .distinct()
        .join(item_windows(items, window).select("w", "item_id").distinct(), "w")
        .select("k1", "k2", "item_id")
        .distinct()
        .groupBy("k1", "k2")
        .agg(
            F.count("*").alias("n_items"),
            F.sha2(F.concat_ws(",", F.sort_array(F.collect_list("item_id"))), 256).alias("items_sha256"),
        )
    )
    outputs = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    kept = [c for c in docs.columns if c not in outputs]
    counted = docs.select(
        F.coalesce(F.col(id_column), F.lit(-1)).alias("k1"),
        F.xxhash64(id_column, text).alias("k2"),
        F.struct(*kept).alias("_row"),
        F.size(split_words(F.col(text), NOT_IN_WORD)).cast("long").alias("n_words"),
    )
    none = F.lit(0).cast("long")
    return (
        counted.join(hit.join(with_items, ["k1", "k2"], "left"), ["k1", "k2"], "left")
        .select(
            "_row.*",
            "n_words",
            F.coalesce("n_hit", none).alias("n_hit"),
            F.coalesce("n_items", none).alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            (F.coalesce("n_hit", none) > 0).alias("contaminated"),
        )
    )
