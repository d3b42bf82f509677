"""Quality rules: counts of one text, and lines that many documents of a host repeat.

Lines are lower-cased, their white space is made single, and they are hashed. Distinct
documents are counted for each host and line; lines above the limit are taken out
(kept_text is what is left), and a document of which too little is left is rejected. All of it is DataFrame functions: the
counts of one text stay inside its row, the line counts are partial sums before the
shuffle, and the join of lines with frequent lines is an equi-join that adaptive execution
can split where one line holds a third of all rows.

Defined cases: a null or empty text has no words, fails the base rule and is not kept. A
null host is a host of its own. Repeated rows (same id, host and text) count as one
document and get the same result each. Ties do not occur: every rule is a threshold. An empty
table gives no rows. Very long texts are counted whole, inside their row. Input columns named
like an output or a work column (`_k1`, `_k2`, `_at`, `_split`) are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE_SPACE, split_words, stored

#: A line of more distinct documents of one host than this is boilerplate.
MAX_DOCUMENTS = 10
#: A document is depleted when less than this share of its words is left.
MIN_SHARE = 0.3

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts of one text (BASE) and base_failed to the rows of `docs`."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    kept = [c for c in docs.columns if c not in (*BASE, "base_failed")]
    words = docs.select(
        F.struct(*kept).alias("_row"),
        whole.alias("_text"),
        split_words(F.col(text), WHITE_SPACE).alias("_words"),
        lines.alias("_lines"),
    )
    # Hashes of three words in a row; sorted with their places only where one comes twice.
    third = F.transform(
        F.slice("_words", F.lit(1), F.greatest(F.size("_words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)),
    )
    hashed = words.withColumn("_three", third)
    repeated = F.size(F.array_distinct("_three")) < F.size("_three")
    places = hashed.withColumn(
        "_placed",
        F.when(
            repeated,
            F.sort_array(F.transform("_three", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    again = F.filter(
        "_placed",
        lambda p, i: (F.get("_placed", i + 1)["h"] == p["h"]) | (F.get("_placed", i - 1)["h"] == p["h"]),
    )
    starts = places.withColumn("_starts", F.sort_array(F.transform(again, lambda p: p["i"])))
    covered = F.aggregate(
        F.transform(
            "_starts",
            lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_starts", k + 1) - p, F.lit(3))).cast("long"),
        ),
        F.lit(0).cast("long"),
        lambda a, b: a + b,
    )
    counted = starts.select(
        "_row",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.select("_row.*", *BASE, failed.alias("base_failed"))


def line_rows(docs: DataFrame, text: str, host: str, key: list) -> DataFrame:
    """One row for each document and line with a word: key, host, line hash, words."""
    rows = docs.select(
        *key,
        F.col(host).alias("_host"),
        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("_pos", "_line"),
    )
    plain = F.trim(F.lower(F.regexp_replace("_line", WHITE_SPACE, " ")))
    return (
        rows.select("_k1", "_k2", "_host", "_pos", plain.alias("_line"))
        .where("_line != ''")
        .select(
            "_k1",
            "_k2",
            F.xxhash64("_host").alias("_host"),
            "_pos",
            F.xxhash64("_line").alias("_line"),
            (F.length("_line") - F.length(F.translate("_line", " ", "")) + 1).alias("_n"),
        )
    )


def filter_lines(
    docs: DataFrame,
    text: str = "text",
    host: str = "source",
    id_column: str = "doc_id",
    max_documents: int = MAX_DOCUMENTS,
    min_share: float = MIN_SHARE,
    keep_text: bool = True,
) -> DataFrame:
    """`docs` with the base counts, n_common_words (words in lines above the limit), kept, and, if
    `keep_text`, kept_text: the text without these lines, all other lines as they were."""
    docs = docs.drop("n_common_words", "kept", "kept_text", "_k1", "_k2", "_at", "_split")
    key = [F.coalesce(F.col(id_column), F.lit(-1)).alias("_k1"), F.xxhash64(id_column, host, text).alias("_k2")]
    counted = base_counts(docs.select("*", *key), text)
    lines = line_rows(docs, text, host, key)
    # The key holds host and text, so one place of one key is one line, however often the row comes.
    once = lines.groupBy("_k1", "_k2", "_pos").agg(
        F.first("_host").alias("_host"), F.first("_line").alias("_line"), F.first("_n").alias("_n")
    )
    sums = [F.sum("_n").alias("_n")] + [F.collect_list("_pos").alias("_at")] * keep_text
    # Stored, as both the counts and the join below read it: lines are cut and hashed once.
    per_document = stored(once.groupBy("_k1", "_k2", "_host", "_line").agg(*sums), "lines")
    frequent = (
        per_document.groupBy("_host", "_line").agg(F.count("*").alias("_docs")).where(F.col("_docs") > max_documents)
    )
    common = (
        per_document.join(frequent, ["_host", "_line"], "left_semi")
        .groupBy("_k1", "_k2")
        .agg(
            F.sum("_n").alias("n_common_words"),
            *[F.flatten(F.collect_list("_at")).alias("_at")] * keep_text,
        )
    )
    joined = counted.join(common, ["_k1", "_k2"], "left")
    removed = F.coalesce(F.col("n_common_words"), F.lit(0).cast("long"))
    kept = ~F.col("base_failed") & (F.col("n_words") - removed >= min_share * F.col("n_words"))
    if not keep_text:
        return joined.withColumns({"n_common_words": removed, "kept": kept}).drop("_k1", "_k2")
    # A column of its own: the lambda below must not split the text for each line.
    split = joined.withColumn("_split", F.split(text, "\n"))
    left = F.array_except(F.sequence(F.lit(0), F.size("_split") - 1), "_at")
    rest = F.array_join(F.transform(left, lambda i: F.get("_split", i)), "\n")
    kept_text = F.when(F.col("_at").isNull(), F.col(text)).otherwise(rest)
    return split.withColumns({"n_common_words": removed, "kept": kept, "kept_text": kept_text}).drop(
        "_k1", "_k2", "_at", "_split"
    )
