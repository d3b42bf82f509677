"""The registered queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    counts,
    decontaminate,
    jaccard,
    lines,
    merkle,
    mixing,
    packing,
    phrases,
    quality,
    suffixdedup,
    tokenfiles,
    toxicity,
    urlfilter,
)
from .common import ascii_lower

#: (host, path, action) of the query over `pages`.
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, folder, "labels"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.decontaminate(docs, table(spark, folder, "benchmark")).drop("text")


def op3_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents").select("doc_id", "text"))


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return urlfilter.filter_urls(pages, rules).drop("url")


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return tokenfiles.read_documents(tokenfiles.write_tokens(docs))


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return suffixdedup.deduplicate(docs, keep_text=False)


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    return lines.filter_lines(docs, keep_text=False).drop("text", "source")


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return counts.length_sums(counts.histogram(table(spark, folder, "documents").select("text")))


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.quality(docs, table(spark, folder, "labels"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(*merkle.FIELDS)
    lowered = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf_hash(*lowered))
    proved = merkle.manifest(docs, carry={"tampered": tampered})
    shown = proved.withColumn("folded_root", merkle.folded(F.coalesce("tampered", "leaf"), F.col("proof")))
    return shown.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents").select("doc_id", "source", "text"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.phrases(table(spark, folder, "documents").select("lang", "text"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_toxicity,
        op2_decontamination,
        op3_jaccard_join,
        op4_best_fit_packing,
        op5_url_filters,
        op6_token_files,
        op7_suffix_dedup,
        op8_quality_rules,
        op9_token_counts,
        op10_quality_classifier,
        op11_merkle_manifest,
        op12_mixing,
        op13_phrases,
    )
    return {f.__name__: f for f in found}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP2_SQL = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS size,
    array_to_string(words[i:i + 9], ' ') AS w
  FROM item, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(i) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT size FROM win),
spot AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS w
  FROM doc, sizes, unnest(range(1, len(words) - size + 2)) AS t(i)),
met AS (SELECT doc_id, size, i, w FROM spot WHERE (size, w) IN (SELECT size, w FROM win)),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM met, unnest(range(i, i + size)) AS t(p) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met JOIN win USING (size, w))
  GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP5_SQL = rf"""
WITH cut AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(rhost, rpath, action) AS (VALUES {", ".join(map(str, URL_RULES))}),
fit AS (
  SELECT page_id, rhost || rpath AS rule, action,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, action) AS n
  FROM cut JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM cut LEFT JOIN (SELECT page_id, rule, action FROM fit WHERE n = 1) USING (page_id)
"""

OP8_SQL = rf"""
WITH doc AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
three AS (
  SELECT doc_id, i, array_to_string(words[i:i + 2], ' ') AS w
  FROM doc, unnest(range(1, len(words) - 1)) AS t(i)),
twice AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM three),
again AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM twice, unnest([i, i + 1, i + 2]) AS t(p) WHERE n > 1 GROUP BY doc_id),
line AS (
  SELECT doc_id, source,
    trim(lower(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line,
    len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
  FROM doc, unnest(lines) AS t(l)),
frequent AS (
  SELECT source, line FROM line GROUP BY source, line HAVING count(DISTINCT doc_id) > {lines.MAX_DOCUMENTS}),
common AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_common_words
  FROM line SEMI JOIN frequent USING (source, line) GROUP BY doc_id),
base AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_common_words, 0) AS n_common_words
  FROM doc LEFT JOIN again USING (doc_id) LEFT JOIN common USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND n_words - n_common_words >= {lines.MIN_SHARE} * n_words AS kept
FROM base
"""


#: DuckDB lacks crc32: its usual table (the reversed polynomial 0xEDB88320), then byte by byte.
CRC_TABLE = """list_transform(range(256), lambda i: list_reduce(list_value(0, 0, 0, 0, 0, 0, 0, 0),
  lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i))"""
CRC_OF_ID = """xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT)),
  lambda c, b: xor(crc_table[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"""

OP11_SQL = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id, lang, text,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
      || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
      || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
    translate(text, '{UPPER}', '{LOWER}') AS lowered
  FROM documents),
hashed AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(octet_length(encode(lowered)) || ':' || lowered, '-')) AS low
  FROM doc),
leaves AS (
  SELECT *, {CRC_TABLE} AS crc_table, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
nodes AS (
  SELECT 0 AS level, g, pos, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, g, pos // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM nodes) WHERE n > 1 GROUP BY level, g, pos // 8),
height AS (SELECT g, max(level) AS top FROM nodes GROUP BY g),
subroots AS (SELECT g, top, h FROM nodes JOIN height USING (g) WHERE level = top),
uppers AS (
  SELECT 0 AS level, g AS pos, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM uppers) WHERE n > 1 GROUP BY level, pos // 8),
root AS (SELECT h FROM uppers ORDER BY level DESC LIMIT 1),
low_side AS (
  SELECT g, o.pos, o.level, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < o.pos), '') AS l,
    coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > o.pos), '') AS r
  FROM nodes o JOIN nodes s USING (g) JOIN height USING (g)
  WHERE o.level = s.level AND o.pos // 8 = s.pos // 8 AND o.level < top GROUP BY g, o.pos, o.level),
up_side AS (
  SELECT o.pos, o.level, coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos < o.pos), '') AS l,
    coalesce(string_agg(s.h, '' ORDER BY s.pos) FILTER (s.pos > o.pos), '') AS r
  FROM uppers o JOIN uppers s ON o.level = s.level AND o.pos // 8 = s.pos // 8
  WHERE o.level < (SELECT max(level) FROM uppers) GROUP BY o.pos, o.level),
side AS (
  SELECT g, pos, level, level AS step, l, r, false AS above FROM low_side
  UNION ALL
  SELECT NULL, pos, level, level, l, r, true FROM up_side),
fold AS (
  SELECT g, pos AS leaf_pos, pos, 0 AS level, false AS above, '' AS proof,
    CASE WHEN crc % 3 = 0 THEN low ELSE leaf END AS h
  FROM (SELECT *, {CRC_OF_ID} AS crc FROM leaves)
  UNION ALL
  SELECT f.g, leaf_pos, CASE WHEN s.l IS NULL THEN f.g ELSE f.pos // 8 END,
    CASE WHEN s.l IS NULL THEN 0 ELSE f.level + 1 END, f.above OR s.l IS NULL,
    proof || coalesce(s.l || s.r, ''), CASE WHEN s.l IS NULL THEN h ELSE sha256(s.l || h || s.r) END
  FROM fold f LEFT JOIN side s
    ON s.above = f.above AND s.level = f.level AND s.pos = f.pos AND (f.above OR s.g = f.g)
  WHERE NOT (f.above AND s.l IS NULL)),
done AS (
  SELECT g, leaf_pos, proof, h FROM fold WHERE above
  QUALIFY row_number() OVER (PARTITION BY g, leaf_pos ORDER BY level DESC) = 1)
SELECT doc_id, leaf, subroots.h AS subroot, root.h AS root, sha256(proof) AS proof_sha256,
  done.h AS folded_root, done.h = root.h AS verified
FROM leaves JOIN done ON leaves.g = done.g AND leaf_pos = pos JOIN subroots ON subroots.g = leaves.g, root
"""

OP12_SQL = rf"""
WITH doc AS (
  SELECT doc_id, source, coalesce(text, '') AS body,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest
  FROM documents),
keyed AS (
  SELECT doc_id, source, size, digest,
    -ln((CAST('0x' || digest[1:13] AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
      / greatest(0.1::DOUBLE, 1.0::DOUBLE - 2.0::DOUBLE * CAST(length(body)
        - length(regexp_replace(body, '[0-9#*$%&|<>{{}}=_+~^@]+', '', 'g')) AS DOUBLE) / greatest(length(body), 1)) AS key
  FROM doc),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    list_extract({list(mixing.WEIGHTS)}, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1 AS BIGINT)) AS w
  FROM doc GROUP BY source),
lifted AS (
  SELECT *, {mixing.MAX_EPOCHS} * source_size / w AS ratio,
    (SELECT sum(source_size) FROM src) - coalesce(sum({mixing.MAX_EPOCHS} * source_size) OVER (
      ORDER BY {mixing.MAX_EPOCHS} * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
    sum(w) OVER (ORDER BY {mixing.MAX_EPOCHS} * source_size / w, source
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den
  FROM src),
level AS (
  SELECT num, den FROM lifted WHERE w * num <= {mixing.MAX_EPOCHS} * CAST(source_size AS HUGEINT) * den
  ORDER BY ratio, source LIMIT 1),
goal AS (
  SELECT source, source_size, w * num > {mixing.MAX_EPOCHS} * CAST(source_size AS HUGEINT) * den AS capped,
    CASE WHEN w * num > {mixing.MAX_EPOCHS} * CAST(source_size AS HUGEINT) * den
      THEN CAST({mixing.MAX_EPOCHS} * source_size AS DOUBLE) ELSE CAST(w * num AS DOUBLE) / CAST(den AS DOUBLE) END AS target
  FROM src, level),
whole AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 WHEN capped THEN {mixing.MAX_EPOCHS}
    ELSE CAST(floor(target / greatest(source_size, 1)) AS BIGINT) END AS epochs FROM goal),
ahead AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST, digest
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed)
SELECT doc_id, size, source_size, target, CAST(size * (epochs + CASE WHEN size > 0
  AND 2 * before + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM ahead JOIN whole ON ahead.source IS NOT DISTINCT FROM whole.source
"""

OP13_SQL = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
list AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
f AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM list, (VALUES (1), (2), (3)) AS s(size), unnest(range(1, len(w) - size + 2)) AS t(i) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang),
cand AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= {phrases.MIN_COUNT}),
absorbed AS (
  SELECT DISTINCT b.lang, b.phrase
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cand WHERE size = 3) t
  JOIN cand b ON b.lang = t.lang AND b.phrase = t.phrase WHERE 100 * t.a >= {phrases.ABSORBED} * b.a),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS pl, array_to_string(w[k + 1:], ' ') AS pr
  FROM cand ANTI JOIN absorbed USING (lang, phrase), unnest(range(1, size)) AS t(k)),
scored AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r,
    CAST(1000000 * CAST(a AS HUGEINT) * a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = pl JOIN f r ON r.lang = c.lang AND r.phrase = pr),
least_cut AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least_cut)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= {phrases.TOP}
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": OP2_SQL,
        "op5_url_filters": OP5_SQL,
        "op8_quality_rules": OP8_SQL,
        "op11_merkle_manifest": OP11_SQL,
        "op12_mixing": OP12_SQL,
        "op13_phrases": OP13_SQL,
    }
