"""Phrases whose words stand together far more often than their parts would let expect.

Words of a language are ranked by frequency; the rank is the id. The matrix of all pairs of ids
is cut into tiles of TILE x TILE. A task turns its text into ids, deals the pairs of
neighbours to tiles, counts full tiles by direct address with `numpy.bincount` and thin ones as
sorted coordinates, and sends one row per cell; Spark adds the rows up. Frequent pairs get ids
by their rank in turn, and a pair followed by a word is counted the same way, so phrases of
three words are pairs of a pair and a word.

Only the first HEAD ids travel to the tasks (8 bytes each, whatever the input). Rarer words and
pairs are named by 62-bit hashes instead of ids and always counted as coordinates; a bit map
of fixed size keeps most that are too rare for any phrase out of the shuffle. It decides
nothing else: every phrase is counted whole. What rests on hashes: two words of one language,
or two pairs, with the same 62-bit hash would be taken for one.

Defined cases: null texts are empty, a null language is `und`, and so is that text. Text without
words gives nothing. A phrase ends where its piece ends. Repeated rows count each time. Equal
scores are ordered by count, then by the bytes of the phrase. An empty table gives no rows.
Very long texts are read in parts of about PART bytes that end between pieces (a part grows until the piece
does); no part depends on another. Columns other than the text and the language are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gathered, partitions, stored, text_batches, text_bytes
from .bytehash import mix
from .order import running
from .rows import bit_map, marked_in

MIN_COUNT = 10
#: A candidate inside a longer one that holds this percentage of its occurrences is dropped.
ABSORBED = 50
TOP = 2000
HEAD = 1 << 18
TILE = 1 << 10
#: A tile is counted by direct address when it has this many pairs; below, as coordinates.
FULL = TILE * TILE // 32
#: Pairs that a task holds before it counts them.
HELD = 1 << 21
PART = 1 << 22
TAIL = np.int64(1 << 62)

#: 1: white space inside a piece, 2: end of a piece (fixed values of the contract).
KIND = np.zeros(256, np.uint8)
KIND[[0x20, 0x09]] = 1
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _parts(data: np.ndarray, ends: np.ndarray):
    """Parts of a buffer that end between pieces or documents (`ends`: where documents end)."""
    lo, n = 0, len(data)
    while lo < n:
        hi = min(lo + PART, n)
        while hi < n:
            cut = np.flatnonzero(KIND[data[lo:hi]] == 2)
            at = np.searchsorted(ends, hi, "right") - 1
            last = max(lo + int(cut[-1]) + 1 if len(cut) else lo, int(ends[at]) if at >= 0 else lo)
            if last > lo:
                hi = last
                break
            hi = min(hi + PART, n)
        yield lo, hi
        lo = hi


def _words(texts: pa.Array):
    """(words as an Arrow array, joined: whether each word but the first goes on the piece of the one before)."""
    data, offsets = text_bytes(texts)
    ends = offsets[1:]
    for lo, hi in _parts(data, ends):
        part = LOWER[data[lo:hi]]
        kind = KIND[part]
        word = kind == 0
        inner = ends[(ends > lo) & (ends < hi)] - lo
        starts = word.copy()
        starts[1:] &= ~word[:-1]
        starts[inner[inner < len(word)]] = word[inner[inner < len(word)]]
        begin = np.flatnonzero(starts)
        if not len(begin):
            continue
        # A word's bytes are the word bytes from its start to the next start.
        place = np.cumsum(word)
        bounds = np.append(place[begin] - 1, place[-1]).astype(np.int32)
        found = pa.Array.from_buffers(
            pa.binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(part[word]))]
        )
        breaks = np.flatnonzero(kind == 2)
        pieces = np.searchsorted(breaks, begin) + np.searchsorted(inner, begin, "right")
        yield found, pieces[1:] == pieces[:-1]


def _by_language(batches):
    """(language, words, joined) of Arrow batches (lang, text)."""
    for part, texts in text_batches(batches, "text", PART):
        langs = part.column(part.schema.get_field_index("lang"))
        for lang in pc.unique(langs).to_pylist():
            for words, joined in _words(texts.filter(pc.equal(langs, lang))):
                yield lang, words, joined


def _codes(lang: str, words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, their tail codes, and the place of each word among them."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    seed = xxhash.xxh64_intdigest(lang.encode())
    hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in distinct.to_pylist()], np.uint64)
    return distinct, _tail(hashes), coded.indices.to_numpy()


def _tail(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(2)).astype(np.int64) | TAIL


def _pair_code(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The tail code of a pair of codes."""
    return _tail(mix(mix(x.astype(np.uint64)) + y.astype(np.uint64)))


def _ranked(codes: np.ndarray, head: tuple[np.ndarray, np.ndarray], frequent: np.ndarray) -> np.ndarray:
    """Ids of the codes in the head, the codes of others that may be frequent, -1 for the rest."""
    known, ids = head
    if not len(known):
        return np.where(marked_in(frequent, codes), codes, np.int64(-1))
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    there = known[at] == codes
    out = np.where(there, ids[at], np.int64(-1))
    other = ~there
    rest = codes[other]
    out[other] = np.where(marked_in(frequent, rest), rest, np.int64(-1))
    return out


def _runs(*keys: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of equally long arrays and how often each comes, by sorting."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    at = np.flatnonzero(new)
    return [k[at] for k in keys], np.diff(np.append(at, len(order)))


def count_cells(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(x, y, count) of pairs of codes: tiles by direct address or sorted, tail codes sorted."""
    out = []
    plain = (x < HEAD) & (y < HEAD)
    if not plain.all():
        (tx, ty), n = _runs(x[~plain], y[~plain])
        out.append((tx, ty, n))
        x, y = x[plain], y[plain]
    across = HEAD // TILE
    tile = (x // TILE) * across + y // TILE
    sizes = np.bincount(tile, minlength=1)
    thin = np.ones(len(x), bool)
    for t in np.flatnonzero(sizes >= FULL):
        inside = tile == t
        cells = np.bincount((x[inside] % TILE) * TILE + y[inside] % TILE, minlength=TILE * TILE)
        at = np.flatnonzero(cells)
        out.append((t // across * TILE + at // TILE, t % across * TILE + at % TILE, cells[at]))
        thin &= ~inside
    code = np.sort(x[thin] * HEAD + y[thin])
    at = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.zeros(0, np.int64)
    out.append((code[at] // HEAD, code[at] % HEAD, np.diff(np.append(at, len(code)))))
    return tuple(np.concatenate([o[i] for o in out]).astype(np.int64) for i in range(3))


def _rows(parts):
    """Arrow batches (x, y, n) of the counts of pairs of codes."""
    for x, y in gathered(parts, HELD):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in count_cells(x, y)], ["x", "y", "n"])


def _head(ranked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted tail codes of the first HEAD rows and their ids; of equal codes the first rank counts."""
    rows = ranked.where(F.col("id") < HEAD).select("code", "id").orderBy("id").toPandas()  # bounded by HEAD
    known, first = np.unique(rows["code"].to_numpy(np.int64), return_index=True)
    return known, rows["id"].to_numpy(np.int64)[first]


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, code, f) of every word."""

    def count(batches):
        for lang, words, _ in _by_language(batches):
            distinct, codes, places = _codes(lang, words)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(distinct)), distinct.cast(pa.string()), pa.array(codes),
                    pa.array(np.bincount(places, minlength=len(distinct)).astype(np.int64)),
                ],
                ["lang", "word", "code", "n"],
            )

    rows = texts.mapInArrow(count, "lang string, word string, code long, n long")
    return rows.groupBy("lang", "word").agg(F.first("code").alias("code"), F.sum("n").alias("f"))


def _ids(counted: DataFrame, *ties: str) -> DataFrame:
    """Rows ranked by f, with id and `key`, the name that tasks use: the id in the head, the code beyond."""
    ranked = running(counted, [], [F.desc("f"), *map(F.col, ties)]).withColumnRenamed("_at", "id").drop("_all")
    key = F.when(F.col("id") < HEAD, F.col("id")).otherwise(F.col("code"))
    return stored(ranked.withColumn("key", key), "ranked")


def phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    absorbed: int = ABSORBED,
    top: int | None = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the phrases of two and three words.

    a, l and r count the phrase and the two parts of its weakest cut, n all words of the language;
    score = floor(1000000 a a / (l r)). `top` None returns every phrase, without a rank.
    """
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    words = stored(word_counts(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    known = _ids(words.where(F.col("f") >= min_count), "lang", "word")
    head, frequent = _head(known), bit_map(known.where(F.col("id") >= HEAD).select(F.col("code").alias("d")))

    def pairs(batches):
        for language, found, joined in _by_language(batches):
            _, codes, places = _codes(language, found)
            ids = _ranked(codes, head, frequent)[places]
            good = joined & (ids[1:] >= 0) & (ids[:-1] >= 0)
            yield ids[:-1][good], ids[1:][good]

    def pair_rows(batches):
        yield from _rows(pairs(batches))

    twos = texts.mapInArrow(pair_rows, "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("f"))
    twos = stored(twos.where(F.col("f") >= min_count), "pairs")

    def named(batches):
        for batch in batches:
            x, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_pair_code(x, y))], ["x", "y", "f", "code"])

    twos = _ids(stored(twos.mapInArrow(named, "x long, y long, f long, code long"), "pairs"), "x", "y")
    two_head = _head(twos)
    two_frequent = bit_map(twos.where(F.col("id") >= HEAD).select(F.col("code").alias("d")))

    def threes(batches):
        for language, found, joined in _by_language(batches):
            _, codes, places = _codes(language, found)
            ids = _ranked(codes, head, frequent)[places]
            good = joined & (ids[1:] >= 0) & (ids[:-1] >= 0)
            two = np.full(len(good), -1, np.int64)
            two[good] = _ranked(_pair_code(ids[:-1][good], ids[1:][good]), two_head, two_frequent)
            both = (two[1:] >= 0) & (two[:-1] >= 0)
            yield two[:-1][both], ids[2:][both]

    def three_rows(batches):
        yield from _rows(threes(batches))

    long = texts.mapInArrow(three_rows, "x long, y long, n long").groupBy("x", "y").agg(F.sum("n").alias("a"))
    long = long.where(F.col("a") >= min_count)
    return _scored(known, twos, long, totals, absorbed, top)


def _scored(known: DataFrame, twos: DataFrame, long: DataFrame, totals: DataFrame, absorbed: int, top: int | None) -> DataFrame:
    word = lambda i: known.select(
        F.col("key").alias(f"k{i}"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"), F.col("lang").alias(f"lang{i}")
    )
    pair = lambda *c: twos.select(*[F.col(a).alias(b) for a, b in zip(("key", "x", "y", "f"), c, strict=True)])

    # x is the first pair, y the third word: the second pair is looked up by its two words.
    first = long.join(pair("x", "k1", "k2", "f12"), "x").withColumnRenamed("y", "k3")
    whole = stored(first.join(pair("p2", "k2", "k3", "f23"), ["k2", "k3"]), "triples")
    inside = whole.select(F.col("x").alias("p"), "a").unionByName(whole.select(F.col("p2").alias("p"), "a"))
    longest = inside.groupBy("p").agg(F.max("a").alias("_in"))
    three = whole.join(word(1), "k1").join(word(2).select("k2", "w2"), "k2").join(word(3).drop("lang3"), "k3")
    two = pair("p", "k1", "k2", "a").join(longest, "p", "left")
    two = two.where(F.col("_in").isNull() | (100 * F.col("_in").cast("decimal(38,0)") < absorbed * F.col("a").cast("decimal(38,0)")))
    two = two.join(word(1), "k1").join(word(2).drop("lang2"), "k2")

    # Products stay below 10 ** 38 up to ten quadrillion occurrences.
    def score(left: str, right: str):
        a, l, r = (f"cast({c} as decimal(19,0))" for c in ("a", left, right))
        return F.expr(f"({a} * {a} * cast(1000000 as decimal(7,0))) div ({l} * {r})")

    cut = lambda k, left, right: F.struct(
        score(left, right).alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r")
    )
    columns = ["lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score")]
    found = (
        two.withColumns({"lang": F.col("lang1"), "phrase": F.concat_ws(" ", "w1", "w2"), "cut": cut(1, "f1", "f2")})
        .select(*columns)
        .unionByName(
            three.withColumns(
                {
                    "lang": F.col("lang1"),
                    "phrase": F.concat_ws(" ", "w1", "w2", "w3"),
                    "cut": F.least(cut(1, "f1", "f23"), cut(2, "f12", "f3")),
                }
            ).select(*columns)
        )
    )
    if top is None:
        return found.join(totals, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")
    # The first of many parts of a language, then of fewer, then of the language: a task gets at
    # most the first of as many parts as the root of their number.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    many = partitions(found.sparkSession)
    best = found.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(many)))
    for parts in (many, math.isqrt(many), 1):
        near = Window.partitionBy("lang", F.col("_part") % parts).orderBy(*order)
        best = best.withColumn("rank", F.row_number().over(near).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
