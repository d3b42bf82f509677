"""N-gram Jaccard join with a token-group matrix, and the components of its links.

Two documents link when 100 * |A and B| >= 75 * |A or B| on their sets of five-word shingles.

1. Each text becomes the set of its shingles (64-bit hashes). Equal sets are one class,
   named by its smallest document (partial minimum before the shuffle). Only classes go on.
2. Shingles are dealt over buckets and counted. A shingle of one class only can be in no
   intersection: a class with fewer shared shingles than a link needs is done. The others
   get their shared shingles back, rarest first. Shingles of more than HOT_SHARE of the
   documents (at most 1 / HOT_SHARE x the mean set) are known to be shared beforehand and
   rank last, so no bucket gathers them.
3. Groups: classes with the same least shingle hash are similar; they are cut into groups
   of about GROUP, all links of a group are computed, and the first class of the key is
   placed in each of its groups, which ties them together without pairs between groups.
4. Token-group matrix: for each group the union of the leading (rare) shingles of its
   members. Two sets that link share a leading shingle, so a class needs only those groups
   that share one with it early enough to leave room for the overlap of a link (so that pages of
   one template, alike in less than a link needs, do not meet) and hold another component. For these, the overlap with the union
   of all the group's shingles bounds every similarity; groups whose bound reaches the
   threshold are opened and compared set by set. A first pass opens only the first member
   of each component, which joins most of a large family of near copies at once.

Every link between different texts is inside a group, found by 4, or joins classes that are
connected already; components are exact. A group, a task and a row are bounded whatever the
number of copies.

Defined cases: null, empty and blank texts have no shingles and link with nothing, not even
with each other. Fewer than five words are one shingle, the whole sequence. Repeated rows
(same id and text) are copies; rows of equal or null id are told apart by their text, and
the smallest doc_id of a component is that of its first row (null first). Ties do not occur.
Input columns named n_shingles or component_id are replaced. No rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import TABLE, ByteHash, mix
from .common import gathered, give_back, lean_worker, partitions, pieces, stored, text_batches, text_bytes
from .components import connected
from .rows import bit_map, doubtful, marked, numbered, slices_of, without

SHINGLE, PERCENT = 5, 75
GROUP = 128
#: Text bytes behind one bucket of shingles, and shingles a task sends together.
BUCKET_BYTES, SEND = 4 << 20, 1 << 19
#: Text bytes hashed at once when shingles are sent.
SLICE = 1 << 18
#: A shingle in this share of the documents of a slice, and of half this share of all, is hot.
HOT_SHARE = 0.01
QUERIES = 512

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
FOLDED = TABLE.copy()
FOLDED[ord("A") : ord("Z") + 1] = TABLE[ord("a") : ord("z") + 1]
FACTORS = np.random.default_rng(5).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(buffer: np.ndarray, ends: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of the distinct shingles of each document of a buffer, in that order."""
    n = len(ends) - 1
    word = ~SEPARATOR[buffer]
    before = np.concatenate([[False], word[:-1]]) if len(word) else word
    inner = ends[1:-1][ends[1:-1] < len(word)]
    before[inner] = False
    begin = np.flatnonzero(word & ~before)
    after = np.concatenate([word[1:], [False]]) if len(word) else word
    after[inner[inner > 0] - 1] = False
    end = np.flatnonzero(word & ~after) + 1
    if not len(begin):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    hashes = ByteHash(buffer, FOLDED).span(begin, end)
    doc = np.searchsorted(ends, begin, "right") - 1
    words = np.bincount(doc, minlength=n)
    m = len(hashes) - size + 1
    docs, values = [], []
    if m > 0:
        value = hashes[:m] * FACTORS[0]
        for j in range(1, size):
            value += hashes[j : j + m] * FACTORS[j]
        whole = doc[:m] == doc[size - 1 :]
        docs.append(doc[:m][whole])
        values.append(mix(value[whole]))
    first = np.concatenate([[0], np.cumsum(words)])
    short = np.flatnonzero((words > 0) & (words < size))
    if len(short):
        value = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            there = words[short] > j
            value[there] += hashes[first[short[there]] + j] * FACTORS[j]
        docs.append(short)
        values.append(mix(value ^ words[short].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)))
    docs, values = np.concatenate(docs), np.concatenate(values)
    order = np.lexsort((values, docs))
    docs, values = docs[order], values[order]
    fresh = np.concatenate([[True], (docs[1:] != docs[:-1]) | (values[1:] != values[:-1])])
    return docs[fresh], values[fresh]


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of a set of n with any set it links with."""
    return -(-n * percent // 100)


def links(inter, a, b, percent: int):
    return 100 * inter >= percent * (a + b - inter)


def classes(docs: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """Stored (d, n, digest) of all documents, and the hot shingles (a bounded array)."""

    def sets(source):
        lean_worker()
        for batch, texts in text_batches(source, "text"):
            d = batch.column(0).to_pylist()
            doc, value = shingle_sets(*text_bytes(texts), size)
            n = np.bincount(doc, minlength=len(d))
            cut = np.concatenate([[0], np.cumsum(n)])
            digest = [
                hashlib.blake2b(value[a:b].tobytes(), digest_size=16).digest() if b > a else None
                for a, b in zip(cut, cut[1:], strict=False)
            ]
            frequent, times = np.unique(value, return_counts=True)
            often = times >= max(8, HOT_SHARE * len(d))
            k = int(often.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(d + [None] * k, pa.int64()),
                    pa.array(np.concatenate([n, times[often]])),
                    pa.array(digest + [None] * k, pa.binary()),
                    pa.array([None] * len(d) + frequent[often].view(np.int64).tolist(), pa.int64()),
                ],
                ["d", "n", "digest", "hot"],
            )

    found = stored(docs.select("d", "text").mapInArrow(sets, "d long, n long, digest binary, hot long"), "classes")
    table = found.where("d is not null").select("d", "n", "digest")
    total = table.count()
    hot = (
        found.where("hot is not null")
        .groupBy("hot")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= max(16, HOT_SHARE / 2 * total))
        .select("hot")
        .toPandas()["hot"]
    )
    return table, np.sort(hot.to_numpy(np.int64).view(np.uint64))


def shared_shingles(docs: DataFrame, copies: DataFrame, hot: np.ndarray, size: int, percent: int) -> DataFrame:
    """Stored (d, n, k, lead, t) of the classes that have enough shared shingles to link.

    t: shared shingles, rarest first; lead: how many of them lead; k: the least shingle hash.
    `copies` (d) are the documents of `docs` that a class is not named by; they are left out.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(partitions(spark), -(-total // BUCKET_BYTES))
    words = bit_map(copies)

    def sets(source):
        lean_worker()
        for batch, texts in text_batches(source, "text", SLICE):
            d = batch.column(0).to_numpy(zero_copy_only=False)
            doc, value = shingle_sets(*text_bytes(texts), size)
            yield value, d[doc], d, np.bincount(doc, minlength=len(d))

    def dealt(part):
        value, d, nd, nn = part
        part.clear()
        is_hot = np.isin(value, hot)
        out: dict[int, dict[str, bytes]] = {}

        def deal(bucket, **columns):
            order = np.argsort(bucket, kind="stable")
            for b, at in zip(*slices_of(bucket[order]), strict=True):
                out.setdefault(b, {}).update({c: x[order[at]].tobytes() for c, x in columns.items()})

        deal((value[~is_hot] % np.uint64(buckets)).astype(np.int64), t=value[~is_hot], d=d[~is_hot])
        deal((mix(nd.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64), nd=nd, nn=nn)
        home = (mix(d[is_hot].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        deal(home, ht=value[is_hot], hd=d[is_hot])
        names = ("t", "d", "nd", "nn", "ht", "hd")
        return pa.RecordBatch.from_arrays(
            [pa.array(list(out), pa.int32())]
            + [pa.array([r.get(c, b"") for r in out.values()], pa.binary()) for c in names],
            ["bucket", *names],
        )

    def send(source):
        for batch in map(dealt, gathered(sets(source), SEND)):
            yield from pieces(batch)
        give_back()

    def send_unmarked(source):
        yield from send(marked(source, words, False))

    def column(table, name, kind):
        return np.frombuffer(b"".join(table[name].to_pylist()), kind)

    def count(table):
        lean_worker()
        give_back()
        t, d = column(table, "t", "<u8"), column(table, "d", "<i8")
        order = np.argsort(t, kind="stable")
        t, d = t[order], d[order]
        at = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]])) if len(t) else np.zeros(0, np.int64)
        f = np.diff(np.concatenate([at, [len(t)]]))
        f = np.repeat(f, f).astype(np.uint32)
        t, d, f = t[f > 1], d[f > 1], f[f > 1]
        home = (mix(d.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        t, d, f = t[order], d[order], f[order]
        rows = [
            (b, t[at].tobytes(), d[at].tobytes(), f[at].tobytes(), b"", b"")
            for b, at in zip(*slices_of(home[order]), strict=True)
        ]
        ht, hd = column(table, "ht", "<u8"), column(table, "hd", "<i8")
        own = table["bucket"][0].as_py()
        last = np.full(len(ht), 0xFFFFFFFF, np.uint32)
        rows.append(
            (own, ht.tobytes(), hd.tobytes(), last.tobytes(), *(b"".join(table[c].to_pylist()) for c in ("nd", "nn")))
        )
        names = ("home", "t", "d", "f", "nd", "nn")
        kinds = (pa.int32(), *[pa.binary()] * 5)
        found = pa.record_batch({c: pa.array([r[i] for r in rows], kinds[i]) for i, c in enumerate(names)})
        return pa.Table.from_batches(list(pieces(found)))

    def gather(table):
        lean_worker()
        give_back()
        nd, nn = column(table, "nd", "<i8"), column(table, "nn", "<i8")
        t, d, f = column(table, "t", "<u8"), column(table, "d", "<i8"), column(table, "f", "<u4")
        order = np.lexsort((t, f, d))
        t, d = t[order], d[order]
        order = np.argsort(nd)
        nd, nn = nd[order], nn[order]
        got: dict[str, list] = {c: [] for c in ("d", "n", "k", "lead", "t")}
        for one, at in zip(*slices_of(d), strict=True):
            n = int(nn[np.searchsorted(nd, one)])
            share = t[at]
            need = int(needed(np.int64(n), percent))
            if len(share) >= need:
                got["d"].append(one)
                got["n"].append(n)
                got["k"].append(int(mix(share ^ np.uint64(0x1D8E4E27C47D124F)).min().view(np.int64)))
                got["lead"].append(len(share) - need + 1)
                got["t"].append(share.tobytes())
        kinds = {"d": pa.int64(), "n": pa.int64(), "k": pa.int64(), "lead": pa.int64(), "t": pa.binary()}
        return pa.table({c: pa.array(x, kinds[c]) for c, x in got.items()})

    binary = "t binary, d binary, nd binary, nn binary, ht binary, hd binary"
    schema = f"bucket int, {binary}"
    sent = docs.mapInArrow(send_unmarked, schema).unionByName(doubtful(docs, copies, words).mapInArrow(send, schema))
    counted = sent.groupBy("bucket").applyInArrow(
        count, "home int, t binary, d binary, f binary, nd binary, nn binary"
    )
    return stored(
        counted.groupBy("home").applyInArrow(gather, "d long, n long, k long, lead long, t binary"), "shared"
    )


EDGES = "a long, b long"


def group_links(percent: int):
    """All links inside one group, as a spanning forest."""

    def within(table):
        ids, at = np.unique(table["d"].to_numpy(), return_index=True)
        n = table["n"].to_numpy()[at]
        blobs = table["t"].to_pylist()
        sets = [np.frombuffer(blobs[i], "<u8") for i in at]
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        _, token, times = np.unique(flat, return_inverse=True, return_counts=True)
        twice = times[token] > 1
        token, owner = token[twice], owner[twice]
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        number = np.cumsum(np.concatenate([[0], token[1:] != token[:-1]])) if len(token) else token
        inter = np.zeros((len(sets), len(sets)), np.float64)
        width = 1 << 14
        for lo in range(0, int(number[-1]) + 1 if len(number) else 0, width):
            a, b = np.searchsorted(number, [lo, lo + width])
            block = np.zeros((len(sets), width), np.float32)
            block[owner[a:b], number[a:b] - lo] = 1
            inter += block @ block.T
        linked = links(inter, n[:, None], n[None, :], percent)
        label, edges = np.full(len(sets), -1), []
        for i in range(len(sets)):
            if label[i] >= 0:
                continue
            label[i], front = i, [i]
            while front:
                for j in np.flatnonzero(linked[front.pop()] & (label < 0)):
                    label[j] = i
                    edges.append((ids[i], ids[j]))
                    front.append(j)
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return within


def open_groups(percent: int):
    """Compare queries with the groups whose token union lets them reach the threshold."""

    def across(members, queries):
        lean_worker()
        give_back()
        m_ids, m_n, m_component = (members[c].to_numpy() for c in ("d", "n", "component"))
        sets = [np.frombuffer(x, "<u8") for x in members["t"].to_pylist()]
        edges = []
        if len(sets) and queries.num_rows:
            union, row = np.unique(np.concatenate(sets), return_inverse=True)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            order = np.argsort(row, kind="stable")
            owner = owner[order]
            begin = np.searchsorted(row[order], np.arange(len(union) + 1))
            for q, n, blob in zip(*(queries[c].to_pylist() for c in ("q", "q_n", "q_t")), strict=True):
                own = np.frombuffer(blob, "<u8")
                at = np.searchsorted(union, own)
                at = at[(at < len(union)) & (union[np.minimum(at, len(union) - 1)] == own)]
                if len(at) < needed(np.int64(n), percent):
                    continue
                size = begin[at + 1] - begin[at]
                places = np.arange(size.sum()) + np.repeat(begin[at] - np.cumsum(size) + size, size)
                inter = np.bincount(owner[places], minlength=len(sets))
                # One link to each component of the group says all.
                linked = np.flatnonzero(links(inter, n, m_n, percent) & (m_ids != q))
                _, first = np.unique(m_component[linked], return_index=True)
                edges += [(q, int(m_ids[j])) for j in linked[first]]
        return pa.table({"a": pa.array([e[0] for e in edges], pa.int64()), "b": pa.array([e[1] for e in edges], pa.int64())})

    return across


def leading(shared: DataFrame) -> DataFrame:
    """(t, d, n, rest): the leading shingles of every class; rest: its shared shingles from there on."""

    def lead(source):
        for batch in source:
            d, n, k, blobs = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("d", "n", "lead", "t"))
            sets = [np.frombuffer(x, "<i8")[:m] for x, m in zip(blobs, k, strict=True)]
            if sets:
                size = [len(s) for s in sets]
                rest = [len(x) // 8 - np.arange(m) for x, m in zip(blobs, size, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(sets)), pa.array(np.repeat(d, size)), pa.array(np.repeat(n, size))]
                    + [pa.array(np.concatenate(rest).astype(np.int64))],
                    ["t", "d", "n", "rest"],
                )

    return stored(shared.select("d", "n", "lead", "t").mapInArrow(lead, "t long, d long, n long, rest long"), "leading")


def cross_links(
    shared: DataFrame, matrix: DataFrame, component: DataFrame, members: DataFrame, percent: int
) -> DataFrame:
    """Links between components: queries meet the groups that share a leading shingle.

    The shingles have one order for all classes, so what two sets have in common lies at or after
    their first common shingle: its `rest` in both bounds the overlap, and a link of sets of a
    and b shingles needs percent * (a + b) / (100 + percent).

    `matrix` has (t, d, n, rest, g) of the leading shingles, `component` (d, component) of the
    linked classes, `members` (g, d, n, t) of the groups to open.
    """
    tokens = matrix.join(component, "d", "left").withColumn("component", F.coalesce("component", "d"))
    # Shingles of one passage are led by the same classes: of those with equal lists of
    # classes (128-bit signature and length) the first in the order, whose rests are the
    # longest, stands for all.
    lists = tokens.groupBy("t").agg(
        F.min("component").alias("x"),
        F.max("component").alias("y"),
        F.count("*").alias("size"),
        F.bit_xor(F.xxhash64("d")).alias("h1"),
        F.bit_xor(F.xxhash64("d", F.lit(1))).alias("h2"),
        F.sum("rest").alias("rests"),
    )
    several = lists.where("x <> y").groupBy("size", "h1", "h2").agg(F.max_by("t", F.struct("rests", "t")).alias("t")).select("t")
    tokens = stored(tokens.join(several, "t", "left_semi"), "matrix")
    unions = tokens.groupBy("t", "g", F.col("component").alias("other")).agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.max("rest").alias("longest")
    )
    met = tokens.select("t", "d", "n", "rest", "component").join(unions, "t").where(
        (F.col("component") != F.col("other"))
        & (100 * F.col("most") >= percent * F.col("n"))
        & (percent * F.col("least") <= 100 * F.col("n"))
        & (percent * (F.col("n") + F.col("least")) <= (100 + percent) * F.least("rest", "longest"))
    )
    pairs = stored(met.select("d", "g").distinct(), "pairs")
    # A group that many classes ask for is repeated, once for every QUERIES of them.
    slots = pairs.groupBy("g").agg(F.ceil(F.count("*") / QUERIES).cast("long").alias("slots"))
    asked = pairs.join(slots, "g").select("d", "g", F.pmod(F.xxhash64("d"), "slots").alias("slot"))
    asked = asked.join(shared.select("d", "n", "t"), "d").select(
        "g", "slot", F.col("d").alias("q"), F.col("n").alias("q_n"), F.col("t").alias("q_t")
    )
    placed = members.join(slots, "g").join(component, "d", "left")
    offered = placed.select(
        "d", "n", "t", F.coalesce("component", "d").alias("component"), "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot")
    )
    return (
        offered.groupBy("g", "slot").cogroup(asked.groupBy("g", "slot")).applyInArrow(open_groups(percent), EDGES)
    )


def class_components(shared: DataFrame, percent: int) -> DataFrame:
    """(d, component) of the classes that link with another."""
    keys = shared.groupBy("k").agg(F.count("*").alias("size"), F.min("d").alias("first"))
    placed = stored(
        shared.join(keys, "k").select(
            "d",
            "n",
            "t",
            "size",
            "k",
            "first",
            F.ceil(F.col("size") / GROUP).cast("long").alias("chunks"),
            F.pmod(F.xxhash64("d"), F.ceil(F.col("size") / GROUP).cast("long")).alias("chunk"),
        ),
        "groups",
    )
    several = placed.where("size > 1").select("k", "chunk", "d", "n", "t")
    tie = placed.where("d = first and chunks > 1").select(
        "k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), "d", "n", "t"
    )
    inside = stored(
        several.unionByName(tie).groupBy("k", "chunk").applyInArrow(group_links(percent), EDGES), "links"
    )
    component = connected(inside)
    lead = leading(shared)

    # First pass: one group for each component, of which only the first member is opened.
    known = lead.join(component, "d", "left")
    by_component = known.select("t", "d", "n", "rest", F.coalesce("component", "d").alias("g"))
    firsts = shared.join(component.where("d <> component"), "d", "left_anti").select(
        F.col("d").alias("g"), "d", "n", "t"
    )
    first_links = stored(cross_links(shared, by_component, component, firsts, percent), "links")
    component = connected(stars(component).unionByName(first_links))

    # Second pass: all groups.
    group = F.xxhash64("k", "chunk").alias("g")
    by_group = lead.join(placed.select("d", group), "d")
    members = placed.select(group, "d", "n", "t")
    rest = stored(cross_links(shared, by_group, component, members, percent), "links")
    return connected(stars(component).unionByName(rest))


def stars(component: DataFrame) -> DataFrame:
    """The components so far as edges, one for each class."""
    return component.where("d <> component").select(F.col("d").alias("a"), F.col("component").alias("b"))


def with_components(rows: DataFrame, unique: bool, size: int, percent: int) -> DataFrame:
    """(d, n_shingles, component): for each d of `rows` (d, text) the smallest d of its component."""
    texts = rows.select("d", "text")
    texts = texts if unique else texts.dropDuplicates(["d"])
    table, hot = classes(texts, size)
    named = (
        table.where("digest is not null").groupBy("digest").agg(F.min("d").alias("first"), F.count("*").alias("copies"))
    )
    copies = stored(
        table.join(named.where("copies > 1"), "digest").where("d <> first").select("d", "first"), "copies"
    )
    shared = shared_shingles(texts, copies, hot, size, percent)
    component = class_components(shared, percent).select(F.col("d").alias("first"), "component")
    found = (
        table.select("d", F.col("n").alias("n_shingles"))
        .join(copies, "d", "left")
        .withColumn("first", F.coalesce("first", "d"))
        .join(component, "first", "left")
        .select("d", "n_shingles", F.coalesce("component", "first").alias("component"))
    )
    return stored(found, "components")


def near_duplicates(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """`docs` without the text, with n_shingles and component_id."""
    kept = [c for c in docs.columns if c not in (text, "n_shingles", "component_id")]
    base = docs.select(F.struct(*kept).alias("row"), F.col(id_column).alias("_doc"), F.col(text).alias("text"))
    rows, unique = numbered(base, "text", "_doc")
    found = with_components(rows, unique, size, percent)
    if unique:
        component = F.col("component").alias("component_id")
        return rows.select("row", "d").join(found, "d").select("row.*", "n_shingles", component)
    ids = rows.select(F.col("d").alias("component"), F.col("_doc").alias("component_id")).dropDuplicates(["component"])
    return (
        rows.select("row", "d").join(found, "d").join(ids, "component").select("row.*", "n_shingles", "component_id")
    )


def first_documents(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """The first row of each component, with all columns of `docs`; rows that link with nothing stay."""
    base = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_column).alias("_doc"), F.col(text).alias("text"))
    rows, unique = numbered(base, "text", "_doc")
    found = with_components(rows, unique, size, percent)
    later = stored(found.where("d <> component").select("d"), "later")
    kept = without(rows.select("row", "d"), later)
    return (kept if unique else kept.dropDuplicates(["d"])).select("row.*")
