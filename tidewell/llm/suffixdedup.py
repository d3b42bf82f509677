"""Exact removal of repeated byte strings with a logarithmic family of suffix arrays.

A string of LENGTH bytes that starts earlier as well (smaller doc_id, or the same document
further left) marks all its bytes for removal.

Sampled suffixes. Of the hashes of GRAM bytes inside a LENGTH-byte window the least one
(leftmost on ties) is the window's anchor. It depends on the window's bytes only, so equal
windows have equal anchors at equal places, and all windows of a stretch share one anchor:
one entry stands for about 35 windows. An entry is (k: fingerprint of the anchor's first
GRAM bytes, c: fingerprint of the whole context that its windows span, document, place).

Index. Entries are dealt over buckets by k. In a bucket they arrive in batches of rising
documents. A batch is sorted into a suffix array by (k, c) and merge-scanned against the
levels of the family: a context that is there already, or earlier in the batch, is a long
match and all its bytes go. New contexts become the smallest level, and levels of similar
size merge, so an entry is rewritten a logarithmic number of times. `index` keeps the levels
of a bucket as a file, and a later run with more (higher) doc ids goes on from it, with the
number of buckets of the first run.

Edges. Contexts that differ but have the same k agree in part: at ends of passages and
around edits. Only for these, single windows are hashed (64 bits) and the first of each
kept. Equal contexts of one slice of a task are combined before the shuffle, so a passage of
a third of all documents sends one entry per slice, not one per document.

Texts are shuffled only for documents in question: a bit map of bounded size (FILTER_BITS)
lets the others pass by; where it fills up it filters less and results stay the same.

Defined cases: a null text is empty; texts shorter than LENGTH lose nothing. A null doc_id
comes before all others. Rows of equal id and text are one document with one result (it is
not compared with itself); rows of equal id and other text are ordered by a hash of the
text. Input columns named like an output are replaced. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import ByteHash, least_ahead, mix
from .common import gathered, give_back, lean_worker, partitions, pieces, stored, text_batches, text_bytes
from .rows import bit_map, marked, numbered, only, slices_of

LENGTH, GRAM = 100, 32
BATCHES = 8
#: Text bytes behind one bucket of the index, and entries or windows a task sends together.
BUCKET_BYTES, SEND = 4 << 20, 1 << 19
#: Text bytes hashed at once: an array has 8 bytes for each.
SLICE = 1 << 18
ENTRY = np.dtype([("z", "<u8"), ("y", "<u4"), ("n", "u1"), ("edge", "?"), ("d", "<i8"), ("lo", "<u4")])


def sampled(buffer: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """Entries of the documents of a buffer: doc, lo, n (last window - first), k, c."""
    none = np.zeros(0, np.int64)
    if len(buffer) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = ByteHash(buffer)
    grams = hashes.windows(gram)
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (least_ahead(key, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    doc = np.repeat(np.arange(len(ends) - 1), np.diff(ends))[: len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + length <= ends[doc + 1])
    if not len(start):
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    anchor, doc = anchor[start], doc[start]
    head = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    lo, hi = start[head], start[np.concatenate([head[1:], [len(start)]]) - 1]
    anchor, doc = anchor[head], doc[head]
    k = mix(grams[anchor] ^ np.uint64(0x5851F42D4C957F2D))
    shape = ((anchor - lo) * 256 + (hi - lo)).astype(np.uint64)
    c = mix(hashes.span(lo, hi + length) + shape * np.uint64(0xD6E8FEB86659FD93))
    return doc, lo - ends[doc], hi - lo, k, c


@dataclass
class Family:
    """The levels of one bucket, each sorted by (z, y) without repeated contexts."""

    levels: list[np.ndarray]

    def scan(self, batch: np.ndarray) -> np.ndarray:
        """Which entries of a sorted batch are in a level; marks edges on both sides."""
        known = np.zeros(len(batch), bool)
        for level in self.levels:
            at = np.searchsorted(level["z"], batch["z"], "left")
            upto = np.searchsorted(level["z"], batch["z"], "right")
            some = np.flatnonzero(upto > at)
            known[some] |= level["y"][at[some]] == batch["y"][some]
            for i in some[(upto[some] - at[some] > 1) & ~known[some]]:
                known[i] = bool((level["y"][at[i] : upto[i]] == batch["y"][i]).any())
        fresh = np.flatnonzero(~known)
        base = batch["z"][fresh] & np.uint64(0xFFFFFFFF00000000)
        for level in self.levels:
            at = np.searchsorted(level["z"], base, "left")
            upto = np.searchsorted(level["z"], base | np.uint64(0xFFFFFFFF), "right")
            near = upto > at
            batch["edge"][fresh[near]] = True
            marks = np.zeros(len(level) + 1, np.int64)
            np.add.at(marks, at[near], 1)
            np.add.at(marks, upto[near], -1)
            level["edge"] |= np.cumsum(marks)[:-1] > 0
        return known

    def add(self, batch: np.ndarray) -> None:
        """A new smallest level; levels of similar size merge."""
        if len(batch):
            self.levels.append(batch)
        while len(self.levels) > 1 and 2 * len(self.levels[-1]) > len(self.levels[-2]):
            last = np.concatenate([self.levels.pop(), self.levels.pop()])
            self.levels.append(last[np.lexsort((last["y"], last["z"]))])


def in_order(rows: np.ndarray) -> np.ndarray:
    return rows[np.lexsort((rows["lo"], rows["d"], rows["y"], rows["z"]))]


def first_of(rows: np.ndarray) -> np.ndarray:
    """True for the first entry of each context of sorted rows."""
    if not len(rows):
        return np.zeros(0, bool)
    return np.concatenate([[True], (rows["z"][1:] != rows["z"][:-1]) | (rows["y"][1:] != rows["y"][:-1])])


def dedup_bucket(rows: np.ndarray, family: Family, batches: int) -> tuple[np.ndarray, np.ndarray]:
    """Feed the entries of a bucket to its family in batches: removed entries, edge entries."""
    gone = []
    rows = rows[np.lexsort((rows["lo"], rows["d"]))]
    for batch in np.array_split(rows, batches):
        if not len(batch):
            continue
        batch = in_order(batch)
        first = first_of(batch)
        gone.append(batch[~first])
        batch = batch[first]
        known = family.scan(batch)
        gone.append(batch[known])
        batch = batch[~known]
        k = batch["z"] >> np.uint64(32)
        same = np.concatenate([[False], k[1:] == k[:-1]])
        batch["edge"] |= same | np.concatenate([same[1:], [False]])
        family.add(batch)
    edges = [level[level["edge"]] for level in family.levels]
    none = np.zeros(0, ENTRY)
    return np.concatenate([none, *gone]), np.concatenate([none, *edges])


def index_version(index: str) -> int:
    """The newest version of an index folder, 0 where there is none yet."""
    files, root = pyarrow.fs.FileSystem.from_uri(index)
    found = files.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True))
    names = [x.base_name for x in found]
    return max((int(x[9:15]) for x in names if x.startswith("manifest-") and x.endswith(".json")), default=0)


def read_manifest(index: str, version: int) -> dict | None:
    """What a version was made with (buckets, length, gram) and its folders of levels, newest last."""
    if not version:
        return None
    files, root = pyarrow.fs.FileSystem.from_uri(index)
    with files.open_input_stream(f"{root}/manifest-{version:06d}.json") as f:
        return json.loads(f.read())


def write_manifest(index: str, manifest: dict) -> None:
    files, root = pyarrow.fs.FileSystem.from_uri(index)
    files.create_dir(root, recursive=True)
    path = f"{root}/manifest-{index_version(index) + 1:06d}.json"
    with files.open_output_stream(f"{path}.new") as f:
        f.write(json.dumps(manifest).encode())
    files.move(f"{path}.new", path)


def load_family(index: str, folders: list[str], bucket: int) -> Family:
    """The levels of a bucket from the newest of the folders that has it."""
    files, root = pyarrow.fs.FileSystem.from_uri(index)
    for folder in reversed(folders):
        path = f"{root}/{folder}/bucket-{bucket:06d}.npy"
        if files.get_file_info(path).type == pyarrow.fs.FileType.File:
            with files.open_input_stream(path) as f:
                rows = np.frombuffer(f.read(), ENTRY).copy()
            cut = np.flatnonzero(rows["d"] == np.iinfo(np.int64).max)  # a row between levels
            return Family([x[:-1] for x in np.split(rows, cut + 1)[:-1]])
    return Family([])


def save_family(index: str, folder: str, bucket: int, family: Family, attempt: int) -> None:
    """The levels of a bucket as a file; what an earlier attempt of the task left stays."""
    files, root = pyarrow.fs.FileSystem.from_uri(index)
    files.create_dir(f"{root}/{folder}", recursive=True)
    path = f"{root}/{folder}/bucket-{bucket:06d}.npy"
    if files.get_file_info(path).type == pyarrow.fs.FileType.File:
        return
    mark = np.zeros(1, ENTRY)
    mark["d"] = np.iinfo(np.int64).max
    with files.open_output_stream(f"{path}.{attempt}") as f:
        for level in family.levels:
            f.write(level.tobytes() + mark.tobytes())
    files.move(f"{path}.{attempt}", path)


def repeated_strings(
    docs: DataFrame,
    length: int = LENGTH,
    gram: int = GRAM,
    batches: int = BATCHES,
    index: str | None = None,
    indexed: DataFrame | None = None,
    version: int | None = None,
) -> DataFrame:
    """(d, a, b): stretches of bytes to remove, stored. `docs` has d and text, each d once.

    `index` is a folder for the levels; a run that goes on from it gives the documents that
    are in it as `indexed` (d, text), and all numbers of `docs` must be above theirs. The
    number of buckets is that of the first run. A run reads the levels of `version` (the
    newest if None) and writes its own to a new folder, which counts as a version once all
    stretches are stored; so a repeated task never meets its own entries. To repeat a whole
    run, give the version that it went on from.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    buckets = max(partitions(spark), -(-size // BUCKET_BYTES))
    folders, folder = [], f"levels-{uuid.uuid4().hex}"
    if index:
        before = read_manifest(index, index_version(index) if version is None else version)
        if before:
            if (before["length"], before["gram"]) != (length, gram):
                raise ValueError(f"the index has length {before['length']} and gram {before['gram']}")
            buckets, folders = before["buckets"], before["folders"]

    def sample(source):
        lean_worker()
        for batch, texts in text_batches(source, "text", SLICE):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            doc, lo, n, k, c = sampled(*text_bytes(texts), length, gram)
            rows = np.zeros(len(doc), ENTRY)
            rows["z"] = (k << np.uint64(32)) | (c >> np.uint64(32))
            rows["y"] = c & np.uint64(0xFFFFFFFF)
            rows["n"], rows["d"], rows["lo"] = n, ids[doc], lo
            yield rows, ((k >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)

    def dealt(part):
        rows, bucket = part
        part.clear()
        order = np.lexsort((rows["lo"], rows["d"], rows["y"], rows["z"], bucket))
        rows, bucket = rows[order], bucket[order]
        # Of equal contexts at hand only the first is sent as an entry.
        first = first_of(rows)
        out = []
        for b, at in zip(*slices_of(bucket), strict=True):
            mine, gone = rows[at][first[at]], rows[at][~first[at]]
            out.append((b, *columns_of(mine), *(gone[x].tobytes() for x in ("d", "lo", "n"))))
        return pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32())]
            + [pa.array([o[i] for o in out], pa.binary()) for i in range(1, 9)],
            ["bucket", "z", "y", "n", "d", "lo", "gd", "glo", "gn"],
        )

    def entries(source):
        for batch in map(dealt, gathered(sample(source), SEND)):
            yield from pieces(batch)
        give_back()

    def fold(table):
        lean_worker()
        give_back()
        from pyspark import TaskContext

        bucket = table["bucket"][0].as_py()
        joined = {x: np.frombuffer(b"".join(table[x].to_pylist()), t) for x, t in (
            ("z", "<u8"), ("y", "<u4"), ("n", "u1"), ("d", "<i8"), ("lo", "<u4"), ("gd", "<i8"), ("glo", "<u4"), ("gn", "u1")
        )}
        rows = np.zeros(len(joined["z"]), ENTRY)
        for x in ("z", "y", "n", "d", "lo"):
            rows[x] = joined[x]
        family = load_family(index, folders, bucket) if index else Family([])
        gone, edges = dedup_bucket(rows, family, batches)
        if index:
            save_family(index, folder, bucket, family, TaskContext.get().taskAttemptId())
        d = np.concatenate([joined["gd"], gone["d"], edges["d"]])
        a = np.concatenate([joined["glo"], gone["lo"], edges["lo"]]).astype(np.int64)
        b = a + np.concatenate([joined["gn"], gone["n"], edges["n"]]).astype(np.int64) + length
        edge = np.arange(len(d)) >= len(d) - len(edges)
        return pa.table({"d": d, "a": a, "b": b, "edge": edge})

    sent = docs.select("d", "text").mapInArrow(
        entries,
        "bucket int, z binary, y binary, n binary, d binary, lo binary, gd binary, glo binary, gn binary",
    )
    found = stored(
        sent.groupBy("bucket").applyInArrow(fold, "d long, a long, b long, edge boolean"), "contexts"
    )

    # Windows of the contexts that agree with others in part.
    edges = found.where("edge").groupBy("d").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    edges = stored(edges, "edges")
    texts = docs.select("d", "text")
    if indexed is not None:
        texts = texts.unionByName(indexed.select("d", "text"))
    near = only(texts, bit_map(edges), True).join(edges, "d")

    def hashed(source):
        lean_worker()
        for batch, texts in text_batches(source, "text", SLICE):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            buffer, ends = text_bytes(texts)
            spans = batch.column(batch.schema.get_field_index("spans"))
            doc = np.repeat(np.arange(len(ids)), spans.value_lengths().to_numpy(zero_copy_only=False))
            a = spans.flatten().field(0).to_numpy(zero_copy_only=False)
            n = spans.flatten().field(1).to_numpy(zero_copy_only=False) - a - length + 1
            s = np.repeat(a, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            doc = np.repeat(doc, n)
            at = s + ends[doc]
            yield ByteHash(buffer).span(at, at + length), ids[doc], s.astype(np.uint32)

    def dealt_windows(part):
        h, d, s = part
        part.clear()
        bucket = (mix(h) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((s, d, h, bucket))
        h, d, s, bucket = h[order], d[order], s[order], bucket[order]
        first = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.zeros(0, bool)
        out = []
        for b, at in zip(*slices_of(bucket), strict=True):
            head = first[at]
            out.append((b, *(x[at][head].tobytes() for x in (h, d, s)), *(x[at][~head].tobytes() for x in (d, s))))
        return pa.RecordBatch.from_arrays(
            [pa.array([o[0] for o in out], pa.int32())]
            + [pa.array([o[i] for o in out], pa.binary()) for i in range(1, 6)],
            ["bucket", "h", "d", "s", "gd", "gs"],
        )

    def windows(source):
        for batch in map(dealt_windows, gathered(hashed(source), SEND)):
            yield from pieces(batch)
        give_back()

    def repeats(table):
        lean_worker()
        give_back()
        h, d, s, gd, gs = (
            np.frombuffer(b"".join(table[x].to_pylist()), t)
            for x, t in (("h", "<u8"), ("d", "<i8"), ("s", "<u4"), ("gd", "<i8"), ("gs", "<u4"))
        )
        order = np.lexsort((s, d, h))
        h, d, s = h[order], d[order], s[order]
        again = np.concatenate([[False], h[1:] == h[:-1]])
        d, s = np.concatenate([d[again], gd]), np.concatenate([s[again], gs]).astype(np.int64)
        # Neighbouring windows of one document in this bucket are one stretch.
        order = np.lexsort((s, d))
        d, s = d[order], s[order]
        head = np.concatenate([[True], (d[1:] != d[:-1]) | (s[1:] - s[:-1] > length)]) if len(d) else np.zeros(0, bool)
        at = np.flatnonzero(head)
        last = np.concatenate([at[1:], [len(d)]]) - 1 if len(d) else at
        return pa.table({"d": d[at], "a": s[at], "b": s[last] + length})

    sent = near.select("d", "text", "spans").mapInArrow(
        windows, "bucket int, h binary, d binary, s binary, gd binary, gs binary"
    )
    single = sent.groupBy("bucket").applyInArrow(repeats, "d long, a long, b long")
    stretches = stored(found.where("not edge").select("d", "a", "b").unionByName(single), "stretches")
    if index:
        write_manifest(
            index, {"buckets": buckets, "length": length, "gram": gram, "folders": [*folders, folder]}
        )
    return stretches


def columns_of(rows: np.ndarray) -> tuple[bytes, ...]:
    return tuple(np.ascontiguousarray(rows[x]).tobytes() for x in ("z", "y", "n", "d", "lo"))


def merged(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of stretches; stretches that touch are one run."""
    if not len(a):
        return a, b
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    head = np.concatenate([[True], a[1:] > b[:-1]])
    at = np.flatnonzero(head)
    return a[at], b[np.concatenate([at[1:], [len(a)]]) - 1]


def cut(data: bytes, a: np.ndarray, b: np.ndarray) -> bytes:
    keep, at = [], 0
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        keep.append(data[at:x])
        at = y
    return b"".join([*keep, data[at:]])


OUTPUTS = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


def deduplicate(
    docs: DataFrame,
    length: int = LENGTH,
    text: str = "text",
    id_column: str = "doc_id",
    keep_text: bool = True,
    index: str | None = None,
    indexed: DataFrame | None = None,
    version: int | None = None,
) -> DataFrame:
    """`docs` with n_bytes, n_removed, n_spans, kept_sha256 (of the remaining bytes), and, if
    `keep_text`, kept: the remaining bytes as text, without characters that a cut has split.
    The text itself is not returned.

    With `index`, `indexed` and `version` (see repeated_strings) the documents come after all
    those of earlier runs, given as `indexed` with the same id and text columns. Then ids must
    be unique whole numbers, not null, and above those of `indexed`."""
    base = docs.select(
        F.struct(*[c for c in docs.columns if c != text and c not in OUTPUTS]).alias("row"),
        F.col(id_column).alias("_doc"),
        F.col(text).alias("text"),
    )
    rows, unique = numbered(base, "text", "_doc")
    rows = rows.drop("_doc")
    if index and not unique:
        raise ValueError("an index needs ids that are unique and not null")
    if indexed is not None:
        if not index:
            raise ValueError("indexed is given without an index")
        indexed = indexed.select(F.col(id_column).cast("long").alias("d"), F.col(text).alias("text"))
        last, first = indexed.agg(F.max("d")).head()[0], rows.agg(F.min("d")).head()[0]
        if None not in (last, first) and first <= last:
            raise ValueError("ids must be above those of the index")
    texts = rows.select("d", "text")
    stretches = repeated_strings(texts if unique else texts.dropDuplicates(["d"]), length, index=index, indexed=indexed, version=version)
    lists = stored(stretches.groupBy("d").agg(F.collect_list(F.struct("a", "b")).alias("spans")), "spans")
    words = bit_map(lists)

    names = OUTPUTS if keep_text else OUTPUTS[:-1]
    kinds = dict(zip(OUTPUTS, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))

    def finish(source):
        lean_worker()
        for batch, texts in text_batches(source, "text"):
            spans_at = batch.schema.get_field_index("spans")
            if spans_at >= 0:
                spans = batch.column(spans_at)
                size = np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                both = [spans.flatten().field(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            else:
                size, both = np.zeros(batch.num_rows, np.int64), [np.zeros(0, np.int64)] * 2
            ends = np.cumsum(size)
            out: dict[str, list] = {c: [] for c in names}
            for x, lo, hi in zip(texts.to_pylist(), ends - size, ends, strict=True):
                data = x.encode()
                a, b = merged(both[0][lo:hi], both[1][lo:hi])
                kept = cut(data, a, b) if len(a) else data
                out["n_bytes"].append(len(data))
                out["n_removed"].append(len(data) - len(kept))
                out["n_spans"].append(len(a))
                out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                if keep_text:
                    out["kept"].append(kept.decode(errors="ignore"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("row"))] + [pa.array(out[c], kinds[c]) for c in names],
                ["row", *names],
            )

    def finish_untouched(source):
        yield from finish(marked(source, words, False))

    schema = f"row {rows.schema['row'].dataType.simpleString()}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept string" if keep_text else ""
    whole = rows.mapInArrow(finish_untouched, schema)
    touched = only(rows, words, True).join(lists, "d", "left").mapInArrow(finish, schema)
    return whole.unionByName(touched).select("row.*", *names)
