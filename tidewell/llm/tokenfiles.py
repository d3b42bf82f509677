"""Token ids in files of fixed-width bit packing.

Rows are dealt by ranges of doc_id, so each task encodes its range in order and writes one
shard, under a name of its own attempt that it then moves to its final name: a repeated or
speculative task writes the same bytes again. A table of shards (rows, ids, path) is stored
beside them. Nothing but one row per shard is summed up over shards.

File: blocks of BLOCK ids, each id in the fewest bits that hold the vocabulary, low bits
first, each block on a byte boundary; then, little-endian, the byte offset of each block
and the end (u64), the first id of each document and the end (u64), doc ids (i64), one byte
per document that is 1 for a null doc_id, and a footer (see FOOTER). Any document is read by
unpacking only the blocks it touches.

Defined cases: null and empty texts are one end id. Null doc ids come first. Rows of equal
doc_id are all written, ordered by text. An empty table writes files without documents.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh_dir, partitions, stored, text_batches
from .tokens import encoder, tokenizer_path

BLOCK = 4096
END_ID = 1
#: magic, bits of an id, ids of a block, ids, documents, blocks, place of the block offsets
FOOTER = "<8sIIQQQQ"
MAGIC = b"TWPACK01"
#: Widths of whole bytes, which need no single bits.
WHOLE = {8: "u1", 16: "<u2", 32: "<u4"}


def width(vocabulary: int) -> int:
    """Bits that hold every id below `vocabulary`."""
    return max(1, (max(2, vocabulary) - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in WHOLE:
        return ids.astype(WHOLE[bits]).tobytes()
    rows = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    return np.packbits(np.unpackbits(rows, axis=1, bitorder="little")[:, :bits], bitorder="little").tobytes()


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    if bits in WHOLE:
        return np.frombuffer(data, WHOLE[bits], n).astype("<u4")
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits, bitorder="little").reshape(n, bits)
    wide = np.zeros((n, 32), np.uint8)
    wide[:, :bits] = flat
    return np.packbits(wide, axis=1, bitorder="little").view("<u4").reshape(-1)


class Writer:
    """Writes one shard as ids come; keeps a block, the offsets and the document table."""

    def __init__(self, out, bits: int):
        self.out, self.bits = out, bits
        self.rest = np.zeros(0, np.uint32)
        self.offsets, self.starts, self.doc_ids = [0], [0], []

    def add(self, ids: np.ndarray, counts: np.ndarray, doc_ids: list) -> None:
        self.starts.extend((self.starts[-1] + np.cumsum(counts)).tolist())
        self.doc_ids.extend(doc_ids)
        ids = np.concatenate([self.rest, ids])
        whole = len(ids) - len(ids) % BLOCK
        for lo in range(0, whole, BLOCK):
            self.block(ids[lo : lo + BLOCK])
        self.rest = ids[whole:]

    def block(self, ids: np.ndarray) -> None:
        data = pack_bits(ids, self.bits)
        self.out.write(data)
        self.offsets.append(self.offsets[-1] + len(data))

    def close(self) -> None:
        if len(self.rest):
            self.block(self.rest)
        none = [x is None for x in self.doc_ids]
        self.out.write(np.array(self.offsets, "<u8").tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(np.array([x or 0 for x in self.doc_ids], "<i8").tobytes())
        self.out.write(np.array(none, np.uint8).tobytes())
        self.out.write(
            struct.pack(
                FOOTER, MAGIC, self.bits, BLOCK, self.starts[-1], len(self.doc_ids), len(self.offsets) - 1, self.offsets[-1]
            )
        )


class Reader:
    """Random access to one shard."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        magic, self.bits, self.block, self.n_ids, self.n_docs, blocks, at = struct.unpack(
            FOOTER, source.read_at(struct.calcsize(FOOTER), size - struct.calcsize(FOOTER))
        )
        if magic != MAGIC:
            raise ValueError("not a packed token file")
        parts = [(blocks + 1, "<u8"), (self.n_docs + 1, "<u8"), (self.n_docs, "<i8"), (self.n_docs, "u1")]
        read = []
        for n, kind in parts:
            length = n * np.dtype(kind).itemsize
            read.append(np.frombuffer(source.read_at(length, at), kind))
            at += length
        self.offsets, self.starts, self.doc_ids, self.null_ids = read

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo..hi of the shard, from the blocks they lie in."""
        if hi <= lo:
            return np.zeros(0, np.uint32)
        first, last = lo // self.block, -(-hi // self.block)
        begin = int(self.offsets[first])
        data = self.source.read_at(int(self.offsets[last]) - begin, begin)
        if self.block * self.bits % 8 == 0:  # then blocks follow each other without a gap
            got = unpack_bits(data, min(last * self.block, self.n_ids) - first * self.block, self.bits)
        else:
            cut = self.offsets[first : last + 1].astype(np.int64) - begin
            ends = np.minimum(np.arange(first + 1, last + 1) * self.block, self.n_ids)
            got = np.concatenate(
                [
                    unpack_bits(data[a:b], int(e) - k * self.block, self.bits)
                    for k, a, b, e in zip(range(first, last), cut, cut[1:], ends, strict=False)
                ]
            )
        return got[lo - first * self.block : hi - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def file_system(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def write_tokens(
    docs: DataFrame,
    folder: str | None = None,
    id_column: str = "doc_id",
    text: str = "text",
    path: str | None = None,
) -> DataFrame:
    """Write shards in ascending id order; the stored table (shard, path, n_docs, n_ids, bits)."""
    spark = docs.sparkSession
    folder = folder or fresh_dir(spark, "tokens")
    path = path or tokenizer_path()
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ranged = rows.repartitionByRange(partitions(spark), "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        shard = task.partitionId()
        files, root = file_system(folder)
        files.create_dir(root, recursive=True)
        final = f"{root}/shard-{shard:06d}.twp"
        own = f"{final}.{task.taskAttemptId()}"
        enc = encoder(path)
        with files.open_output_stream(own) as out:
            writer = Writer(out, width(enc.vocabulary))
            for batch, texts in text_batches(batches, "text", encode=True):
                ids, counts = enc.encode(texts.to_pylist())
                ids = np.insert(ids, np.cumsum(counts), np.uint32(END_ID))
                writer.add(ids, counts + 1, batch.column(0).to_pylist())
            writer.close()
        files.move(own, final)
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "shard": shard,
                    "path": f"{folder}/shard-{shard:06d}.twp",
                    "n_docs": len(writer.doc_ids),
                    "n_ids": writer.starts[-1],
                    "bits": writer.bits,
                }
            ]
        )

    schema = "shard long, path string, n_docs long, n_ids long, bits long"
    return stored(ranged.mapInArrow(write, schema), "shards")


def read_documents(shards: DataFrame, run: int = 1 << 19) -> DataFrame:
    """Read the shards back: doc_id, start (ids before it), n_tokens, ids_crc32."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    based = shards.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0).cast("long")))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                files, place = file_system(row["path"])
                with files.open_input_file(place) as source:
                    reader = Reader(source)
                    starts, lo = reader.starts.astype(np.int64), 0
                    while lo < reader.n_docs:
                        # Documents of about `run` ids, or one longer document, at a time.
                        hi = max(lo + 1, int(np.searchsorted(starts, starts[lo] + run, "right")) - 1)
                        ids = reader.ids(int(starts[lo]), int(starts[hi])).astype("<u4")
                        cut = starts[lo : hi + 1] - starts[lo]
                        crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cut, cut[1:], strict=False)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(reader.doc_ids[lo:hi], mask=reader.null_ids[lo:hi].astype(bool)),
                                pa.array(starts[lo:hi] + row["base"]),
                                pa.array(np.diff(cut)),
                                pa.array(crc, pa.int64()),
                            ],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )
                        lo = hi

    dealt = based.select("shard", "path", "base").repartition(partitions(shards.sparkSession), "shard")
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
