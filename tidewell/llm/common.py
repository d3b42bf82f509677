"""What the operators of this package share: the shared folder, words, slices of batches.

Nothing here or in the operators collects rows that grow with the input, and nothing is
written to a folder that only one machine sees.
"""

from __future__ import annotations

import contextlib
import ctypes
import sys
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: What separates words of letters, digits and non-ASCII characters (before lower-casing).
NOT_IN_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What separates words at white space only.
WHITE_SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only a session of one machine may do without it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not path and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not path:
        path = context.getCheckpointDir() or tempfile.mkdtemp(prefix="tidewell-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return path


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name for one table or set of files in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


MAX_RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Fewer rows in an Arrow batch while a job runs: whole texts may be long."""
    before = spark.conf.get(MAX_RECORDS)
    spark.conf.set(MAX_RECORDS, rows)
    try:
        yield
    finally:
        spark.conf.set(MAX_RECORDS, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as a table in the shared folder and read back: its lineage ends there."""
    path = fresh_dir(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, for small tables of iterations."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, all other letters as they are."""
    plain = F.octet_length(c) == F.length(c)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def split_words(text: Column, separators: str) -> Column:
    """The words of a text in order, none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def text_batches(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20, encode: bool = False):
    """Slices of Arrow batches of at most `limit` text bytes (or one row), null texts empty.

    Gives (slice, texts): the texts as a binary-compatible string array. A worker that goes on to
    other work than to encode texts drops the encoder it has kept.
    """
    worker = sys.modules.get("_tidewell_worker")
    if worker and not encode and worker.__dict__.pop("encoders", None):
        give_back()
    for batch in batches:
        texts = pc.fill_null(batch.column(column), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        lo = 0
        while lo < batch.num_rows:
            base = sizes[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(sizes, base + limit, "right")))
            yield batch.slice(lo, hi - lo), texts.slice(lo, hi - lo)
            lo = hi
    if worker := sys.modules.get("_tidewell_worker"):
        worker.__dict__.pop("powers", None)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers live on and share the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: Of glibc's mallopt: blocks from so many bytes are mapped alone; so many free bytes stay on
#: top of the heap, for the arrays of one slice of text after another.
M_TRIM_THRESHOLD, M_MMAP_THRESHOLD, MAPPED, ON_TOP = -1, -3, 4 << 20, 32 << 20


def lean_worker() -> None:
    """Large arrays of this worker go back to the system as soon as they are freed.

    By default the first large array that is freed raises the limit up to which arrays come
    from the heap of the process, and an idle worker keeps what its last task took there.
    """
    set_option = getattr(ctypes.CDLL(None), "mallopt", None)
    if set_option:
        set_option(M_MMAP_THRESHOLD, MAPPED)
        set_option(M_TRIM_THRESHOLD, ON_TOP)


def pieces(batch: pa.RecordBatch, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """An Arrow batch in slices of about `limit` bytes (or one row): the JVM takes each as one block."""
    rows = max(1, batch.num_rows * limit // max(1, batch.nbytes))
    for lo in range(0, batch.num_rows, rows):
        yield batch.slice(lo, rows)


def gathered(parts: Iterator[tuple[np.ndarray, ...]], limit: int) -> Iterator[list[np.ndarray]]:
    """Tuples of arrays joined until their first arrays hold `limit` values."""
    held: list[tuple[np.ndarray, ...]] = []

    def joined() -> list[np.ndarray]:
        out = [np.concatenate(x) for x in zip(*held, strict=True)]
        held.clear()
        return out

    size = 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        del part
        if size >= limit:
            # Nothing here refers to what is given, or to its parts, while it is in use.
            yield joined()
            size = 0
    if held:
        yield joined()


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string array without nulls one after another, and the n + 1 offsets."""
    _, offsets, data = texts.buffers()
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(ends):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]
