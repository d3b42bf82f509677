"""What Python workers keep: executors share one limit with them from stage to stage."""

import subprocess
import sys
import weakref

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidewell.llm import bytehash
from tidewell.llm.common import MAX_RECORDS, gathered, pieces, text_batches

FREED = """
import re, numpy as np
from tidewell.llm.common import lean_worker
def held():
    return int(re.search(r"VmRSS:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
{call}
np.ones(1 << 21)  # freed at once: by default such sizes come from the heap from now on
arrays = [np.ones(1 << 20) for _ in range(10)]
full, last = held(), arrays.pop()
del arrays
print(full - held())
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="mallopt of glibc")
def test_a_lean_worker_returns_large_arrays_below_one_that_it_keeps():
    def freed(call):
        return int(subprocess.run([sys.executable, "-c", FREED.format(call=call)], capture_output=True, text=True, check=True).stdout)

    assert freed("lean_worker()") > 60 > freed("")


def test_gathered_keeps_no_part_while_the_joined_arrays_are_in_use():
    seen = []

    def parts():
        for i in range(5):
            a = np.arange(4) + i
            seen.append(weakref.ref(a))
            yield a, a * 2
            del a

    got = []
    for out in gathered(parts(), 8):
        assert all(x() is None for x in seen[:-1])  # the last one is its producer's
        got += [x.tolist() for x in out]
    assert got == [[0, 1, 2, 3, 1, 2, 3, 4], [0, 2, 4, 6, 2, 4, 6, 8], [2, 3, 4, 5, 3, 4, 5, 6], [4, 6, 8, 10, 6, 8, 10, 12], [4, 5, 6, 7], [8, 10, 12, 14]]


def test_powers_go_with_the_last_text():
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", None])], ["text"])
    for _, texts in text_batches(iter([batch]), "text"):
        assert len(bytehash.ByteHash(np.frombuffer(b"abc", np.uint8)).windows(2)) == 2 and len(texts) == 2
    assert "powers" not in sys.modules["_tidewell_worker"].__dict__


def test_pieces_are_the_batch_in_bounded_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array([b"x" * 1000] * 9)], ["a", "b"])
    got = list(pieces(batch, 3000))
    assert max(x.nbytes for x in got) <= 3100 and pa.Table.from_batches(got) == pa.Table.from_batches([batch])
    assert [x.num_rows for x in pieces(batch, 1)] == [1] * 9 and list(pieces(batch.slice(0, 0))) == []


def test_a_stage_bounds_the_batches_of_whoever_writes_it(spark, docs, sf):
    before = spark.conf.get(MAX_RECORDS)
    try:
        for given, rows in ((10000, 1000), (0, 1000), (50, 50)):
            spark.conf.set(MAX_RECORDS, given)
            corpus_pipeline.pack(spark, docs, sf)
            assert int(spark.conf.get(MAX_RECORDS)) == rows
    finally:
        spark.conf.set(MAX_RECORDS, before)
