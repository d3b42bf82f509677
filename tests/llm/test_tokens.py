"""Encoding against the tokenizer itself; files, packing and histograms against plain Python."""

import re
import zlib

import numpy as np
import pyarrow.fs
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewell.llm import counts, packing, tokenfiles
from tidewell.llm.tokens import PieceEncoder, pieces_of, tokenizer_path

ODD = ["", "a", "  A b\tc\n", "e\u0301 \u0301x é", "don't we'll 'sé", "<|endoftext|> x<|startoftext|>y", "\x1cq\x85r\xa0s", "Σίσυφοσ ΣΑΣ", "x" * 5000, "日本 語\u3000字", "It's a1b2.c'd 'S. e\u0301x.y É.É x\u2014.y '.' (Q)a. <|EndOfText|>", "A'RE'll.'s x.'t \u212a.K"]


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def test_pieces_encode_like_whole_texts(plain, docs, monkeypatch):
    import tidewell.llm.tokens as tokens

    monkeypatch.setattr(tokens, "CACHE", 500)
    encoder = PieceEncoder(tokenizer_path())
    texts = ODD + [r["text"] or "" for r in docs.collect()]
    for lo in range(0, len(texts), 37):
        part = texts[lo : lo + 37]
        ids, n = encoder.encode(part)
        want = [plain(t) for t in part]
        assert n.tolist() == [len(x) for x in want] == encoder.counts(part).tolist()
        assert ids.tolist() == [i for x in want for i in x]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abZ '.,\t\n\x0b\x1c<|>9\u00e9\u0130\u212a", max_size=12), max_size=6))
def test_pieces_of_many_texts_at_once(texts):
    def one(data):
        if b"<|" in data:
            return data.split()
        return re.sub(rb"([a-z])([^a-z'\s\x80-\xff])", rb"\1 \2", data.lower()).split()

    data = [t.encode() for t in texts]
    assert pieces_of(data) == [one(x) for x in data]


def test_known_pieces_are_looked_up_once_and_whole_bytes_packed_as_such(monkeypatch):
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

        def __contains__(self, key):
            raise AssertionError("looked up twice")

    encoder = PieceEncoder(tokenizer_path())
    ids, _ = encoder.encode(["a b c a", "b"])
    encoder.index = Counted(encoder.index)
    again, _ = encoder.encode(["a b c a", "b"])
    assert again.tolist() == ids.tolist() and Counted.asked == 5
    monkeypatch.setattr(np, "unpackbits", None)
    assert tokenfiles.pack_bits(ids, 16) == ids.astype("<u2").tobytes()
    assert tokenfiles.unpack_bits(tokenfiles.pack_bits(ids, 16), len(ids), 16).tolist() == ids.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=70), st.integers(1, 32))
def test_bits_round_trip(values, bits):
    ids = np.array(values, np.uint64).astype(np.uint32) & np.uint32((1 << bits) - 1)
    data = tokenfiles.pack_bits(ids, bits)
    assert len(data) == -(-len(ids) * bits // 8)
    assert tokenfiles.unpack_bits(data, len(ids), bits).tolist() == ids.tolist()


def test_files_round_trip_with_random_access(spark, plain, docs, tmp_path):
    rows = [(r["doc_id"], r["text"]) for r in docs.where("doc_id < 90").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(ODD)] + [(2000, None), (2001, "again"), (2001, "again"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    shards = tokenfiles.write_tokens(df, f"file://{tmp_path}/out")
    got = sorted(tokenfiles.read_documents(shards, run=1000).collect(), key=lambda r: (r["start"], r["n_tokens"]))
    at = 0
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [i for i, _ in rows]
    for r, (_, text) in zip(got, rows, strict=True):
        ids = np.array([*plain(text), tokenfiles.END_ID], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    listed = {s["path"]: s for s in shards.collect()}
    assert {s["bits"] for s in listed.values()} == {16}
    path = max(listed.values(), key=lambda s: s["n_docs"])["path"]
    files, place = pyarrow.fs.FileSystem.from_uri(path)
    with files.open_input_file(place) as f:
        reader = tokenfiles.Reader(f)
        i = reader.n_docs - 1
        text = dict(rows).get(None if reader.null_ids[i] else int(reader.doc_ids[i]))
        assert reader.document(i).tolist() == [*plain(text), tokenfiles.END_ID]
    empty = tokenfiles.read_documents(tokenfiles.write_tokens(df.limit(0), f"file://{tmp_path}/none"))
    assert empty.count() == 0


def test_blocks_off_byte_borders(tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfiles, "BLOCK", 5)
    ids = np.arange(33, dtype=np.uint32) % 7
    with pyarrow.OSFile(f"{tmp_path}/f", "wb") as out:
        writer = tokenfiles.Writer(out, 3)
        writer.add(ids, np.array([13, 0, 20]), [4, None, 9])
        writer.close()
    with pyarrow.OSFile(f"{tmp_path}/f", "rb") as f:
        reader = tokenfiles.Reader(f)
        assert [reader.document(i).tolist() for i in range(3)] == [ids[:13].tolist(), [], ids[13:].tolist()]
        assert all(reader.ids(a, b).tolist() == ids[a:b].tolist() for a in range(33) for b in range(a, 34))


def test_histogram_sums(spark, plain, monkeypatch):
    monkeypatch.setattr(counts, "BLOCK", 4)
    texts = ODD + [None, None] + ["a b c d e f " * k for k in range(9)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    n = np.array([len(plain(t)) for t in texts])
    hist = counts.histogram(df)
    sums = counts.length_sums(hist)
    for r in sums.collect():
        x = r["length"]
        assert (r["n_docs"], r["docs_at_least"], r["tokens_at_least"], r["truncated_total"], r["docs_at_most"]) == (
            (n == x).sum(), (n >= x).sum(), n[n >= x].sum(), np.minimum(n, x).sum(), (n <= x).sum()
        )
        assert abs(r["share_at_most"] - (n <= x).mean()) < 1e-12
    assert {r["length"] for r in sums.collect()} == set(n.tolist())
    assert {r["limit"]: r["total"] for r in counts.truncated_totals(hist, [0, 5, 40]).collect()} == {
        str(k): np.minimum(n, k).sum() for k in (0, 5, 40)
    }
    assert {r["share"]: r["length"] for r in counts.quantiles(sums, [0.5, 1.0]).collect()} == {
        "0.5": np.sort(n)[-(-len(n) // 2) - 1], "1.0": n.max()
    }
    assert counts.length_sums(counts.histogram(df.limit(0))).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_bins_hold_their_pieces(sizes):
    sizes.sort(reverse=True)
    bins, offsets, ends = packing.pack(sizes, (8, 16, 32, 64))
    used = [0] * len(ends)
    for n, b, o in zip(sizes, bins, offsets, strict=True):
        assert o == used[b]
        used[b] += n
    # Every bin is downsized to its contents.
    assert all(e == min(c for c in (8, 16, 32, 64) if c >= u) for u, e in zip(used, ends, strict=True))


def test_best_fit_takes_the_tightest_bin(monkeypatch):
    # 60 and 50 open bins of 64; 10 fits the second only, 4 fits the first exactly.
    bins, _, ends = packing.pack([60, 50, 10, 4], (64,))
    assert bins == [0, 1, 1, 0] and ends == [64, 64]
    # A short rest opens the cheap size.
    assert packing.pack([5], (8, 64))[2] == [8]


def test_packing_covers_every_token(spark, plain, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.where("doc_id < 60").collect()]
    rows += [(500, None), (501, ""), (502, "w x " * 3000), (503, "same"), (503, "same"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack_documents(df, (64, 256, 1024)).collect()
    by_doc: dict = {}
    by_bin: dict = {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append((r["first_token"], r["n_tokens"]))
        by_bin.setdefault((r["bin_id"], r["bin_length"]), []).append((r["bin_offset"], r["n_tokens"]))
    for i, text in rows:
        pieces = sorted(by_doc[i])
        n = len(plain(text)) + 1
        if i == 503:
            assert pieces == [(0, n), (0, n)]
        else:
            assert [a for a, _ in pieces] == [sum(m for _, m in pieces[:k]) for k in range(len(pieces))]
            assert sum(m for _, m in pieces) == n
    assert len({b for b, _ in by_bin}) == len(by_bin)
    for (_, length), parts in by_bin.items():
        parts.sort()
        assert [a for a, _ in parts] == [sum(m for _, m in parts[:k]) for k in range(len(parts))]
        filled = sum(m for _, m in parts)
        assert length == min(c for c in (64, 256, 1024) if c >= filled)
    assert packing.pack_documents(df.limit(0)).count() == 0
