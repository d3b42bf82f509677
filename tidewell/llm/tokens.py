"""Encoding of whole texts with a public tokenizer, white-space piece by white-space piece.

The tokenizer drops white space and none of its rules looks across ASCII white space, so a
text's ids are those of its pieces one after another. It lowers all letters itself, and a
run of letters always ends before an ASCII character that is no letter, so A-Z are lowered
and a space is put there beforehand: fewer pieces differ. (Not in texts with `<|`, where a
special token could be meant.) Each worker keeps the ids of pieces it has met, which makes
encoding a table look-up; of more than CACHE those met once are forgotten, with equal ids.
"""

from __future__ import annotations

import os
import sys
import types
from itertools import chain, repeat

import numpy as np

#: Pieces a worker remembers.
CACHE = 800_000
LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = True
#: What always begins a new token after a letter (an apostrophe may belong to the letters).
BEGINS = ~LETTER
BEGINS[[*b" \t\n\r\x0b\x0c'", *range(0x80, 0x100)]] = False
#: Unknown pieces encoded in one call.
TOGETHER = 2000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces_of(texts: list[bytes]) -> list[list[bytes]]:
    """The pieces of each text; the spaces go into all texts at once."""
    whole = [b"<|" in t for t in texts]
    lowered = [b"" if w else t.lower() for t, w in zip(texts, whole, strict=True)]
    data = np.frombuffer(b"\n".join(lowered), np.uint8)
    cut = np.flatnonzero(LETTER[data[:-1]] & BEGINS[data[1:]]) + 1
    spaced = np.insert(data, cut, np.uint8(ord(" "))).tobytes()
    first = np.cumsum([0, *(len(t) + 1 for t in lowered)])
    first = (first + np.searchsorted(cut, first)).tolist()
    return [
        t.split() if w else spaced[a:b].split()
        for t, w, a, b in zip(texts, whole, first, first[1:], strict=False)
    ]


class PieceEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.index: dict[bytes, int] = {}
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.hits = np.zeros(0, np.int64)
        self.pool = np.zeros(0, np.uint32)

    def forget(self) -> None:
        """Keep the pieces met more than once, or none if they are too many."""
        kept = np.flatnonzero(self.hits > 1)
        kept = kept if 2 * len(kept) <= CACHE else kept[:0]
        names = list(self.index)
        self.pool = self.pool[self.source(kept)]
        self.size = self.size[kept]
        self.begin = np.cumsum(self.size) - self.size
        self.hits = np.zeros(len(kept), np.int64)
        self.index = {names[k]: i for i, k in enumerate(kept.tolist())}

    def source(self, at: np.ndarray) -> np.ndarray:
        """Where in the pool the ids of the pieces `at` stand, one piece after another."""
        size = self.size[at]
        ends = np.cumsum(size)
        return np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.begin[at] - ends + size, size)

    def learn(self, pieces: list[bytes]) -> None:
        ids, sizes = [], []
        for lo in range(0, len(pieces), TOGETHER):
            # One call for many pieces; where a token begins tells whose it is.
            words = [p.decode() for p in pieces[lo : lo + TOGETHER]]
            made = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            first = np.cumsum([0, *(len(w) + 1 for w in words)])
            begins = np.fromiter(chain.from_iterable(made.offsets), np.int64, 2 * len(made.ids))[::2]
            ids.append(np.array(made.ids, np.uint32))
            sizes.append(np.bincount(np.searchsorted(first, begins, "right") - 1, minlength=len(words)))
        size = np.concatenate(sizes)
        self.begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.hits = np.concatenate([self.hits, np.zeros(len(size), np.int64)])
        self.pool = np.concatenate([self.pool, *ids])
        self.index.update(zip(pieces, range(len(self.index), len(self.index) + len(pieces)), strict=True))

    def look_up(self, pieces: list[bytes]) -> np.ndarray:
        """The numbers of pieces, -1 for those that are not known."""
        return np.fromiter(map(self.index.get, pieces, repeat(-1)), np.int64, len(pieces))

    def places(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the pieces' ids are kept, and the number of pieces of each text."""
        pieces = pieces_of([t.encode() for t in texts])
        flat = list(chain.from_iterable(pieces))
        at = self.look_up(flat)
        missing = {flat[i] for i in np.flatnonzero(at < 0).tolist()}
        if missing and len(self.index) + len(missing) > CACHE:
            self.forget()
            at = self.look_up(flat)
            missing = {flat[i] for i in np.flatnonzero(at < 0).tolist()}
        if missing:
            self.learn(sorted(missing))
            new = np.flatnonzero(at < 0)
            at[new] = self.look_up([flat[i] for i in new.tolist()])
        self.hits += np.bincount(at, minlength=len(self.hits))
        return at, np.fromiter(map(len, pieces), np.int64, len(pieces))

    def counts(self, texts: list[str]) -> np.ndarray:
        at, pieces = self.places(texts)
        total = np.concatenate([[0], np.cumsum(self.size[at])])
        last = np.cumsum(pieces)
        return total[last] - total[last - pieces]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        at, pieces = self.places(texts)
        total = np.concatenate([[0], np.cumsum(self.size[at])])
        last = np.cumsum(pieces)
        return self.pool[self.source(at)], total[last] - total[last - pieces]


def encoder(path: str) -> PieceEncoder:
    """The encoder of this process: loaded once, kept between tasks of a worker."""
    worker = sys.modules.setdefault("_tidewell_worker", types.ModuleType("_tidewell_worker")).__dict__
    kept = worker.setdefault("encoders", {})
    if path not in kept:
        kept[path] = PieceEncoder(path)
    return kept[path]
