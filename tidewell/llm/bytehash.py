"""64-bit hashes of any stretch of a byte buffer, for all stretches at once, in numpy."""

from __future__ import annotations

import sys
import types

import numpy as np

ODD = 0x9E6C63D0876A9A47
MASK = (1 << 64) - 1
TABLE = np.random.default_rng(20240611).integers(0, 1 << 64, 256, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD ** i and its inverse modulo 2 ** 64, kept by the worker while a task reads texts."""
    kept = sys.modules.setdefault("_tidewell_worker", types.ModuleType("_tidewell_worker")).__dict__
    if len(kept.get("powers", ((), ()))[0]) < n:
        base = np.ones((2, (1 << max(16, (n - 1).bit_length())) + 1), np.uint64)
        base[0, 1:] = np.uint64(ODD)
        base[1, 1:] = np.uint64(pow(ODD, -1, 1 << 64))
        np.multiply.accumulate(base, axis=1, out=base)
        kept["powers"] = (base[0], base[1])
    return kept["powers"]


class ByteHash:
    """Prefix sums over a buffer; `span` hashes buffer[lo:hi], equal bytes to equal values."""

    def __init__(self, buffer: np.ndarray, table: np.ndarray = TABLE):
        up, self.down = powers(len(buffer) + 1)
        sums = table[buffer]
        sums *= up[: len(buffer)]
        self.sums = np.zeros(len(buffer) + 1, np.uint64)
        np.cumsum(sums, out=self.sums[1:])

    def span(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.down[lo])

    def windows(self, size: int) -> np.ndarray:
        """`span` of all stretches of `size` bytes."""
        n = len(self.sums) - size
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def least_ahead(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] for every i where it fits."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[done:], x[:-done]) if len(x) > done else x[:0]
        done *= 2
    rest = width - done
    return np.minimum(x[rest:], x[: len(x) - rest]) if rest and len(x) > rest else (x if not rest else x[:0])
