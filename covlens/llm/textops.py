"""Vectorised reading of many texts at once: one byte buffer per slice, numpy passes over it, no Python object per word.

`Buffer` lays the UTF-8 texts of an Arrow column end to end with a separator before, between and after them, so no
word, n-gram or shingle crosses a row.  Word hashes are polynomials over a fixed random table modulo 2^64.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

SEPARATOR = 10
_RNG = np.random.default_rng(20240131)
BYTE_CODE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15

_BLOCK_BYTES = 1 << 18

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_NO_WORD = np.ones(256, bool)
_NO_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz") + list(range(128, 256))] = False
# A byte's code within words; bytes between words count nothing.
_WORD_CODE, _PLAIN_CODE = np.where(_SPACE, np.uint64(0), BYTE_CODE), np.where(_NO_WORD, np.uint64(0), BYTE_CODE)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = np.uint64(_BASE)
        np.multiply.accumulate(out, out=out)
    return out


def powers(n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, from a table whose length is rounded up so that it is reused."""
    return _powers(max(64, 1 << (n - 1).bit_length() if n > 1 else 1))[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Buffer:
    """The texts of a column as one byte array, lower-cased unless told otherwise; null counts as empty."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        raw = [b"" if t is None else t for t in texts.cast(pa.binary()).to_pylist()]
        sep = bytes([SEPARATOR])
        self.bytes = np.frombuffer(sep + sep.join(raw) + sep, np.uint8)
        if lower:
            self.bytes = _LOWER[self.bytes]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self.row_start = np.ones(len(raw) + 1, np.int64)  # of each text; the last is one past the final separator
        np.cumsum(lengths + 1, out=self.row_start[1:])
        self.row_start[1:] += 1


class Words:
    """The words `[^\\x20\\x09-\\x0D]+` of a buffer: `start`/`end` byte positions, `hash`, and `row_first[i]`, the
    number of the first word of row i (one more entry than rows).  With `plain`, words are runs of letters and digits
    instead (ASCII ones and all bytes of other characters)."""

    def __init__(self, buffer: Buffer, plain: bool = False):
        b = buffer.bytes
        space, code = (_NO_WORD, _PLAIN_CODE) if plain else (_SPACE, _WORD_CODE)
        space = space[b]
        edge = np.diff(space.view(np.int8))
        self.start = np.flatnonzero(edge == -1) + 1
        self.end = np.flatnonzero(edge == 1) + 1
        self.row_first = np.searchsorted(self.start, buffer.row_start)
        self.hash = np.empty(len(self.start), np.uint64)
        # A block of words at a time: what is held besides the results does not grow with the texts.
        at = 0
        while at < len(self.start):
            first = self.start[at]
            to = max(at + 1, int(np.searchsorted(self.end, first + _BLOCK_BYTES, "right")))
            start, own = self.start[at:to] - first, (self.end[at:to] - self.start[at:to])
            part = slice(first, self.end[to - 1])
            size = np.diff(start, append=part.stop - first)
            place = np.arange(part.stop - first, dtype=np.int32) - np.repeat(start.astype(np.int32), size)
            value = code[b[part]]
            value *= powers(int(size.max()))[place]
            self.hash[at:to] = mix(np.add.reduceat(value, start) + own.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            at = to


def windows(hashes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """Hash of every run of `width` consecutive words (len - width + 1 of them; runs that cross rows are the caller's
    to leave out)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, seed, np.uint64)
    for j in range(width):
        out = out * np.uint64(_BASE) + hashes[j:j + n]
    return mix(out)
