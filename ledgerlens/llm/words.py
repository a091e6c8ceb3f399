"""Words of text batches as flat numpy arrays.

A word is a maximal run of word bytes of the lower-cased UTF-8 text. Both word
classes used here end at ASCII bytes only, so runs of bytes and runs of code
points are the same. Words are identified by a 64-bit hash: a random value per
byte, multiplied by an odd power of its place, summed modulo 2**64 and mixed.
Two given different words share a hash with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Words end at white space: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Words are letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

#: Bytes of text worked on at a time; a longer text is a piece of its own.
PIECE = 4 << 20
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _seeded(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = _seeded(11, 256)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD6E8FEB86659FD93)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Words:
    """`raw`: the texts' bytes, one space after each; `data`: the same in lower
    case; word i is data[start[i]:end[i]]; the words of text d are
    first[d]:first[d + 1]; `doc[i]` is the text of word i."""

    raw: np.ndarray
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    def bytes_of(self, lo: int, hi: int) -> bytes:
        """Words lo..hi-1 of one text, joined by single spaces."""
        return b" ".join(self.data[self.start[i]:self.end[i]].tobytes() for i in range(lo, hi))


def words(texts: list[bytes | None], kind: np.ndarray) -> Words:
    """All words of the texts; a null text has none."""
    raw = np.frombuffer(b"\x20".join([t or b"" for t in texts]) + b"\x20", np.uint8)
    data = LOWER[raw]
    at = np.cumsum([0, *(len(t or b"") + 1 for t in texts)])
    m = kind[data]
    edge = np.flatnonzero(m[1:] != m[:-1]) + 1
    if m[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    first = np.searchsorted(start, at)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(raw, data, start, end, first, doc, _hashes(data, start, end))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    lo = 0
    while lo < len(start):
        hi = max(lo + 1, int(np.searchsorted(end, start[lo] + _CHUNK, "right")))
        base, stop = start[lo], end[hi - 1]
        power = _powers(_BASE, int(stop - base))
        total = np.zeros(stop - base + 1, np.uint64)
        np.cumsum(_BYTE[data[base:stop]] * power, out=total[1:])
        s, e = start[lo:hi] - base, end[lo:hi] - base
        # base**place is odd, so dividing by it is multiplying by its inverse
        out[lo:hi] = mix((total[e] - total[s]) * _powers(_INVERSE, int(stop - base))[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def grams(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows that lie in one text, and their first words."""
    if len(w.hash) < n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    last = len(w.hash) - n + 1
    h = np.full(last, n, np.uint64)
    for j in range(n):
        h = h * _GRAM + w.hash[j:j + last]
    place = np.flatnonzero(w.doc[:last] == w.doc[n - 1:])
    return mix(h[place]), place


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string or binary column."""
    return column.cast(pa.large_binary()).to_pylist()


def pieces(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Row ranges of at most PIECE bytes, or one row."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > lo and size + n > PIECE:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)
