"""Words and their hashes over whole Arrow batches of texts.

Texts of a batch lie one behind the other in one buffer of UTF-8 bytes. Words, lines and
n-grams are spans of it, and a span's hash is the difference of two prefix sums, so no step
loops over characters or words in Python. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in pieces of about so many bytes; a longer text is a piece of its own.
PIECE_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = {BASE: np.ones(1, np.uint64), INVERSE: np.ones(1, np.uint64)}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64; kept for the next call unless large."""
    known = _powers[base]
    if len(known) < n:
        known = np.full(n, base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= 4 * PIECE_BYTES:
            _powers[base] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Texts:
    """Consecutive texts: `data` holds their bytes, text i is data[offsets[i]:offsets[i+1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> Words:
        return Words.of(self)

    def prefix(self, data: np.ndarray | None = None) -> np.ndarray:
        data = self.data if data is None else data
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
        return sums


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span, the same wherever the span lies."""
    return mixed((prefix[ends] - prefix[starts]) * powers(INVERSE, len(prefix))[starts])


@dataclass
class Words:
    """Runs of non-blank bytes: word j is data[starts[j]:ends[j]]; text i has words
    first[i] to first[i+1]."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: Texts, outside: np.ndarray = BLANK) -> Words:
        blank = outside[texts.data]
        begins, lasts = ~blank, ~blank
        begins[1:] &= blank[:-1]
        lasts[:-1] &= blank[1:]
        edges = texts.offsets[(texts.offsets > 0) & (texts.offsets < len(blank))]
        begins[edges] = ~blank[edges]
        lasts[edges - 1] = ~blank[edges - 1]
        starts = np.flatnonzero(begins)
        return cls(starts, np.flatnonzero(lasts) + 1, np.searchsorted(starts, texts.offsets))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, Texts]]:
    """The texts of an Arrow column in pieces, each with the number of its first row.

    A null is an empty text.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, where, held = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + size, "right")) - 1
        end = min(max(end, begin + 1), n)
        yield begin, Texts(data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin])
        begin = end


def shingles(hashes: np.ndarray, words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within a text, and the place of each text's first one.

    A text with fewer words has its whole sequence as one; one without words has none.
    """
    counts = words.counts
    number = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(number)])
    at = np.repeat(words.first[:-1] - first[:-1], number) + np.arange(first[-1])
    room = np.repeat(words.first[1:], number)
    out = np.zeros(len(at), np.uint64)
    padded = np.concatenate([hashes, np.zeros(k, np.uint64)])
    for j in range(k):
        out *= BASE
        out += np.where(at + j < room, padded[at + j], np.uint64(j))
    return mixed(out), first
