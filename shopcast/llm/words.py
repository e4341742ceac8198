"""Words and word hashes of many texts at once, in numpy.

All functions work on Arrow string columns as they come to ``mapInArrow``:
one UTF-8 buffer and an offset per text.  Words are ``[^\\x20\\x09-\\x0D]+``;
the separators are single bytes, so cutting bytes is cutting characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one numpy pass takes on; a longer text is its own pass.
GROUP_BYTES = 1 << 20

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Bytes that begin a character.
IS_LEAD = (np.arange(256) & 0xC0) != 0x80


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(BASE))
_LOWER = np.arange(256)
_LOWER[65:91] += 32
BYTE_VALUE_LOWER = BYTE_VALUE[_LOWER]


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i in 0 .. size."""
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for base in (BASE, inverse):
        p = np.full(size + 1, base, U64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = GROUP_BYTES * 2
    while size < n:
        size *= 2
    return _powers(size)


def prefix_hash(data: np.ndarray, values: np.ndarray = BYTE_VALUE) -> tuple[np.ndarray, np.ndarray]:
    """(sums, inverse powers): the hash of bytes i .. j is
    ``(sums[j] - sums[i]) * inverse[i]``, equal for equal strings."""
    up, down = powers(len(data))
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(values[data] * up[:len(data)], out=sums[1:])
    return sums, down


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64)


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold ``limit`` bytes at most, or one text."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


class Words:
    """The words of some texts: byte range, text and hash of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        lo, hi = int(offsets[0]), int(offsets[-1])
        self.data, self.base = data[lo:hi], lo
        self.offsets = offsets - lo
        inside = np.zeros(hi - lo + 1, bool)
        inside[:-1] = IS_WORD[self.data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cuts = self.offsets[:-1]
        begins[cuts] = inside[cuts]  # a new text begins a new word
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        stops = self.offsets[1:][self.offsets[1:] > self.offsets[:-1]] - 1
        ends[stops] = inside[stops]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        #: word numbers at which each text begins, and their total
        self.first = np.searchsorted(self.start, self.offsets)
        self.lower = lower
        self._hash: np.ndarray | None = None

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            out = np.empty(len(self.start), U64)
            values = BYTE_VALUE_LOWER if self.lower else BYTE_VALUE
            for a, b in self._blocks():
                lo, hi = int(self.start[a]), int(self.end[b - 1])
                sums, down = prefix_hash(self.data[lo:hi], values)
                s, e = self.start[a:b] - lo, self.end[a:b] - lo
                out[a:b] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(U64) * U64(BASE))
            self._hash = out
        return self._hash

    def _blocks(self) -> Iterator[tuple[int, int]]:
        at, n = 0, len(self.start)
        while at < n:
            to = int(np.searchsorted(self.end, self.start[at] + GROUP_BYTES, "right"))
            to = min(max(to, at + 1), n)
            yield at, to
            at = to

    def chars(self) -> np.ndarray:
        """Code points of each word."""
        leads = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(IS_LEAD[self.data], out=leads[1:])
        return leads[self.end] - leads[self.start]


def ngram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position; positions run to the last
    full n-gram of the array, whatever text they belong to."""
    m = max(len(words) - n + 1, 0)
    out = np.full(m, U64(n), U64)
    for k in range(n):
        out = out * U64(BASE) + words[k:k + m]
    return mix(out)


def inside_text(first: np.ndarray, n: int) -> np.ndarray:
    """Which n-gram positions lie within one text (see ``ngram_hash``)."""
    total = int(first[-1])
    m = max(total - n + 1, 0)
    ok = np.ones(m, bool)
    for k in range(1, n):
        at = first[1:-1] - k
        ok[at[(at >= 0) & (at < m)]] = False
    # a text with fewer than n words: all of its positions were marked above
    return ok
