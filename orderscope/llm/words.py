"""Words of Arrow text batches as numpy arrays.

Small task-side helpers: Spark deals the documents out, these find word
boundaries and word hashes of a piece of a batch at a time, so that a task
holds a few megabytes of text whatever the size of the table. Null text has
no words. A word never reaches over the end of its document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Text bytes handled at once; a longer document is a piece of its own.
PIECE_BYTES = 4 << 20


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    """Lookup table over byte values, true inside the given closed ranges."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


# Bytes between words: white space, or all ASCII but digits and lower-case letters.
WHITE = byte_table((0x09, 0x0D), (0x20, 0x20))
FOLLOW = byte_table((0x80, 0xBF))           # UTF-8 bytes after the first of a character
NOT_ALNUM = byte_table((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

# Odd multipliers of the mixing steps (any odd constants do).
_K = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], dtype=np.uint64)
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def mix(x: np.ndarray, which: int = 0) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x * _K[(1 + which) % 4]
    x ^= x >> np.uint64(31)
    x *= _K[(2 + which) % 4]
    x ^= x >> np.uint64(29)
    return x


def hash_pair(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """One 64-bit name for an ordered pair; the same pair has the same name everywhere."""
    return mix(mix(a + np.uint64(salt * int(_K[0]) & (1 << 64) - 1)) + b * _K[3], 1)


@dataclass
class Piece:
    """Words of some consecutive documents of one batch.

    ``start`` / ``end``: byte range of each word in ``data`` (padded by eight
    zero bytes); ``first[d]:first[d + 1]``: the words of document ``d``;
    ``row``: the batch row of document 0.
    """

    row: int
    data: np.ndarray
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def n_docs(self) -> int:
        return len(self.bounds) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts())

    def hashes(self, which: int = 0) -> np.ndarray:
        """64-bit word hashes; ``which`` picks one of several independent ones."""
        lanes = np.lib.stride_tricks.as_strided(
            self.data[:8].view(np.uint64), shape=(max(len(self.data) - 7, 0),), strides=(1,))
        length = self.end - self.start
        out = mix(length.astype(np.uint64) + _K[which], which)
        todo, step = np.arange(len(length)), 0
        while len(todo):
            rest = length[todo] - 8 * step
            lane = lanes[self.start[todo] + 8 * step] & _MASK[np.minimum(rest, 8)]
            out[todo] = mix(out[todo] ^ lane, which)
            todo, step = todo[rest > 8], step + 1
        return out

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words (all, or those marked) with one space after each.

        Returns the bytes and each kept word's start and end in them.
        """
        start, end = (self.start, self.end) if keep is None else (self.start[keep], self.end[keep])
        length = end - start
        to = np.cumsum(length + 1) - (length + 1)
        total = int(length.sum() + len(length))
        out = np.full(total, 32, dtype=np.uint8)
        if total:
            inside = np.ones(total, dtype=bool)
            inside[to + length] = False
            edge = np.zeros(len(self.data) + 1, dtype=np.int8)
            edge[start] += 1
            edge[end] -= 1
            out[inside] = self.data[np.cumsum(edge[:-1], dtype=np.int8).astype(bool)]
        return out, to, to + length


def pieces(texts: pa.Array, separators: np.ndarray, lower: bool = False,
           limit: int = PIECE_BYTES) -> Iterator[Piece]:
    """Cut a batch's texts into pieces of about ``limit`` bytes and find their words."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    n = len(texts)
    if n == 0:
        return
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, values = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + n + 1]
    raw = np.frombuffer(values, dtype=np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        to = min(to, n)
        yield _piece(raw[off[at]:off[to]], off[at:to + 1] - off[at], at, separators, lower)
        at = to


def _piece(raw: np.ndarray, bounds: np.ndarray, row: int, separators: np.ndarray, lower: bool) -> Piece:
    data = np.zeros(len(raw) + 8, dtype=np.uint8)
    data[:len(raw)] = LOWER[raw] if lower else raw
    inside = ~separators[data[:len(raw)]]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    before[bounds[:-1][bounds[:-1] < len(raw)]] = False
    if len(raw):
        before[0] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    last = bounds[1:] - 1
    after[last[last >= 0]] = False
    end = np.flatnonzero(inside & ~after) + 1
    return Piece(row, data, bounds, start, end, np.searchsorted(start, bounds))
