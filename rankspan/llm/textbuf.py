"""Vectorised text helpers for Arrow batches inside Spark tasks.

A column of documents is handled as one byte buffer plus offsets, in chunks of
bounded size; words are maximal runs of bytes outside a separator set (all
separators are ASCII, so bytes of multi-byte characters never split).  A null
text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
_SEGMENT = 1 << 20
_U64 = np.uint64

# The separators of [^\x20\x09-\x0D]+ .
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser: a bijection of 64-bit integers."""
    x = x.astype(_U64, copy=True)
    x ^= x >> _U64(30)
    x *= _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def mix_int(x: int) -> int:
    return int(mix(np.array([x & (2**64 - 1)], dtype=_U64))[0])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]] if n else raw[:0], off - (off[0] if n else 0)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole documents of at most ``limit`` bytes (or one document)."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def split_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES):
    """(starts, ends, first): byte spans of all words, and the index of each
    document's first word (one more entry closes the last document)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~separators[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    previous = np.empty(len(data), dtype=bool)
    previous[0] = False
    previous[1:] = inside[:-1]
    following = np.empty(len(data), dtype=bool)
    following[-1] = False
    following[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~previous | edge[:-1]))
    ends = np.flatnonzero(inside & (~following | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class SpanHasher:
    """64-bit polynomial hashes of words and of spans of words.

    hash(b0..bn) = mix(sum T[b_i] * B**i + n): prefix sums modulo 2**64 make all
    words of a chunk one vector operation."""

    def __init__(self, seed: int = 1):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.table = rng.integers(1, 2**63, 256, dtype=np.int64).astype(_U64) * _U64(2) + _U64(1)
        self.base = int(rng.integers(1, 2**62)) * 4 + 3
        self.inverse = pow(self.base, -1, 2**64)
        self._up = self._powers(self.base, 1 << 16)
        self._down = self._powers(self.inverse, 1 << 16)

    @staticmethod
    def _powers(base: int, n: int) -> np.ndarray:
        out = np.empty(n, dtype=_U64)
        out[0], done = 1, 1
        while done < n:
            step = min(done, n - done)
            out[done:done + step] = out[:step] * _U64(pow(base, done, 2**64))
            done += step
        return out

    def _grow(self, n: int) -> None:
        if n > len(self._up):
            size = 1 << (n - 1).bit_length()
            self._up, self._down = self._powers(self.base, size), self._powers(self.inverse, size)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        self._grow(len(values) + 1)
        out = np.empty(len(values) + 1, dtype=_U64)
        out[0] = 0
        np.cumsum(values * self._up[:len(values)], out=out[1:])
        return out

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), dtype=_U64)
        lo = 0
        while lo < len(starts):
            begin = int(starts[lo])
            hi = max(lo + 1, int(np.searchsorted(ends, begin + _SEGMENT, side="right")))
            if ends[hi - 1] - begin > _SEGMENT:          # one very long word
                total = 0
                for at in range(begin, int(ends[lo]), _SEGMENT):
                    piece = data[at:min(at + _SEGMENT, int(ends[lo]))]
                    total += int(self._sums(self.table[piece])[-1]) * pow(self.base, at - begin, 2**64)
                out[lo] = total & (2**64 - 1)
            else:
                sums = self._sums(self.table[data[begin:ends[hi - 1]]])
                s, e = starts[lo:hi] - begin, ends[lo:hi] - begin
                out[lo:hi] = (sums[e] - sums[s]) * self._down[s]
            lo = hi
        return mix(out + (ends - starts).astype(_U64))

    def spans(self, words: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of word spans [begin, end) from the words' hashes."""
        sums = self._sums(words)
        return mix((sums[end] - sums[begin]) * self._down[begin] + (end - begin).astype(_U64))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive word hashes (none if fewer).
    Runs that cross a document border are the caller's to leave out."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, _U64)
    out = words[:n].copy()
    for j in range(1, size):
        out *= _U64(0x9E3779B97F4A7C15)
        out += words[j:j + n]
    return mix(out)


def ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenated integer ranges begin[i] .. begin[i] + count[i] - 1."""
    total = int(count.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(count)
    return np.arange(total, dtype=np.int64) + np.repeat(begin - (ends - count), count)
