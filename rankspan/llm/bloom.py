"""A blocked Bloom filter of 64-bit keys, built by Spark, tested in numpy.

A key belongs to one block of 256 bits (eight 32-bit words) and sets one bit in
each word, so a test reads one block.  The filter has at least ``BITS_PER_KEY``
bits a key up to ``MOST_BYTES``, the bound on what is collected and broadcast;
beyond it the filter stays as large and lets more keys pass.  It never turns a
key of the list away, and its users remove the false positives by an exact join
or an exact count, so results do not depend on its size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches
from .textbuf import SpanHasher, mix, mix_int

BITS_PER_KEY = 16
MOST_BYTES = 16 << 20
WORDS = 8
_BYTES = 4 * WORDS
_SALT = np.array([mix_int(i) & 0xFFFFFFFF | 1 for i in range(1, WORDS + 1)], dtype=np.uint32)
_SPANS = SpanHasher(31)


def hash_bytes(column: pa.Array) -> np.ndarray:
    """64-bit hashes of the values of a string or binary column (null as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint64)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return _SPANS.words(raw, off[:-1], off[1:])


def places(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, (keys, WORDS) bit masks) of each key."""
    keys = mix(keys.view(np.uint64))
    block = ((keys >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    low = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    bits = (low[:, None] * _SALT[None, :]) >> np.uint32(27)
    return block.astype(np.int64), np.uint32(1) << bits


class BlockedBloom:
    def __init__(self, blocks: np.ndarray):
        self.blocks = blocks                      # (blocks, WORDS) uint32

    @classmethod
    def of(cls, keys: np.ndarray, most_bytes: int = MOST_BYTES) -> BlockedBloom:
        """From keys at hand (tests, small lists)."""
        blocks = np.zeros((block_count(len(keys), most_bytes), WORDS), np.uint32)
        at, masks = places(keys, len(blocks))
        np.bitwise_or.at(blocks, at, masks)
        return cls(blocks)

    @classmethod
    def build(cls, keys: DataFrame, key_col: str = "key", most_bytes: int = MOST_BYTES) -> BlockedBloom:
        """From a table of long keys: tasks set the bits of their keys, blocks
        are united in a shuffle, and the filter alone reaches the driver."""
        n = keys.agg(F.approx_count_distinct(key_col)).first()[0]
        blocks = block_count(n, most_bytes)

        def work(batches):
            for batch in batches:
                at, masks = places(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), blocks)
                used, where = np.unique(at, return_inverse=True)
                part = np.zeros((len(used), WORDS), np.uint32)
                np.bitwise_or.at(part, where, masks)
                halves = part.view("<u8").view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(np.ascontiguousarray(halves[:, i])) for i in range(4))],
                                                 names=["block", "w0", "w1", "w2", "w3"])

        parts = in_batches(keys.select(F.col(key_col).cast("long")).where(F.col(key_col).isNotNull()), work,
                           "block long, w0 long, w1 long, w2 long, w3 long")
        rows = parts.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)]).toArrow()
        out = np.zeros((blocks, 4), np.int64)
        at = rows.column("block").to_numpy()
        for i in range(4):
            out[at, i] = rows.column(f"w{i}").to_numpy()
        return cls(out.view("<u8").view("<u4").reshape(blocks, WORDS))

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """False only for keys that are not in the list."""
        out = np.zeros(len(keys), dtype=bool)
        for lo in range(0, len(keys), 1 << 18):
            at, masks = places(keys[lo:lo + (1 << 18)], len(self.blocks))
            out[lo:lo + (1 << 18)] = ((self.blocks[at] & masks) == masks).all(axis=1)
        return out


def block_count(keys: int, most_bytes: int = MOST_BYTES) -> int:
    return int(min(max(1, -(-keys * BITS_PER_KEY // (8 * _BYTES))), max(1, most_bytes // _BYTES)))
