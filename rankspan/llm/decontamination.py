"""Benchmark decontamination: size-partitioned MinHash containment search.

Short test items are sought inside long documents.  Items are partitioned by
size: class u holds items of u/2+1 .. u distinct shingles (u a power of two).
For each class a document is cut into windows of 2u shingles, one at every
u-th, so that whatever spans u shingles lies whole in one window and its Jaccard
similarity with the window is bounded from below; ``HASHES`` minima per window
are compared with the items' (any equal one makes a candidate).  A document of
any length is covered by its windows.  Every candidate is verified exactly: the
share of the item's distinct shingles that the whole document holds.

Minima of a larger class come from those of the smaller one, so the shingles
are hashed once per hash function.  Items are handled in blocks of at most
``BLOCK_BYTES`` of text (size measured first): a block is broadcast and the
documents are scanned once for it; nothing is shuffled.

Shingles are runs of ``SHINGLE`` lower-cased words.  Defined cases: an item of
fewer words is one run of all its words, found where a document has exactly that
run (containment 1); null or empty texts match nothing; an item id that
occurs in several rows is one row of result per matching text (the largest);
repeated document rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_name, in_batches
from .textbuf import SpanHasher, buffers, chunks, mix, mix_int, shingles, split_words

SHINGLE = 5
THRESHOLD = 0.8
HASHES = 40
BLOCK_BYTES = 8 << 20
_HASHER = SpanHasher(6)
_ODD = np.array([(mix_int(2 * j + 1) | 1) & 0xFFFFFFFF for j in range(256)], dtype=np.uint32)
_MOST = np.uint32(0xFFFFFFFF)


def document_shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE):
    """(hashes, first): shingle hashes of all documents, and the index of each
    document's first one."""
    starts, ends, first = split_words(data, offsets)
    runs = shingles(_HASHER.words(data, starts, ends), size)
    count = np.maximum(np.diff(first) - size + 1, 0)
    inside = np.ones(len(runs), dtype=bool)
    # runs that begin in the last words of a document reach over its end
    for back in range(1, size):
        at = first[1:] - back
        inside[at[(at >= first[:-1]) & (at < len(runs))]] = False
    return runs[inside], np.concatenate([[0], np.cumsum(count)])


def _key(level: int, j: int, value: np.ndarray) -> np.ndarray:
    return mix((value.astype(np.uint64) << np.uint64(16)) | np.uint64(level << 8 | j))


@dataclass
class ItemIndex:
    """Signatures and shingles of one block of items."""

    ids: np.ndarray
    hashes: np.ndarray       # distinct shingles of all items, one item after the other
    first: np.ndarray
    levels: list[int]
    keys: np.ndarray         # sorted signature keys
    owners: np.ndarray
    bits: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]     # words of a short item -> sorted runs, their item ids

    @classmethod
    def build(cls, rows: list[tuple[int, str]], size: int, n_hashes: int) -> ItemIndex | None:
        ids, sets, brief = [], [], {}
        for item, text in rows:
            raw = np.frombuffer(text.encode(), np.uint8)
            whole = np.array([0, len(raw)])
            own = np.unique(document_shingles(raw, whole, size)[0])
            if len(own):
                ids.append(item)
                sets.append(own)
            elif n := int(split_words(raw, whole)[2][-1]):
                brief.setdefault(n, []).append((document_shingles(raw, whole, n)[0][0], item))
        short = {}
        for n, found in brief.items():
            runs, items = np.array([r for r, _ in found], np.uint64), np.array([i for _, i in found], np.int64)
            order = np.argsort(runs, kind="stable")
            short[n] = runs[order], items[order]
        if not ids:
            none = np.zeros(0, np.uint64)
            return cls(np.zeros(0, np.int64), none, np.zeros(1, np.int64), [], none, none, none, short) if short else None
        level = [int(len(s) - 1).bit_length() for s in sets]
        keys, owners = [], []
        for i, s in enumerate(sets):
            low = (s >> np.uint64(32)).astype(np.uint32)
            least = (low[None, :] * _ODD[:n_hashes, None]).min(axis=1)
            keys += [_key(level[i], j, least[j:j + 1])[0] for j in range(n_hashes)]
            owners += [i] * n_hashes
        order = np.argsort(np.array(keys), kind="stable")
        keys = np.array(keys)[order]
        width = int(min(25, max(16, (16 * len(keys) - 1).bit_length())))
        bits = np.zeros(1 << width, dtype=bool)
        bits[keys >> np.uint64(64 - width)] = True
        return cls(np.array(ids, dtype=np.int64), np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]),
                   sorted(set(level)), keys, np.array(owners)[order], bits, short)

    def candidates(self, runs: np.ndarray, first: np.ndarray, n_hashes: int) -> set[tuple[int, int]]:
        """(document, item) pairs with an equal minimum in a window."""
        if not self.levels:
            return set()
        n = len(first) - 1
        base, top = 1 << self.levels[0], self.levels[-1]
        count = np.diff(first)
        blocks = -(-count // base)
        total = int(blocks.sum())
        if not total:
            return set()
        at = np.concatenate([[0], np.cumsum(blocks)])
        grid = np.full(total * base, _MOST, dtype=np.uint32)
        place = np.arange(len(runs)) + np.repeat(at[:-1] * base - first[:-1], count)
        grid[place] = (runs >> np.uint64(32)).astype(np.uint32)
        padded = np.ones(total * base, dtype=bool)
        padded[place] = False
        grid = np.ascontiguousarray(grid.reshape(total, base).T)
        padded = np.ascontiguousarray(padded.reshape(total, base).T)
        has_padding = bool(padded.any())
        # windows of each level: block offsets of documents, children of a block
        plans, offsets = [], at
        for level in range(self.levels[0], top + 1):
            size = np.diff(offsets)
            owner = np.repeat(np.arange(n), size)
            last = np.zeros(int(offsets[-1]), dtype=bool)
            last[offsets[1:][size > 0] - 1] = True
            following = np.arange(len(last)) + ~last
            half = np.concatenate([[0], np.cumsum((size + 1) // 2)])
            up = np.arange(half[-1]) - np.repeat(half[:-1], np.diff(half))
            child = np.repeat(offsets[:-1], np.diff(half)) + 2 * up
            plans.append((level, owner, following, child, np.minimum(child + 1, np.repeat(offsets[1:], np.diff(half)) - 1)))
            offsets = half
        shift = np.uint64(64 - int(len(self.bits)).bit_length() + 1)
        found: set[tuple[int, int]] = set()
        for j in range(n_hashes):
            hashed = grid * _ODD[j]
            if has_padding:
                hashed[padded] = _MOST
            least = hashed.min(axis=0)
            for level, owner, following, left, right in plans:
                if level in self.levels:
                    window = np.minimum(least, least[following])
                    key = _key(level, j, window)
                    hit = np.flatnonzero(self.bits[key >> shift])
                    if len(hit):
                        k, d = key[hit], owner[hit]
                        lo, hi = np.searchsorted(self.keys, k), np.searchsorted(self.keys, k, side="right")
                        for doc, a, b in zip(d[hi > lo], lo[hi > lo], hi[hi > lo], strict=True):
                            found.update((int(doc), int(i)) for i in self.owners[a:b])
                least = np.minimum(least[left], least[right])
        return found

    def matches(self, data: np.ndarray, offsets: np.ndarray, size: int, n_hashes: int, threshold: float):
        """(document, item id, containment) of all verified pairs."""
        runs, first = document_shingles(data, offsets, size)
        out, own, at = [], None, -1
        for doc, item in sorted(self.candidates(runs, first, n_hashes)):
            if doc != at:
                own, at = np.unique(runs[first[doc]:first[doc + 1]]), doc
            want = self.hashes[self.first[item]:self.first[item + 1]]
            place = np.minimum(np.searchsorted(own, want), len(own) - 1)
            share = np.count_nonzero(own[place] == want) / len(want)
            if share >= threshold:
                out.append((doc, int(self.ids[item]), share))
        return out + self._short_matches(data, offsets)

    def _short_matches(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, float]]:
        out = []
        for n, (known, items) in self.short.items():
            runs, first = document_shingles(data, offsets, n)
            lo, hi = np.searchsorted(known, runs), np.searchsorted(known, runs, side="right")
            hit = np.flatnonzero(hi > lo)
            owner = np.searchsorted(first, hit, side="right") - 1
            for doc, a, b in np.unique(np.column_stack([owner, lo[hit], hi[hit]]), axis=0).tolist():
                out += [(doc, int(i), 1.0) for i in items[a:b]]
        return out


def item_blocks(items: DataFrame, id_col: str, text_col: str, size: int, n_hashes: int, block_bytes: int):
    """Indexes of the items, a block of bounded size at a time."""
    rows = items.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.lower(text_col).alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(-(-total // block_bytes)) or 1
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b) if blocks > 1 else rows
        index = ItemIndex.build([(r["id"], r["text"]) for r in part.orderBy("id", "text").collect()], size, n_hashes)
        if index is not None:
            yield index


def find(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
         threshold: float = THRESHOLD, size: int = SHINGLE, n_hashes: int = HASHES,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, containment) of every document that holds at least
    ``threshold`` of an item's shingles."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, containment double"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower("text").alias("text"))
    out = None
    for index in item_blocks(items, id_col, text_col, size, n_hashes, block_bytes):
        shared = spark.sparkContext.broadcast(index)

        def work(batches, shared=shared):
            for batch in batches:
                data, offsets = buffers(batch.column(1))
                doc, item, share = [], [], []
                for lo, hi in chunks(offsets):
                    part = data[offsets[lo]:offsets[hi]]
                    best: dict[tuple[int, int], float] = {}
                    for d, i, s in shared.value.matches(part, offsets[lo:hi + 1] - offsets[lo], size, n_hashes, threshold):
                        best[lo + d, i] = max(s, best.get((lo + d, i), 0.0))
                    for (d, i), s in best.items():
                        doc.append(d)
                        item.append(i)
                        share.append(s)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc, pa.int64())), pa.array(item, pa.int64()),
                                                  pa.array(share, pa.float64())], names=["doc_id", "item_id", "containment"])

        part = in_batches(texts, work, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                      threshold: float = THRESHOLD, size: int = SHINGLE, n_hashes: int = HASHES,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns kept."""
    spark, lower = docs.sparkSession, fresh_name(docs, "_lower_text")
    out = docs
    for index in item_blocks(items, id_col, text_col, size, n_hashes, block_bytes):
        shared = spark.sparkContext.broadcast(index)

        def work(batches, shared=shared):
            for batch in batches:
                data, offsets = buffers(batch.column(batch.num_columns - 1))
                keep = np.ones(batch.num_rows, dtype=bool)
                for lo, hi in chunks(offsets):
                    found = shared.value.matches(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], size,
                                                 n_hashes, threshold)
                    keep[[lo + d for d, _, _ in found]] = False
                yield batch.select(batch.schema.names[:-1]).filter(pa.array(keep))

        out = in_batches(out.withColumn(lower, F.lower("text")), work, docs.schema)
    return out
