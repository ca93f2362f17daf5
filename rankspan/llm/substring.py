"""Exact substring deduplication by super-k-mers.

A window is ``WINDOW`` consecutive words of one document.  Its minimiser is the
smallest hash among its runs of ``SEED`` words; consecutive windows that share
it travel as one packed string (their words joined by single spaces) to the
minimiser's bucket.  Equal windows have equal minimisers, so each bucket sorts
the windows of its strings and counts equal ones exactly, by their bytes.

* Equal strings of a task are sent once with a count, so copies that fill a third
  of the table arrive as one row for each batch of strings.
* A minimiser that occurs very often (counted first, over all documents) would
  gather many different strings in one bucket: its windows are sent one by one
  to buckets of their own hash instead.
* Buckets are sorted streams: a task holds the strings of one minimiser at a time.
* A bucket answers with the words to remove of each string; documents find their
  strings by a 128-bit hash, in a join whose hot keys Spark can split.

Words are ``[^\\x20\\x09-\\x0D]+``.  All windows are judged on the input.  Defined
cases: null, empty and short texts (fewer words than a window) lose nothing; a
repeated row makes all its windows repeated; rows that share a doc_id but not
the text are judged apart; null ids are allowed; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, staged
from .textbuf import SPACES, SpanHasher, buffers, chunks, ranges, shingles, split_words

WINDOW = 35
SEED = 5
LONGEST_RUN = 256
HELD_STRINGS = 30_000
HELD_BYTES = 24 << 20
HOT = 2_000
HOT_LISTED = 65_536
_A, _B = SpanHasher(21), SpanHasher(22)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, by doubling."""
    out, done = values, 1
    while 2 * done <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    return np.minimum(out[:len(values) - width + 1], out[width - done:]) if done < width else out


class Cut:
    """The super-k-mers of the documents of a chunk."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int, seed: int, hot: np.ndarray):
        self.data, self.window = data, window
        self.starts, self.ends, self.first = split_words(data, offsets)
        count = np.diff(self.first)
        windows = np.maximum(count - window + 1, 0)
        total = int(windows.sum())
        empty = np.zeros(0, np.int64)
        if not total:
            self.begin, self.length, self.owner = empty, empty, empty
            self.key, self.many = np.zeros(0, np.uint64), np.zeros(0, bool)
            self.words = np.zeros(0, np.uint64)
            return
        self.words = _A.words(data, self.starts, self.ends)
        runs = shingles(self.words, seed)
        width = window - seed + 1
        at = ranges(self.first[:-1], windows)
        least = window_minima(runs, width)[at]
        owner = np.repeat(np.arange(len(windows)), windows)
        new = np.ones(total, dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
        place = np.arange(total)
        new |= (place - np.maximum.accumulate(np.where(new, place, 0))) % LONGEST_RUN == 0
        head = np.flatnonzero(new)
        self.begin, self.length = at[head], np.diff(np.concatenate([head, [total]]))
        self.owner, self.key = owner[head], least[head]
        span = self.length + width - 1
        equal = runs[ranges(self.begin, span)] == np.repeat(self.key, span)
        self.many = np.add.reduceat(equal, np.concatenate([[0], np.cumsum(span)[:-1]])) > 1
        if len(hot):
            place = np.minimum(np.searchsorted(hot, self.key), len(hot) - 1)
            self._open(hot[place] == self.key)

    def _open(self, hot: np.ndarray) -> None:
        """Cut the strings of hot minimisers into single windows, each with a
        key of its own words."""
        count = np.where(hot, self.length, 1)
        begin = ranges(self.begin, count)
        single = np.repeat(hot, count)
        self.owner, self.key, self.many = (np.repeat(x, count) for x in (self.owner, self.key, self.many))
        self.length = np.where(single, 1, np.repeat(self.length, count))
        self.begin = begin
        self.key[single] = _A.spans(self.words, begin[single], begin[single] + self.window)
        self.many[single] = False

    def minimiser_counts(self) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(self.key, return_counts=True)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """128-bit hash of each string's words."""
        end = self.begin + self.length + self.window - 1
        return _A.spans(self.words, self.begin, end), _B.spans(self.words, self.begin, end)

    def strings(self) -> list[bytes]:
        text, starts, ends = joined(self.data, self.starts, self.ends)
        last = self.begin + self.length + self.window - 2
        return [text[a:b] for a, b in zip(starts[self.begin].tolist(), ends[last].tolist(), strict=True)]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All words with one space between neighbours, and their new spans."""
    size = ends - starts
    if not len(size):
        return b"", starts, ends
    if (starts[1:] - ends[:-1] == 1).all():
        text = data[starts[0]:ends[-1]].copy()
        text[SPACES[text]] = 32
        return text.tobytes(), starts - starts[0], ends - starts[0]
    to = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    text = np.full(int(to[-1] + size[-1]), 32, dtype=np.uint8)
    text[ranges(to, size)] = data[ranges(starts, size)]
    return text.tobytes(), to, to + size


def _cuts(column: pa.Array, window: int, seed: int, hot: np.ndarray) -> Iterator[tuple[int, Cut]]:
    data, offsets = buffers(column)
    for lo, hi in chunks(offsets):
        yield lo, Cut(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], window, seed, hot)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def hot_minimisers(texts: DataFrame, window: int, seed: int, hot: int, listed: int) -> np.ndarray:
    """The minimisers of more than ``hot`` super-k-mers (the most frequent
    ``listed`` of them), counted over all documents."""
    none = np.zeros(0, np.uint64)

    def work(batches):
        for batch in batches:
            keys, counts = [], []
            for _, cut in _cuts(batch.column(0), window, seed, none):
                k, n = cut.minimiser_counts()
                keys.append(k)
                counts.append(n)
            if keys:
                keys, at = np.unique(np.concatenate(keys), return_inverse=True)
                counts = np.bincount(at, np.concatenate(counts), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([_signed(keys), pa.array(counts)], names=["key", "n"])

    counts = in_batches(texts, work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > hot)
    rows = counts.orderBy(F.desc("n"), "key").limit(listed).collect()
    return np.sort(np.array([r["key"] for r in rows], dtype=np.int64).view(np.uint64))


def packed_strings(texts: DataFrame, window: int, seed: int, hot: np.ndarray) -> DataFrame:
    """(key, many, packed, n): super-k-mers, equal ones of a batch counted."""

    def work(batches):
        held: dict[tuple[int, bool, bytes], int] = {}
        size = 0

        def flush():
            keys = np.array([k for k, _, _ in held], dtype=np.uint64)
            out = pa.RecordBatch.from_arrays(
                [_signed(keys), pa.array([m for _, m, _ in held], pa.bool_()), pa.array([s for _, _, s in held], pa.binary()),
                 pa.array(list(held.values()), pa.int64())], names=["key", "many", "packed", "n"])
            held.clear()
            return out

        for batch in batches:
            for _, cut in _cuts(batch.column(0), window, seed, hot):
                for item in zip(cut.key.tolist(), cut.many.tolist(), cut.strings(), strict=True):
                    seen = held.get(item, 0)
                    held[item] = seen + 1
                    if not seen:
                        size += len(item[2])
                if len(held) > HELD_STRINGS or size > HELD_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return in_batches(texts, work, "key long, many boolean, packed binary, n long")


def count_windows(strings: dict[bytes, int], window: int) -> dict[bytes, list[int]]:
    """For each string the (begin, end) word ranges covered by windows that
    stand at more than one place, from sorted windows."""
    windows: list[tuple[bytes, int, int]] = []
    order = list(strings)
    for i, s in enumerate(order):
        parts = s.split(b" ")
        size = [0]
        for p in parts:
            size.append(size[-1] + len(p) + 1)
        windows += [(s[size[j]:size[j + window] - 1], i, j) for j in range(len(parts) - window + 1)]
    windows.sort()
    repeated: dict[int, list[int]] = {}
    lo = 0
    while lo < len(windows):
        hi, n = lo, 0
        while hi < len(windows) and windows[hi][0] == windows[lo][0]:
            n += strings[order[windows[hi][1]]]
            hi += 1
        if n > 1:
            for _, i, j in windows[lo:hi]:
                repeated.setdefault(i, []).append(j)
        lo = hi
    return {order[i]: covered(sorted(js), window) for i, js in repeated.items()}


def covered(begins: list[int], window: int) -> list[int]:
    """Flat (begin, end) ranges of the words in windows at ``begins`` (sorted)."""
    out: list[int] = []
    for j in begins:
        if out and j <= out[-1]:
            out[-1] = j + window
        else:
            out += [j, j + window]
    return out


def bucket_decisions(strings: DataFrame, window: int) -> DataFrame:
    """(k1, k2, cover): the words to remove of each string that has any."""

    def answer(found: dict[bytes, list[int]]) -> pa.RecordBatch:
        text = b"".join(found)
        ends = np.cumsum([len(s) for s in found])
        data = np.frombuffer(text, np.uint8)
        starts, stops, first = split_words(data, np.concatenate([[0], ends]))
        words = _A.words(data, starts, stops)
        return pa.RecordBatch.from_arrays(
            [_signed(_A.spans(words, first[:-1], first[1:])), _signed(_B.spans(words, first[:-1], first[1:])),
             pa.array(list(found.values()), pa.list_(pa.int32()))], names=["k1", "k2", "cover"])

    def work(batches):
        found: dict[bytes, list[int]] = {}
        group: dict[bytes, int] = {}
        at, mixed = None, False

        def close():
            if len(group) == 1 and not mixed:
                (s, n), = group.items()
                if n > 1:
                    found[s] = [0, s.count(b" ") + 1]
            else:
                found.update(count_windows(group, window))
            group.clear()

        for batch in batches:
            for key, many, packed, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != at:
                    if group:
                        close()
                    at, mixed = key, False
                group[packed] = group.get(packed, 0) + n
                mixed |= many
            if len(found) > 20_000:
                yield answer(found)
                found = {}
        if group:
            close()
        if found:
            yield answer(found)

    ordered = strings.repartition("key").sortWithinPartitions("key")
    return in_batches(ordered, work, "k1 long, k2 long, cover array<int>")


def string_places(docs: DataFrame, window: int, seed: int, hot: np.ndarray) -> DataFrame:
    """(id, version, start, k1, k2): where each super-k-mer stands."""

    def work(batches):
        for batch in batches:
            for lo, cut in _cuts(batch.column(2), window, seed, hot):
                if len(cut.begin):
                    k1, k2 = cut.names()
                    row = pa.array(lo + cut.owner, pa.int64())
                    start = pa.array((cut.begin - cut.first[cut.owner]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(row), batch.column(1).take(row), start, _signed(k1), _signed(k2)],
                        names=["id", "version", "start", "k1", "k2"])

    return in_batches(docs, work, "id long, version int, start int, k1 long, k2 long")


def _removed(places: list[dict] | None, n_words: int) -> np.ndarray:
    gone = np.zeros(n_words + 1, np.int64)
    for p in places or ():
        for a, b in zip(p["cover"][::2], p["cover"][1::2], strict=True):
            gone[p["start"] + a] += 1
            gone[p["start"] + b] -= 1
    return np.cumsum(gone[:-1]) > 0


def kept_text(text: str, places: list[dict] | None) -> tuple[int, int, bytes]:
    """(words, removed words, the kept words joined by single spaces)."""
    words = text.encode("utf-8", "surrogatepass").split()
    if not places:
        return len(words), 0, b" ".join(words)
    gone = _removed(places, len(words))
    return len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def repeated_places(docs: DataFrame, window: int = WINDOW, seed: int = SEED, hot: int = HOT,
                    listed: int = HOT_LISTED) -> DataFrame:
    """(id, version, places): the word ranges to remove of each document that
    has any; ``version`` is a hash of the text."""
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    often = hot_minimisers(texts, window, seed, hot, listed)
    decisions = staged(bucket_decisions(packed_strings(texts, window, seed, often), window), "decisions")
    keyed = docs.select(F.col("doc_id").cast("long").alias("id"), F.hash("text").alias("version"),
                        F.coalesce("text", F.lit("")).alias("text"))
    places = string_places(keyed, window, seed, often).join(decisions, ["k1", "k2"])
    return staged(places.groupBy("id", "version").agg(
        F.collect_set(F.struct("start", "cover")).alias("places")), "places")


def deduplicate(docs: DataFrame, window: int = WINDOW, seed: int = SEED, digests: bool = False, **options) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): each document without the words of
    repeated windows; with ``digests`` the SHA-256 of the kept text instead."""
    found = repeated_places(docs, window, seed, **options)
    left = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.hash("text").alias("_v"),
                       F.coalesce("text", F.lit("")).alias("text"))
    both = left.join(found, left["doc_id"].eqNullSafe(found["id"]) & (left["_v"] == found["version"]), "left")
    name = "kept_sha256" if digests else "kept"

    def work(batches):
        for batch in batches:
            rows = [kept_text(t, p) for t, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            kept = [hashlib.sha256(k).hexdigest() if digests else k.decode("utf-8", "surrogatepass") for _, _, k in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([n for n, _, _ in rows], pa.int64()), pa.array([r for _, r, _ in rows], pa.int64()),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", name])

    return in_batches(both.select("doc_id", "text", "places"), work,
                      f"doc_id long, n_words long, n_removed long, {name} string")
