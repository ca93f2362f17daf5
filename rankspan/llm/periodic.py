"""Periodic runs of words by recompression.

A run is a stretch of consecutive words of one document with smallest period q
(words q apart are identical), of at least ``max(6, 4 q)`` words, that no
neighbouring word extends.  Texts are sorted in no suffix array; instead the
documents of a chunk become one run-length grammar:

* Block compression replaces each maximal block of one symbol by a symbol for
  (symbol, length); pair compression parts the alphabet into left and right
  symbols and replaces each left symbol that a right one follows.  Both look at
  symbols only, so equal stretches are parsed alike but for their ends.  The
  rounds alternate until each document is one symbol; a round of pairs leaves
  about three quarters of the symbols, so there are logarithmically many.
* An LCE query (how far do the texts from i and from j agree?) climbs while both
  places are equal symbols, steps over at most one symbol or block a level to
  reach the start of a parent, and descends from the first unequal pair, again
  with one step a level.  Queries of a chunk are answered together, a level at a
  time, in either direction.
* Candidates lie on a harmonic grid: a run of period p holds a place i, a
  multiple of 3 p, with i + p in it (four periods leave 3 p such places), so
  n / (3 p) places for each p <= n / 4, n log n in all, are looked at.  Those
  where the two words agree are extended exactly by grammar queries in both
  directions.  Of a stretch found with several periods the smallest counts: with
  four periods the others are its multiples (Fine and Wilf).

Everything happens within a task and there is no shuffle; memory follows the
chunk (``CHUNK_BYTES``) or the longest single text.

Words are ``[^\\x20\\x09-\\x0D]+``.  Defined cases: null, empty and short texts
have no run; repeated rows are treated alike; null ids and extra columns (any
name) are allowed.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, in_batches
from .substring import joined
from .textbuf import buffers, chunks, mix, ranges, split_words

LEAST_WORDS = 6
LEAST_PERIODS = 4
CANDIDATES = 1 << 20          # grid places held at once


@dataclass
class Level:
    symbols: np.ndarray
    up: np.ndarray            # parent of each symbol
    head: np.ndarray          # first child of each parent; one more entry closes the last
    blocks: bool              # a round of blocks, or of pairs


class Grammar:
    """Run-length grammar of a sequence; ``walls`` marks symbols that occur once
    and are never merged (they stand between documents and at both ends)."""

    def __init__(self, symbols: np.ndarray, walls: np.ndarray):
        self.levels: list[Level] = []
        s, wall = symbols.astype(np.int64), walls
        fresh = int(s.max()) + 1 if len(s) else 0
        salt = 0
        while True:
            new = np.ones(len(s), dtype=bool)
            new[1:] = s[1:] != s[:-1]
            if not new.all():
                s, wall, fresh = self._blocks(s, wall, new, fresh)
            inner = ~wall[:-1] & ~wall[1:]
            if not inner.any():
                break
            starts = self._pairs(s, wall, salt)
            salt += 1
            if len(starts):
                s, wall, fresh = self._merge(s, wall, starts, fresh)
        self.top = s

    def _push(self, s: np.ndarray, new: np.ndarray, blocks: bool) -> np.ndarray:
        head = np.flatnonzero(new)
        self.levels.append(Level(s, np.cumsum(new) - 1, np.append(head, len(s)), blocks))
        return head

    def _blocks(self, s, wall, new, fresh):
        head = self._push(s, new, True)
        count = np.diff(self.levels[-1].head)
        out = s[head].copy()
        many = np.flatnonzero(count > 1)
        names, place = np.unique(out[many] * (int(count.max()) + 1) + count[many], return_inverse=True)
        out[many] = fresh + place
        return out, wall[head], fresh + len(names)

    @staticmethod
    def _pairs(s, wall, salt):
        """Places of a left symbol before a right one, for the better of the two
        ways round."""
        right = (mix(s + (salt << 40)) & np.uint64(1 << 33)) != 0
        free = ~wall
        a, b = free & ~right, free & right
        one, two = a[:-1] & b[1:], b[:-1] & a[1:]
        return np.flatnonzero(one if np.count_nonzero(one) >= np.count_nonzero(two) else two)

    def _merge(self, s, wall, starts, fresh):
        new = np.ones(len(s), dtype=bool)
        new[starts + 1] = False
        head = self._push(s, new, False)
        out = s[head].copy()
        names, place = np.unique(s[starts] * fresh + s[starts + 1], return_inverse=True)
        out[self.levels[-1].up[starts]] = fresh + place
        return out, wall[head], fresh + len(names)

    def extend(self, i: np.ndarray, j: np.ndarray, forward: bool = True) -> np.ndarray:
        """The number of equal symbols from i and j on (or back, both included)."""
        at, bt = i.copy(), j.copy()
        stop = np.full(len(i), len(self.levels))
        live = np.arange(len(i))
        for t, level in enumerate(self.levels):
            equal = level.symbols[at[live]] == level.symbols[bt[live]]
            stop[live[~equal]] = t
            live = live[equal]
            if not len(live):
                break
            a, b = at[live], bt[live]
            pa_, pb = level.up[a], level.up[b]
            if forward:
                ra, rb = level.head[pa_ + 1] - a, level.head[pb + 1] - b
                aligned = (level.head[pa_] == a) & (level.head[pb] == b)
            else:
                ra, rb = a - level.head[pa_] + 1, b - level.head[pb] + 1
                aligned = (level.head[pa_ + 1] - 1 == a) & (level.head[pb + 1] - 1 == b)
            # equal symbols: in a round of pairs both end their parents here, in a
            # round of blocks the shorter rest decides
            step = np.where(aligned, 0, np.minimum(ra, rb))
            a, b = (a + step, b + step) if forward else (a - step, b - step)
            ended = ~aligned & (ra != rb)
            at[live], bt[live] = a, b
            stop[live[ended]] = t
            live = live[~ended]
            at[live], bt[live] = level.up[a[~ended]], level.up[b[~ended]]
        for t in range(len(self.levels) - 1, -1, -1):
            level = self.levels[t]
            down = np.flatnonzero(stop > t)
            if not len(down):
                continue
            a, b = at[down], bt[down]
            la, lb = level.head[a + 1] - level.head[a], level.head[b + 1] - level.head[b]
            a, b = (level.head[a], level.head[b]) if forward else (level.head[a + 1] - 1, level.head[b + 1] - 1)
            step = np.where(level.symbols[a] == level.symbols[b], np.minimum(la, lb) if level.blocks else 1, 0)
            at[down], bt[down] = (a + step, b + step) if forward else (a - step, b - step)
        return at - i if forward else i - at


def find_runs(words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length, period) of all runs, by document, start, period.

    words: integer codes of the words of all documents; first: index of each
    document's first word (one more entry closes the last)."""
    none = (np.zeros(0, np.int64),) * 4
    count = np.diff(first)
    n = len(count)
    periods = np.where(count >= LEAST_WORDS, count // LEAST_PERIODS, 0)
    if not periods.sum():
        return none
    # document d starts at first[d] + d + 1: a wall stands before each and at the end
    base = first[:-1] + np.arange(1, n + 1)
    text = np.empty(len(words) + n + 1, np.int64)
    walls = np.zeros(len(text), dtype=bool)
    walls[np.append(base - 1, len(text) - 1)] = True
    text[~walls] = words
    text[walls] = (int(words.max()) + 1 if len(words) else 0) + np.arange(n + 1)
    owner = np.repeat(np.arange(n), periods)
    period = ranges(np.ones(n, np.int64), periods)
    gap = LEAST_PERIODS - 1
    grid = (count[owner] - 1 - period) // (gap * period) + 1
    total = np.cumsum(grid)
    cuts = np.unique(np.searchsorted(total, np.arange(CANDIDATES, total[-1] + CANDIDATES, CANDIDATES)) + 1).clip(max=len(grid))
    grammar, found, lo = None, [], 0
    for hi in np.unique(cuts).tolist():
        size = grid[lo:hi]
        p = np.repeat(period[lo:hi], size)
        d = np.repeat(owner[lo:hi], size)
        i = base[d] + ranges(np.zeros(hi - lo, np.int64), size) * gap * p
        lo = hi
        same = text[i] == text[i + p]
        i, p, d = i[same], p[same], d[same]
        if not len(i):
            continue
        grammar = grammar or Grammar(text, walls)
        ahead = grammar.extend(i, i + p)
        behind = grammar.extend(i - 1, i + p - 1, forward=False)
        length = ahead + behind + p
        long = length >= np.maximum(LEAST_WORDS, LEAST_PERIODS * p)
        found.append(np.stack([d, i - behind - base[d], length, p])[:, long])
    if not found:
        return none
    d, start, length, p = np.concatenate(found, axis=1)
    order = np.lexsort((p, length, start, d))
    d, start, length, p = d[order], start[order], length[order], p[order]
    new = np.ones(len(d), dtype=bool)
    new[1:] = (d[1:] != d[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    d, start, length, p = d[new], start[new], length[new], p[new]
    order = np.lexsort((p, start, d))
    return d[order], start[order], length[order], p[order]


def planted(count: np.ndarray, first: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """Source word of each word under the rewriting of the contract: of a document
    whose crc h is a multiple of 10, word i >= a becomes word a + (i - a) % p."""
    out = np.arange(int(first[-1]), dtype=np.int64)
    for d in np.flatnonzero((crc % 10 == 0) & (crc >= 0) & (count > 0)).tolist():
        n, g = int(count[d]), int(crc[d]) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        lo = int(first[d])
        out[lo + a:lo + n] = lo + a + np.arange(n - a) % p
    return out


def _collapsed(data: np.ndarray, offsets: np.ndarray, crc: np.ndarray | None):
    """For each document of a chunk: (runs as (k, 3) array, kept text)."""
    starts, ends, first = split_words(data, offsets)
    source = None
    if crc is not None:
        source = planted(np.diff(first), first, crc)
        starts, ends = starts[source], ends[source]
    text, to, to_end = joined(data, starts, ends)
    spans = pa.array(np.append(to, len(text) + 1) if len(to) else np.zeros(1, np.int64)).cast(pa.int64())
    column = pa.Array.from_buffers(pa.large_binary(), len(to), [None, spans.buffers()[1], pa.py_buffer(text + b" ")])
    codes = column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    d, start, length, period = find_runs(codes, first)
    gone = np.zeros(len(to) + 1, np.int64)
    np.add.at(gone, first[d] + start + period, 1)
    np.add.at(gone, first[d] + start + length, -1)
    kept = np.cumsum(gone[:-1]) == 0
    if not kept.all():
        starts, ends = starts[kept], ends[kept]
        text, to, to_end = joined(data, starts, ends)
        first = np.concatenate([[0], np.cumsum(kept)])[first]
    runs_at = np.searchsorted(d, np.arange(len(offsets)))
    runs = np.stack([start, length, period], axis=1)
    for k in range(len(offsets) - 1):
        a, b = int(first[k]), int(first[k + 1])
        yield runs[runs_at[k]:runs_at[k + 1]], text[int(to[a]):int(to_end[b - 1])] if b > a else b""


def _work(digests: bool, rewrite: bool):
    def rows(batch):
        data, offsets = buffers(batch.column(1))
        crc = batch.column(2).fill_null(-1).to_numpy(zero_copy_only=False) if rewrite else None
        for lo, hi in chunks(offsets):
            yield from _collapsed(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], None if crc is None else crc[lo:hi])

    def full(batches):
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            runs, texts = [], []
            for r, t in rows(batch):
                runs.append([{"start": a, "length": b, "period": c} for a, b, c in r.tolist()])
                texts.append(t.decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(runs, kind), pa.array(texts, pa.string())],
                                             names=["doc_id", "runs", "collapsed"])

    def digest(batches):
        for batch in batches:
            out = []
            for r, t in rows(batch):
                best = None
                for a, b, c in r.tolist():
                    if best is None or (Fraction(b, c), -a, -c) > (Fraction(best[1], best[2]), -best[0], -best[2]):
                        best = (a, b, c)
                lines = "".join(f"{a},{b},{c}\n" for a, b, c in r.tolist())
                out.append((len(r), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(t).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.string()) for c in columns[5:])],
                names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return digest if digests else full


def collapse_runs(docs: DataFrame, digests: bool = False, rewrite: bool = False) -> DataFrame:
    """(doc_id, runs, collapsed): all runs of each text, and its words without
    those that stand in a run after its first period, joined by single spaces.
    With ``digests`` counts, the run of greatest exponent and SHA-256 digests
    instead; with ``rewrite`` the texts are first rewritten as ``planted`` says
    (documents without an id are not)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                        *([crc_of_id("doc_id").alias("crc")] if rewrite else []))
    schema = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
              "collapsed_sha256 string" if digests else
              "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    return in_batches(texts, _work(digests, rewrite), schema)
