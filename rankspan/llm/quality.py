"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a whole text are computed for all documents of a chunk at once
(byte classes, word hashes, lines); the trees are trained on the driver from a
bounded labelled sample (``SAMPLE_PER_CLASS`` documents a class) and travel to
the tasks as four flat arrays, applied to all rows of a chunk in numpy.

Defined cases: null and empty texts have all statistics 0 and are scored like
any text; without usable labels every score is the share of label 1 (0.5 if
there are none at all); repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, in_batches
from .gbt import Trees, fit
from .labelled import class_counts, labelled_sample
from .textbuf import SpanHasher, buffers, chunks, mix, split_words

SAMPLE_PER_CLASS = 4000

STATISTICS = (
    "bytes", "words", "lines", "word_bytes", "longest_word", "upper", "lower", "digit", "space", "ascii_mark",
    "non_ascii", "exclaim", "pipe", "symbol", "stop_mark", "comma", "distinct_words", "top_word", "repeated_next",
    "longest_repeat", "distinct_lines", "line_bytes", "longest_line", "short_lines", "upper_words", "marked_words",
    "distinct_pairs", "brackets")


def _byte_classes() -> np.ndarray:
    """(256, classes) membership of each byte."""
    kind = np.zeros((256, 11), dtype=np.int64)
    code = np.arange(256)
    mark = (code > 32) & (code < 127) & ~((code >= 48) & (code <= 57)) & ~((code | 32) >= 97) | (code == 96)
    sets = [(code >= 65) & (code <= 90), (code >= 97) & (code <= 122), (code >= 48) & (code <= 57),
            np.isin(code, [9, 10, 11, 12, 13, 32]), mark, code >= 128, code == ord("!"), code == ord("|"),
            np.isin(code, [ord(c) for c in "#$%&*~^=+<>\\_"]), code == ord("."), code == ord(",")]
    for i, s in enumerate(sets):
        kind[:, i] = s
    return kind


_CLASSES = _byte_classes()
_HASHER = SpanHasher(7)


def _per_document(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(values)])
    return (total[first[1:]] - total[first[:-1]]).astype(float)


def _longest(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(len(first) - 1)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = np.maximum.reduceat(values, first[full])
    return out


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values per owner and the count of the most frequent one."""
    if not len(hashes):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])
    at = np.flatnonzero(new)
    size = np.diff(np.concatenate([at, [len(h)]]))
    top = np.zeros(n)
    np.maximum.at(top, o[at], size)
    return np.bincount(o[at], minlength=n).astype(float), top


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS per document."""
    n = len(offsets) - 1
    starts, ends, first = split_words(data, offsets)
    size = np.diff(offsets).astype(float)
    words = np.diff(first).astype(float)
    owner = np.repeat(np.arange(n), np.diff(first))
    line = np.zeros(256, dtype=bool)
    line[10] = True
    ls, le, lf = split_words(data, offsets, line)
    lines = np.diff(lf).astype(float)
    line_owner = np.repeat(np.arange(n), np.diff(lf))
    histogram = np.zeros((n, 256))
    for i in range(n):
        histogram[i] = np.bincount(data[offsets[i]:offsets[i + 1]], minlength=256)
    share = (histogram @ _CLASSES) / np.maximum(size, 1)[:, None]
    brackets = histogram[:, [ord(c) for c in "()[]{}"]].sum(axis=1) / np.maximum(size, 1)
    h = _HASHER.words(data, starts, ends)
    length = ends - starts
    same = np.zeros(len(h), dtype=bool)
    same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    run = np.arange(len(h)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(h)))) if len(h) else np.zeros(0)
    distinct, top = _distinct(h, owner, n)
    pair = mix(h[:-1] * np.uint64(3) + h[1:])[owner[1:] == owner[:-1]] if len(h) else h
    pairs, _ = _distinct(pair, owner[1:][owner[1:] == owner[:-1]], n)
    line_distinct, _ = _distinct(_HASHER.words(data, ls, le), line_owner, n)
    upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90))])
    letters = upper[ends] - upper[starts]
    last = data[ends - 1] if len(ends) else data[:0]
    marked = _CLASSES[last, 4] if len(last) else np.zeros(0)
    per_word, per_line = np.maximum(words, 1), np.maximum(lines, 1)
    line_size = le - ls
    return np.column_stack([
        size, words, lines, _per_document(length, first) / per_word, _longest(length, first), share,
        distinct / per_word, top / per_word, _per_document(same, first) / per_word, _longest(run, first),
        line_distinct / per_line, _per_document(line_size, lf) / per_line, _longest(line_size, lf),
        _per_document(line_size < 20, lf) / per_line, _per_document(letters >= 2, first) / per_word,
        _per_document(marked, first) / per_word, pairs / np.maximum(words - 1, 1), brackets])


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, y if present, stats array<double>)."""
    keep = [c for c in ("doc_id", "y") if c in docs.columns]
    kinds = {"doc_id": "doc_id long", "y": "y int"}

    def work(batches):
        for batch in batches:
            stats = [row for data, off in _texts(batch.column(len(keep))) for row in statistics(data, off)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [pa.array(stats, pa.list_(pa.float64()))],
                names=[*keep, "stats"])

    return in_batches(docs.select(*keep, "text"), work, ", ".join([*(kinds[k] for k in keep), "stats array<double>"]))


def _texts(column: pa.Array):
    data, offsets = buffers(column)
    for lo, hi in chunks(offsets):
        yield data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = SAMPLE_PER_CLASS) -> Trees:
    rows = document_statistics(labelled_sample(docs, labels, "quality", learn, per_class)).collect()
    x = np.array([r["stats"] for r in rows], dtype=float).reshape(len(rows), len(STATISTICS))
    y = np.array([r["y"] for r in rows], dtype=float)
    order = np.argsort([r["doc_id"] for r in rows], kind="stable")
    return fit(x[order], y[order], weight=class_weights(y[order], class_counts(labels, "quality", learn)))


def class_weights(y: np.ndarray, share: dict[int, int]) -> np.ndarray:
    """Row weights (1 on the mean) that give a sample the classes' shares of all
    labelled rows, whatever number of rows was drawn of each."""
    drawn = {c: max(1, np.count_nonzero(y == c)) for c in (0, 1)}
    weight = np.where(y == 1, share.get(1, 0) / drawn[1], share.get(0, 0) / drawn[0])
    return weight / weight.mean() if len(y) else weight


def score(docs: DataFrame, model: Trees, held_out: Callable[[Column], Column]) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def work(batches):
        for batch in batches:
            p = [model.probability(statistics(data, off)) for data, off in _texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(p) if p else [], pa.float64())],
                                             names=["doc_id", "score"])

    scored = in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work,
                        "doc_id long, score double")
    return scored.select("doc_id", held_out(crc_of_id("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """Learn from rows whose crc32 of the id is not 1 modulo 3; score all."""
    model = train(docs, labels, crc_of_id("doc_id") % 3 != 1, per_class)
    return score(docs, model, lambda crc: F.coalesce(crc % 3 == 1, F.lit(False)))
