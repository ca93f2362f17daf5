"""Toxicity by compression distance.

Two zstandard dictionaries: one is trained by ``zstandard.train_dictionary`` on
windows of ordinary text; the other is not trained but strung together from the
words of toxic texts that ordinary texts hardly use, the most frequent nearest
to the text (trained on whole toxic windows it is mostly ordinary wording and
finds far less, see README).  It is followed by the same ordinary content, so
that both compress ordinary wording alike.  A text is cut into windows at word
borders; a window's gain is its compressed length under the ordinary dictionary
minus that under the toxic one.  The number of windows over calibrated gains
and the largest gains, put through a logistic calibration, give the score.

Training uses a bounded labelled sample (``SAMPLE_PER_CLASS`` documents a class,
none longer than ``LONGEST_SAMPLE`` bytes); one half builds the dictionaries,
the other half calibrates.  Toxic words are told by their beginnings: those that
stand in toxic texts far more often than in ordinary ones, copies of a text
counted once, by more than chance (``EVIDENCE``).  Where they stand, and what
stands before them, does not matter.

Defined cases: null and empty texts have no windows and are scored from that;
without labels of both classes every score is 0; repeated rows score alike;
very long texts are scored whole; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import text_chunks
from .common import crc_of_id, fresh_name, in_batches, widened
from .labelled import class_counts, labelled_sample

SAMPLE_PER_CLASS = 3000
LONGEST_SAMPLE = 32 << 10
WINDOW = 96
ORDINARY_DICTIONARY = 16 << 10
TOXIC_DICTIONARY = 8 << 10
STEMS = (4, 5, 6, 8)
# likelihood ratio that chance exceeds once in ten thousand (chi-square, one degree of freedom)
EVIDENCE = 15.13
# a text is a copy if it shares so much of its runs of COPY_RUN words with one text before it
COPY_SHARE, COPY_RUN = 0.5, 5


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """Consecutive pieces of about ``size`` bytes, cut at white space (a longer
    word is cut hard); white space is squeezed."""
    text = b" ".join(text.split())
    out, at, n = [], 0, len(text)
    while at < n:
        end = at + size
        if end >= n:
            out.append(text[at:])
            break
        cut = text.rfind(b" ", at, end + 1)
        if cut <= at:
            cut = end
        out.append(text[at:cut])
        at = cut + (text[cut:cut + 1] == b" ")
    return out


@dataclass
class Model:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray          # logistic weights of features()
    gains: tuple[int, ...]       # calibrated window gains that are counted

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        raw = zstandard.DICT_TYPE_RAWCONTENT
        self.tools = []
        for content in (model.ordinary, model.toxic):
            data = zstandard.ZstdCompressionDict(content, dict_type=raw)
            parameters = zstandard.ZstdCompressionParameters(
                strategy=zstandard.STRATEGY_LAZY2, window_log=17, hash_log=14, chain_log=15, search_log=5, min_match=5,
                write_content_size=0, write_checksum=0, write_dict_id=0)
            data.precompute_compress(compression_params=parameters)
            self.tools.append(zstandard.ZstdCompressor(dict_data=data, compression_params=parameters).compress)

    def gain(self, parts: list[bytes]) -> np.ndarray:
        ordinary, toxic = self.tools
        return np.array([len(ordinary(p)) - len(toxic(p)) for p in parts], dtype=np.int64)

    def features(self, text: str) -> np.ndarray:
        return features(self.gain(windows(text.lower().encode())), self.model.gains)

    def score(self, text: str) -> float:
        return float(1.0 / (1.0 + np.exp(-np.clip(self.features(text) @ self.model.weights, -500, 500))))


def features(gain: np.ndarray, levels: tuple[int, ...]) -> np.ndarray:
    top = np.sort(gain)[::-1][:3].astype(float)
    top = np.concatenate([top, np.zeros(3 - len(top))])
    counts = [np.log1p(np.count_nonzero(gain >= level)) for level in levels]
    shares = [np.count_nonzero(gain >= level) / max(1, len(gain)) for level in levels]
    mean = [gain.mean(), np.maximum(gain, 0).mean()] if len(gain) else [0.0, 0.0]
    return np.array([1.0, *top, *counts, *shares, *mean, np.log1p(len(gain))])


def _stems(word: bytes) -> set[bytes]:
    return {word[:k] for k in STEMS if len(word) >= k} | {word}


def without_copies(texts: list[bytes]) -> list[bytes]:
    """``texts`` without exact and near copies of an earlier one."""
    holders: dict[bytes, list[int]] = {}
    kept = []
    for x in texts:
        words = x.split()
        runs = {b" ".join(words[i:i + COPY_RUN]) for i in range(max(1, len(words) - COPY_RUN + 1))}
        shared = Counter(k for r in runs for k in holders.get(r, ()))
        if max(shared.values(), default=0) >= COPY_SHARE * len(runs):
            continue
        for r in runs:
            holders.setdefault(r, []).append(len(kept))
        kept.append(x)
    return kept


def told_stems(toxic: list[bytes], ordinary: list[bytes], ratio: float) -> set[bytes]:
    """Word beginnings that stand in toxic texts ``ratio`` times as often as in
    ordinary ones, by a likelihood ratio of ``EVIDENCE`` or more."""
    t, o = Counter(), Counter()
    for texts, counter in ((toxic, t), (ordinary, o)):
        for x in texts:
            counter.update({s for w in set(x.split()) for s in _stems(w)})
    n_t, n_o, told = len(toxic), max(1, len(ordinary)), set()
    for s, a in t.items():
        b = o[s]
        if (a / n_t) / ((b + 0.5) / n_o) < ratio:
            continue
        p = (a + b) / (n_t + n_o)
        if 2 * (a * np.log(a / n_t / p) + (b * np.log(b / n_o / p) if b else 0.0)) >= EVIDENCE:
            told.add(s)
    return told


def passages(toxic: list[bytes], ordinary: list[bytes], ratio: float = 12.0) -> list[bytes]:
    """The words of toxic texts (copies left out) with told stems."""
    toxic = without_copies(toxic)
    told = told_stems(toxic, without_copies(ordinary), ratio)
    return [b" " + w + b" " for x in toxic for w in x.split() if not told.isdisjoint(_stems(w))]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """Content of a trained dictionary; with too little text for training, the
    most frequent samples themselves (the most frequent at the end, nearest)."""
    try:
        data = zstandard.train_dictionary(size, samples, k=64, d=6, steps=1, split_point=1.0)
        return data.as_bytes()
    except zstandard.ZstdError:
        common = [s for s, _ in Counter(samples).most_common()]
        out = b""
        for s in common:
            if len(out) + len(s) > size:
                break
            out = s + out
        return out


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-2) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + l2 * w
        hess = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def train_on(rows: list[tuple[str, int]], share: dict[int, int]) -> Model | None:
    """Model from (text, label) rows; ``share``: rows of each class in all."""
    texts = [(b" ".join(t.lower().encode().split()), y) for t, y in rows]
    by = {y: [t for t, v in texts if v == y] for y in (0, 1)}
    if len(by[0]) < 2 or len(by[1]) < 2:
        return None
    by = {y: list(dict.fromkeys(v)) for y, v in by.items()}
    build = {y: v[::2] for y, v in by.items()}
    ordinary = [w for t in build[0] for w in windows(t)]
    common = _dictionary(ordinary[:40_000], ORDINARY_DICTIONARY)
    own = _toxic_content(Counter(passages(build[1], build[0])))
    model = Model(common, own + b" " + common, np.zeros(0), ())
    scorer = Scorer(model)
    held = [(t, y) for y, v in by.items() for t in v[1::2]]
    gains = [scorer.gain(windows(t)) for t, _ in held]
    y = np.array([v for _, v in held], dtype=float)
    model.gains = calibrated_gains(gains, y)
    x = np.array([features(g, model.gains) for g in gains])
    weight = np.where(y == 1, share[1] / max(1, y.sum()), share[0] / max(1, (1 - y).sum()))
    model.weights = _logistic(x, y, weight / weight.mean())
    return model


def _toxic_content(counts: Counter, size: int = TOXIC_DICTIONARY) -> bytes:
    """Toxic dictionary: the most frequent passages, those nearest to the text."""
    near = b""
    for w, _ in counts.most_common():
        if len(near) + len(w) > size:
            break
        near = w + near
    return near


def calibrated_gains(gains: list[np.ndarray], y: np.ndarray) -> tuple[int, ...]:
    """Window gains over which toxic texts stand out: the level with the best
    balanced accuracy of 'any window reaches it', and the levels
    two below and above."""
    largest = np.array([g.max() if len(g) else -99 for g in gains])
    best, at = -1.0, 1
    for level in range(1, 16):
        hit = largest >= level
        value = hit[y == 1].mean() - hit[y == 0].mean()
        if value > best:
            best, at = value, level
    return (max(1, at - 2), at, at + 2)


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    share = class_counts(labels, "toxic", learn)
    if len(share) < 2:
        return None
    rows = labelled_sample(docs, labels, "toxic", learn, per_class, LONGEST_SAMPLE).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return train_on([(r["text"], r["y"]) for r in rows], share)


def with_score(docs: DataFrame, model: Model | None, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a toxicity score of every whole text."""
    docs = docs.drop(score_col)
    if model is None:
        return docs.withColumn(score_col, F.lit(0.0))
    schema = widened(docs, score_col, "double")
    names = docs.columns

    def work(batches):
        scorer = model.scorer()
        for batch in batches:
            scores = [scorer.score(t) for texts in text_chunks(batch.column(names.index(text_col))) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*names, score_col])

    return in_batches(docs, work, schema)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """(doc_id, held_out, score, predicted): learned from rows whose crc32 of
    the id is not 0 modulo 5, applied to all."""
    crc = crc_of_id("doc_id")
    model = train(docs, labels, crc % 5 != 0, per_class)
    scored = with_score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select("doc_id", F.coalesce(crc % 5 == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents scored toxic (0.5 or more)."""
    model = train(docs, labels, crc_of_id("doc_id") % 5 != 0)
    score = fresh_name(docs, "_toxic_score")
    return with_score(docs, model, score_col=score).where(F.col(score) < 0.5).drop(score)
