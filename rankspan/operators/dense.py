"""Exact dense k-nearest-neighbour search by cosine similarity.

Every document is considered -- the reference ranks the whole corpus -- but the
corpus does not move.  The queries are cut into blocks of a checked size; a block
is broadcast, and the corpus streams past it in ``mapInArrow``: a task multiplies
``STREAM_ROWS`` documents at a time with numpy and keeps the k best of each query.
A piece is skipped for the queries that it cannot improve: with centre c and
radius r of its unit vectors no document scores more than q.c + r, which is
compared with the k-th best score so far.  Only k rows per query and task are
shuffled, and a final ``row_number`` window merges them.  Memory per task is
bounded by the block however many queries or documents there are.

Ties resolve as in the vector retriever: score desc (rounded to 9 digits), then
pos desc -- inside the task already, so zero vectors or crowds of equal
documents cost no more rows than any other query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import attach_fields, score_key, spread, stage, top_k

BLOCK_BYTES = 32 << 20      # vectors of one block of queries
STREAM_ROWS = 1024          # documents multiplied at once
BLOCK_CELLS = 4_000_000     # scores held at once inside a task


def vectors(column) -> np.ndarray:
    """list<double> Arrow column of equal-length rows -> (rows, width) float64."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(n, len(flat) // n) if n else np.zeros((0, 0))


def _unit_rows(m: np.ndarray) -> np.ndarray:
    norms = np.sqrt((m * m).sum(axis=1))
    out = np.zeros_like(m)
    nz = norms > 0
    out[nz] = m[nz] / norms[nz, None]
    return out


def block_top_k(queries: np.ndarray, docs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, doc row, score): exactly min(k, docs) rows per query; of equal
    rounded scores the earlier document row counts as nearer."""
    n, qs, ds, ss = len(docs), [], [], []
    step = max(1, BLOCK_CELLS // max(1, n))
    for lo in range(0, len(queries), step):
        scores = queries[lo:lo + step] @ docs.T
        key = np.round(scores, 9)
        least = np.partition(key, n - k, axis=1)[:, n - k] if n > k else np.full(len(scores), -np.inf)
        for i, row in enumerate(key):
            rows = np.flatnonzero(row > least[i])
            if len(rows) < min(k, n):
                rows = np.concatenate([rows, np.flatnonzero(row == least[i])[:k - len(rows)]] if n > k else [np.arange(n)])
            qs.append(np.full(len(rows), lo + i))
            ds.append(rows)
            ss.append(scores[i, rows])
    if not qs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return np.concatenate(qs), np.concatenate(ds), np.concatenate(ss)


def _types(queries: DataFrame, corpus: DataFrame) -> str:
    qt = dict(queries.dtypes)["query_id"]
    ct = dict(corpus.dtypes)
    return f"query_id {qt}, doc_id {ct['doc_id']}, pos {ct['pos']}, vector_score double"


def _blocks(df: DataFrame) -> int:
    size = df.agg(F.sum(F.size("embedding")).alias("n")).first()["n"] or 0
    return max(1, -(-8 * size // BLOCK_BYTES))


class _Best:
    """The k best documents of each query among those seen so far."""

    def __init__(self, queries: np.ndarray, k: int, kind: pa.DataType):
        self.queries, self.k = queries, k
        self.least = np.full(len(queries), -np.inf)      # rounded k-th best score
        self.q, self.score, self.pos = np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.ids = pa.array([], kind)

    def add(self, docs: np.ndarray, pos: np.ndarray, ids: pa.Array) -> int:
        """Consider documents (unit rows, later pos first); the number of products formed."""
        centre = docs.mean(axis=0)
        radius = np.sqrt(((docs - centre) ** 2).sum(axis=1).max())
        live = np.flatnonzero(self.queries @ centre + radius + 1e-8 >= self.least)
        step = max(1, BLOCK_CELLS // len(docs))
        for lo in range(0, len(live), step):
            part = live[lo:lo + step]
            scores = self.queries[part] @ docs.T
            q, d = np.nonzero(np.round(scores, 9) >= self.least[part, None])
            value = scores[q, d]
            if len(q) > 4 * self.k * len(part):          # first pieces, crowds of equal documents
                q, d, value = block_top_k(self.queries[part], docs, self.k)
            self._merge(part[q], value, pos[d], ids.take(pa.array(d)))
        return len(live) * len(docs)

    def _merge(self, q: np.ndarray, score: np.ndarray, pos: np.ndarray, ids: pa.Array) -> None:
        if not len(q):
            return
        q, score, pos = np.concatenate([self.q, q]), np.concatenate([self.score, score]), np.concatenate([self.pos, pos])
        ids = pa.concat_arrays([self.ids, ids])
        order = np.lexsort((-pos, -np.round(score, 9), q))
        first = np.searchsorted(q[order], np.arange(len(self.queries)))
        rank = np.arange(len(q)) - first[q[order]]
        order = order[rank < self.k]
        self.q, self.score, self.pos, self.ids = q[order], score[order], pos[order], ids.take(pa.array(order))
        full = rank[rank < self.k] == self.k - 1
        self.least[self.q[full]] = np.round(self.score[full], 9)


def _block_knn(block: pa.Table, corpus: DataFrame, k: int, schema: str) -> tuple[DataFrame, object]:
    """(query_id, doc_id, pos, vector_score): k rows per query and task."""
    spark = corpus.sparkSession
    shared = spark.sparkContext.broadcast((block.column("query_id").combine_chunks(), _unit_rows(vectors(block.column("embedding")))))

    def run(batches):
        names, queries = shared.value
        best = None
        for batch in batches:
            best = best or _Best(queries, k, batch.column(0).type)
            for lo in range(0, batch.num_rows, STREAM_ROWS):
                piece = batch.slice(lo, STREAM_ROWS)
                pos = piece.column(1).to_numpy(zero_copy_only=False)
                order = np.argsort(-pos, kind="stable")
                best.add(_unit_rows(vectors(piece.column(2)))[order], pos[order], piece.column(0).take(pa.array(order)))
        if best is not None and len(best.q):
            yield pa.RecordBatch.from_arrays([names.take(pa.array(best.q)), best.ids, pa.array(best.pos), pa.array(best.score)],
                                             names=["query_id", "doc_id", "pos", "vector_score"])

    return corpus.mapInArrow(run, schema), shared


def dense_knn(queries: DataFrame, corpus: DataFrame, k: int = 5, q_blocks: int | None = None,
              c_blocks: int | None = None, fields: DataFrame | None = None) -> DataFrame:
    """Top-k documents per query by cosine similarity of L2-normalised vectors.

    queries: (query_id, embedding array<double>); corpus: (doc_id, pos,
    embedding).  Returns (query_id, rank, doc_id, pos, vector_score) and, given a
    corpus table ``fields``, its columns for each document.  The corpus is read
    once per block of queries, where it lies; ``c_blocks`` deals it over that many
    partitions first."""
    if k < 0:
        raise ValueError("top_k must be >= 0")
    if k == 0:
        schema = _types(queries, corpus).replace("pos", "rank int, pos", 1)
        return corpus.sparkSession.createDataFrame([], schema)
    ship_package(queries.sparkSession)
    q_blocks = q_blocks or _blocks(queries)
    asked = queries.select("query_id", "embedding")
    docs = corpus.select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("embedding").cast("array<double>").alias("embedding"))
    docs = docs.repartition(c_blocks) if c_blocks else spread(docs)
    schema = _types(queries, docs)
    partial = None
    for i in range(q_blocks):
        block = asked if q_blocks == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)) == i)
        block = block.toArrow()                              # at most about BLOCK_BYTES
        if not block.num_rows:
            continue
        part, shared = _block_knn(block, docs, k, schema)
        if q_blocks > 1:                                     # the driver holds one block at a time
            part = stage(part, "knn-part")
            shared.destroy()
        partial = part if partial is None else partial.unionByName(part)
    if partial is None:
        partial = corpus.sparkSession.createDataFrame([], schema)
    ranked = top_k(partial.withColumn("_sk", score_key("vector_score")), ["query_id"],
                   [F.col("_sk").desc(), F.col("pos").desc()], k)
    ranked = ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "pos", "vector_score")
    return attach_fields(ranked, fields) if fields is not None else ranked
