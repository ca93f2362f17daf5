"""LSA: TF-IDF followed by a distributed randomised truncated SVD.

Randomised subspace iteration (Halko, Martinsson & Tropp, 2011) on the TF-IDF
triplets X (document, term, weight), with l = n_components + n_oversamples
columns.  It runs on the document side:

    Q = orth(Gaussian),  then n_iter + 1 times  Q = orth(X X^T Q)
    Q^T X X^T Q = U S^2 U^T
    components V = X^T P,  P = Q M           M = U S^-1
    document embeddings X V = (X X^T Q) M

* Documents lie in blocks of about ``BLOCK_DOCS`` (by a hash of the id).  A matrix of
  a row for each document is a table of blocks (block, vec: columns x documents).
* A term that occurs in one document only (most bigrams) adds w^2 to that
  document's diagonal entry of X X^T.  Such terms are folded into one number per
  document and never enter the iteration.
* X is S T D: a document's factor (1 / norm), a term's idf, and between them factors of
  the tf, most of them 1.  T is staged once, in small buckets of terms, as buffers that
  numpy reads where Arrow has them.  Its entries lie twice, by term and by document, in
  the order in which they are summed: the first of each term, the second of each that
  has one, and so on, ``LANES`` columns at once.  A sum is thus a gather and an addition
  of whole arrays without weights; what a factor is beyond 1 is an entry of its own.
* X X^T Q goes by columns: a task holds a few columns of Q and of the result, of
  ``PART_BYTES`` each, and the buckets of its share of the terms stream past it.
  Neither Q nor X is shuffled.  The result is, once for each share; a share is what
  ``TASK_WORK`` allows with so many columns.  Once ``PART_BYTES`` limits the columns,
  twice the documents mean half the columns and as many shares, so the shuffle grows
  with the documents (and X is read twice as often).  X^T Q is never stored.
* Orthonormalisation is a tall-skinny QR: R factors per partition, merged in two
  levels; only l x l matrices reach the driver.  Directions of singular value
  <= tol * max are dropped, which removes the null directions of a
  rank-deficient corpus; a second pass restores orthonormality.
* Components are formed for the terms asked for, from P.
* The Gaussian start comes from ``xxhash64(doc_id, i, seed)`` (Box-Muller), so it
  does not depend on partitioning.
* Each product is written to the checkpoint folder over the last but one, so the
  lineage stays short; its shuffle files are given up then.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vector import l2_normalize
from ..session import scratch_path, ship_package
from .common import CLEANUP, need_index, stage, without_shuffle_files
from .dense import dense_knn, vectors
from .tfidf import TfidfModel

RANK_TOL = 1e-7             # relative singular values of X; smaller ones of X X^T are rounding
NOISE = 1e-15               # relative singular values of X X^T Q below this are rounding
BLOCK_DOCS = 512            # documents of a block, on the mean
BUCKET_ENTRIES = 1 << 20    # entries of X in a bucket of terms
LANES = 4                   # columns summed at once: numpy gathers rows of 32 bytes fastest
PIECE = 128                 # entries of a term or document summed one after the other; more are cut into pieces
TILE = 16384                # pieces summed at once, as many as stay in a core's cache
PART_BYTES = 128 << 20      # columns of Q that a task holds
TASK_WORK = 1 << 31         # entries times columns of a task, at most
CELL_WORK = 1 << 28         # the same of tasks that are made to keep all cores busy
GATHER_BYTES = 32 << 20     # rows of documents of a partition
HEAVY_DF = 1_000_000        # documents of a term beyond which it is not put with others
MERGE_AT = 64               # R factors merged at once

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ONE_PARTITION = "spark.sql.unionOutputPartitioning"     # a union of single partitions stays many tasks without it


def gaussian(key, i, seed: int) -> Column:
    """Standard normal value derived from hashes of (key, i, seed)."""
    two52 = float(1 << 52)

    def uniform(s):
        h = F.xxhash64(key, i, F.lit(s))
        return (F.pmod(h, F.lit(1 << 52)).cast("double") + F.lit(0.5)) / F.lit(two52)

    return F.sqrt(F.lit(-2.0) * F.log(uniform(seed))) * F.cos(F.lit(2 * math.pi) * uniform(seed + 1))


def gaussian_vector(key, size: int, seed: int) -> Column:
    """Array of ``size`` standard normal values derived from hashes of (key, i, seed)."""
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: gaussian(key, i, seed))


class _Large:
    """While it lasts: few rows a batch, as rows are large, no shuffle files kept, and
    a task for each cell of a product."""

    SET = {CLEANUP: "true", BATCH_ROWS: "8", ONE_PARTITION: "false"}

    def __init__(self, spark):
        self.conf = spark.conf

    def __enter__(self):
        self.before = {k: self.conf.get(k, None) for k in self.SET}
        for k, v in self.SET.items():
            self.conf.set(k, v)

    def __exit__(self, *_):
        for k, v in self.before.items():
            self.conf.set(k, v) if v is not None else self.conf.unset(k)


def _stage_large(df: DataFrame, name: str, path: str | None = None, by: str | None = None) -> DataFrame:
    """``stage`` for tables of large rows, in folders by the values of ``by``."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    with _Large(spark):
        writer = df.write.mode("overwrite")
        (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------- Arrow kernels
def _list_array(m: np.ndarray) -> pa.Array:
    offsets = pa.array(np.arange(m.shape[0] + 1, dtype=np.int32) * m.shape[1])
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(m).ravel()))


def _values(column, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False)


def _pieces(key: np.ndarray, value: np.ndarray, n_keys: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The values of each key (of 0 ... n_keys - 1, ascending, each there) in the order in
    which ``_sums`` adds them.  A key is a piece of 1 to ``PIECE`` values; what it has beyond
    that lies in full pieces before all others.  Returns the places of the keys among
    the first pieces, and: all first values of the pieces, all second ones, ...; how many
    these are; the places of the keys that have more pieces; where those begin."""
    count = np.bincount(key, minlength=n_keys)
    more = (count - 1) // PIECE
    head = count - more * PIECE
    order = np.argsort(-head, kind="stable")
    place = np.empty(n_keys, np.int64)
    place[order] = np.arange(n_keys)
    begin = np.cumsum(count) - count
    long = np.flatnonzero(more)
    cut = np.cumsum(more[long]) - more[long]
    full = np.repeat(begin[long] + head[long], more[long]) + PIECE * (np.arange(more.sum()) - np.repeat(cut, more[long]))
    start, length = np.concatenate([full, begin[order]]), np.concatenate([np.full(len(full), PIECE), head[order]])
    sizes = np.array([np.count_nonzero(length > j) for j in range(int(length[0]))])
    flat = np.concatenate([value[start[:n] + j] for j, n in enumerate(sizes)])
    return place, [flat, sizes, place[long], cut]


def _sums(values: list[np.ndarray], source: np.ndarray, n_keys: int, spare: int = 0) -> np.ndarray:
    """By place of the keys, the sums of the rows of ``source`` that ``_pieces`` lists;
    then room for ``spare`` rows."""
    flat, sizes, at, cut = values
    ends, n_pieces = np.cumsum(sizes), int(sizes[0])
    out, held = np.empty((n_pieces + spare, LANES)), np.empty((TILE, LANES))
    for lo in range(0, n_pieces, TILE):
        for j, (end, n) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True)):
            hi = min(lo + TILE, n)
            if hi <= lo:
                break
            rows = flat[end - n + lo:end - n + hi]
            if j:
                out[lo:hi] += np.take(source, rows, axis=0, out=held[:hi - lo], mode="clip")
            else:
                np.take(source, rows, axis=0, out=out[lo:hi], mode="clip")
    first = out[n_pieces - n_keys:]
    if len(at):
        first[at] += np.add.reduceat(out[:n_pieces - n_keys], cut, axis=0)
    return first


def _arranged(docs: np.ndarray, terms: np.ndarray, factors: np.ndarray, n_docs: int, squares: np.ndarray | None = None) -> list[np.ndarray]:
    """Buffers (int32, int32, float64) of a bucket's entries, which lie by document:
    ``factors`` of T, and ``squares`` of the idf by term number (none: 1).  What a factor
    is beyond 1 is an entry of its own, of a made row: the document's (by document: the
    term's) times that.  Made rows are numbered after the others, many entries share one."""
    n_terms, rest = int(terms.max()) + 1, np.flatnonzero(factors != 1)
    kinds, kind = np.unique(factors[rest], return_inverse=True)

    def with_made(rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, some, made = np.unique(rows[rest].astype(np.int64) * len(kinds) + kind, return_index=True, return_inverse=True)
        return np.concatenate([rows, n + made]), rows[rest][some], factors[rest][some] - 1

    source, made_docs, by_doc = with_made(docs, n_docs)
    key = np.concatenate([terms, terms[rest]])
    order = np.argsort(key, kind="stable")
    place, of_term = _pieces(key[order], source[order], n_terms)
    source, made_terms, by_term = with_made(place[terms], n_terms)
    new = np.concatenate([[True], docs[1:] != docs[:-1]])
    key = np.cumsum(new) - 1
    key = np.concatenate([key, key[rest]])
    order = np.argsort(key, kind="stable")
    at, of_doc = _pieces(key[order], source[order], int(np.count_nonzero(new)))
    own = np.empty(len(at), np.int64)
    own[at] = docs[new]
    by_square = np.ones(n_terms)
    by_square[place] = 1 if squares is None else squares

    def joined(parts: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([[-1, len(parts)], [len(c) for c in parts], *parts]).astype(np.int32)

    return [joined([*of_term, made_docs]), joined([*of_doc, own, made_terms]), np.concatenate([by_square, by_doc, by_term])]


def _packed(shares: int, offsets: np.ndarray, n_docs: int, sublinear: bool):
    """mapInArrow body: a row (share, docs, terms, weights) of the buffers of ``_arranged``
    for each bucket of terms, from rows (bucket, block, slot, term, tf, df)."""
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        x = pa.Table.from_batches(held)
        bucket = x.column("bucket").to_numpy()
        doc = offsets[x.column("block").to_numpy()] + x.column("slot").to_numpy()
        tf, df = (x.column(c).to_numpy() for c in ("tf", "df"))
        for b in np.unique(bucket).tolist():
            at = np.flatnonzero(bucket == b)
            at = at[np.argsort(doc[at], kind="stable")]
            terms = x.column("term").take(pa.array(at)).combine_chunks().dictionary_encode()
            terms = (terms.combine_chunks() if isinstance(terms, pa.ChunkedArray) else terms).indices.to_numpy(zero_copy_only=False)
            by_term = np.zeros(int(terms.max()) + 1)
            by_term[terms] = df[at]
            squares = (np.log((n_docs + 1) / (by_term + 1)) + 1.0) ** 2
            factors = 1.0 + np.log(tf[at]) if sublinear else tf[at].astype(np.float64)
            columns = [pa.array([b % shares], pa.int32())]
            columns += [pa.array([c.tobytes()], pa.binary()) for c in _arranged(doc[at], terms, factors, int(offsets[-1]), squares)]
            yield pa.RecordBatch.from_arrays(columns, names=["share", "docs", "terms", "weights"])
    return run


def _parts(buffer: np.ndarray) -> list[np.ndarray]:
    """The arrays joined in a buffer, as indices that numpy takes as they are."""
    n = int(buffer[1])
    whole = buffer[2 + n:].astype(np.int64)
    return np.split(whole, np.cumsum(buffer[2:1 + n]))


def _product(offsets: np.ndarray, part: int, scaled: bool = False):
    """mapInArrow body: rows (block, part, vec) of X X^T Q for some columns, from rows
    with ``vec`` (those columns of Q, of every block), with ``docs`` (buckets of X, as
    arranged, or as entries by document) and with ``d`` (diagonal; if ``scaled``, then
    the documents' factors, of every block)."""
    size, n_docs = np.diff(offsets), int(offsets[-1])

    def add(y: np.ndarray, q: np.ndarray, docs: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Adds a bucket's share to y; Q, with as much room for made rows as that took."""
        if docs[0] != -1:
            docs, terms, weights = _arranged(docs, terms, weights, n_docs)
        *of_term, made_docs = _parts(docs)
        *of_doc, own, made_terms = _parts(terms)
        n_terms, n_rows = len(weights) - len(made_docs) - len(made_terms), n_docs + len(made_docs)
        if q.shape[1] < n_rows:
            q = np.concatenate([q, np.zeros((len(q), n_rows - q.shape[1], LANES))], axis=1)
        squares, by_doc, by_term = (np.repeat(c, LANES).reshape(-1, LANES) for c in np.split(weights, [n_terms, n_terms + len(made_docs)]))
        for k in range(len(q)):
            np.multiply(np.take(q[k], made_docs, axis=0), by_doc, out=q[k][n_docs:n_rows])
            z = _sums(of_term, q[k], n_terms, len(made_terms))
            z[:n_terms] *= squares
            np.multiply(np.take(z, made_terms, axis=0), by_term, out=z[n_terms:])
            y[k][own] += _sums(of_doc, z, len(own))
        return q

    def run(batches):
        q, y, n = None, None, 0
        d, factor = np.zeros(n_docs), np.ones(n_docs)
        missing = [int(np.count_nonzero(size)), int(np.count_nonzero(size)) if scaled else 0]     # of q, of the factors
        waiting, ready = [], False
        for batch in batches:
            docs, terms, weights, block, vec, diagonal = batch.columns
            for i in range(batch.num_rows):
                if vec[i].is_valid:
                    b = block[i].as_py()
                    columns = _values(vec, i).reshape(-1, size[b])
                    if q is None:
                        n = len(columns)
                        q, y = (np.zeros((-(-n // LANES), n_docs, LANES)) for _ in range(2))
                    for k, c in enumerate(columns):
                        q[k // LANES, offsets[b]:offsets[b + 1], k % LANES] = c
                    missing[0] -= 1
                elif docs[i].is_valid:
                    waiting.append([np.frombuffer(c[i].as_buffer(), t) for c, t in ((docs, np.int32), (terms, np.int32), (weights, np.float64))])
                else:
                    b, told = block[i].as_py(), _values(diagonal, i)
                    d[offsets[b]:offsets[b + 1]] = told[:size[b]]
                    if scaled:
                        factor[offsets[b]:offsets[b + 1]] = told[size[b]:]
                        missing[1] -= 1
                if not any(missing):
                    if not ready:
                        q *= factor[:, None]
                        ready = True
                    for x in waiting:
                        q = add(y, q, *x)
                    waiting = []
        y *= factor[:, None]
        y += (d / factor)[:, None] * q[:, :n_docs]
        for b in np.flatnonzero(size).tolist():
            own = y[:, offsets[b]:offsets[b + 1]].transpose(0, 2, 1).reshape(-1, size[b])[:n]
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([part], pa.int32()),
                                              _list_array(own.reshape(1, -1))], names=["block", "part", "vec"])
    return run


def _gathered(columns: int, width: int, offsets: np.ndarray):
    """mapInArrow body: (block, vec) of all columns, from the sums of rows (block, part, vec)."""
    def run(batches):
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            block, part, vec = batch.columns
            for i in range(batch.num_rows):
                b, n = block[i].as_py(), int(offsets[block[i].as_py() + 1] - offsets[block[i].as_py()])
                if b not in held:
                    held[b] = np.zeros((columns, n))
                some = _values(vec, i).reshape(-1, n)
                held[b][part[i].as_py() * width:][:len(some)] += some
        for b, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), _list_array(m.reshape(1, -1))], names=["block", "vec"])
    return run


def _merged(batches):
    """mapInArrow body: one R factor of a partition of R factors."""
    r = None
    for b in batches:
        if b.num_rows:
            m = vectors(b.column("vec"))
            r = np.linalg.qr(m if r is None else np.vstack([r, m]), mode="r")
    if r is not None:
        yield pa.RecordBatch.from_arrays([_list_array(r)], names=["vec"])


def r_factor(blocks: DataFrame, columns: int, matrix: np.ndarray | None = None) -> np.ndarray | None:
    """R of the QR factorisation of the rows of all documents (times ``matrix``)."""
    def part(batches):
        r = None
        for b in batches:
            for i in range(b.num_rows):
                m = _values(b.column(0), i).reshape(columns, -1).T
                m = m if matrix is None else m @ matrix
                r = np.linalg.qr(m if r is None else np.vstack([r, m]), mode="r")
        if r is not None:
            yield pa.RecordBatch.from_arrays([_list_array(r)], names=["vec"])

    with _Large(blocks.sparkSession):
        parts = blocks.select("vec").rdd.getNumPartitions()
        factors = blocks.select("vec").mapInArrow(part, "vec array<double>")
        if parts > MERGE_AT:
            factors = factors.repartition(math.isqrt(parts) + 1).mapInArrow(_merged, "vec array<double>")
        rows = factors.collect()
    return np.linalg.qr(np.array([r["vec"] for r in rows]), mode="r") if rows else None


def orthonormalizer(blocks: DataFrame, columns: int, tol: float) -> np.ndarray:
    """T such that the rows of all documents times T have orthonormal columns;
    directions of singular value <= tol * max are dropped.  Where small ones remain, a
    second pass corrects what the division by them loses."""
    r = r_factor(blocks, columns)
    if r is None:
        raise ValueError("empty vocabulary: no document has an in-vocabulary term")
    _, s, vt = np.linalg.svd(r)
    keep = s > tol * s[0]
    t = vt[:len(s)][keep].T / s[keep]
    if s[keep][-1] > 1e-7 * s[0]:
        return t
    _, s, vt = np.linalg.svd(r_factor(blocks, columns, t))
    keep = s > 1e-6
    return t @ (vt[:len(s)][keep].T / s[keep])


def balanced(parts: int, least: int, cores: int) -> int:
    """Shares, at least ``least`` and at most twice as many, such that the cells (``parts``
    for each share, as long as a share is large) leave few cores idle at the end."""
    if parts * least <= cores:
        return least
    return min(range(least, 2 * least + 1), key=lambda n: (-(-parts * n // cores) / n, n))


class _Products:
    """X in buckets of terms and its documents in blocks, for X X^T Q and X^T Q."""

    def __init__(self, tfidf: TfidfModel, columns: int, heavy_df: int):
        spark = tfidf.corpus.sparkSession
        ship_package(spark)
        self.tfidf, self.key = tfidf, dict(tfidf.docs.dtypes)["doc_id"]
        n_blocks = -(-tfidf.n_docs // BLOCK_DOCS)
        block = F.pmod(F.xxhash64("doc_id"), F.lit(n_blocks)).cast("int")
        self.blocks = stage(tfidf.docs.select(block.alias("block"), "doc_id").groupBy("block").agg(
            F.array_sort(F.collect_set("doc_id")).alias("ids")), "lsa-blocks")
        size = np.zeros(n_blocks, np.int64)                     # a number for each block
        for r in self.blocks.select("block", F.size("ids").alias("n")).collect():
            size[r["block"]] = r["n"]
        self.offsets = np.concatenate([[0], np.cumsum(size)])
        self._shape(columns, heavy_df)

    def _shape(self, columns: int, heavy_df: int) -> None:
        """Columns a task, shares of the terms, and X by share."""
        docs, n = self.tfidf.docs, max(1, int(self.offsets[-1]))
        spark = docs.sparkSession
        cores = spark.sparkContext.defaultParallelism
        entries = docs.select(F.explode("terms.df").alias("df")).where("df > 1").count()
        # X is read once for each part, Q and the result once for each share
        cells = min(cores, 1 + entries * columns // CELL_WORK)
        most = max(1, PART_BYTES // (8 * n))
        parts = max(-(-columns // most), -(-cells // 2))
        width = -(-columns // min(parts, columns))
        self.width = max(width, min(LANES * -(-width // LANES), LANES * (most // LANES)))
        parts = -(-columns // self.width)
        self.shares = balanced(parts, max(1, -(-cells // parts), -(-entries * self.width // TASK_WORK)), cores)
        buckets = max(self.shares, cores, -(-entries // BUCKET_ENTRIES))
        one = F.pmod(F.xxhash64("term"), F.lit(buckets))
        counts = self.counts()
        shared = counts.where("df > 1").select(F.when(F.col("df") > heavy_df, one + buckets).otherwise(one).alias("bucket"),
                                               "block", "slot", "term", "tf", "df")
        packed = shared.repartition(buckets, "bucket").mapInArrow(
            _packed(self.shares, self.offsets, self.tfidf.n_docs, self.tfidf.sublinear_tf), "share int, docs binary, terms binary, weights binary")
        # entries are small rows
        with without_shuffle_files(spark):
            packed.write.partitionBy("share").parquet(path := scratch_path(spark, "lsa-x"))
        self.x = spark.read.schema(packed.schema).parquet(path)
        weight = self.tfidf.weight()
        by_slot = counts.groupBy("block", "slot").agg(F.sum(F.when(F.col("df") == 1, weight * weight).otherwise(F.lit(0.0))).alias("d"),
                                                      F.max(F.lit(1.0) / F.col("norm")).alias("factor"))
        rows = by_slot.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("slot", "d", "factor"))).alias("rows"))
        self.diagonal = stage(rows.select("block", F.concat("rows.d", "rows.factor").alias("d")), "lsa-diagonal")

    def counts(self) -> DataFrame:
        """(block, slot, norm, term, tf, df) of X; documents are found by block and slot."""
        where = self.blocks.select("block", F.posexplode("ids").alias("slot", "doc_id"))
        docs = self.tfidf.docs.join(where.hint("shuffle_hash"), "doc_id")
        return docs.select("block", "slot", "norm", F.explode("terms").alias("t")).select("block", "slot", "norm", "t.*")

    def entries(self) -> DataFrame:
        """(block, slot, term, df, weight) of X."""
        return self.counts().select("block", "slot", "term", "df", self.tfidf.weight().alias("weight"))

    # ------------------------------------------------------------ matrices by block
    def start(self, columns: int, seed: int) -> DataFrame:
        """(block, vec) of a Gaussian matrix; the ids lie in few files, its rows are dealt out."""
        ids, n = F.col("ids"), self._spread(columns)
        rows = F.transform(F.sequence(F.lit(0), F.lit(columns - 1)), lambda i: F.transform(ids, lambda d: gaussian(d, i, seed)))
        return self.blocks.repartition(n, "block").select("block", F.flatten(rows).alias("vec"))

    def _spread(self, columns: int) -> int:
        """Partitions of a matrix of so many columns."""
        n = max(1, -(-8 * columns * int(self.offsets[-1]) // GATHER_BYTES))
        return max(n, min(len(self.offsets) - 1, self.blocks.sparkSession.sparkContext.defaultParallelism))

    def times(self, rows: DataFrame, matrix: np.ndarray, whole: bool = True) -> DataFrame:
        """(block, vec) of the rows times the small ``matrix``, or (part, block, vec) by
        columns."""
        shared = rows.sparkSession.sparkContext.broadcast(matrix)
        width = matrix.shape[1] if whole else self.width

        def run(batches):
            m = shared.value
            for batch in batches:
                for i in range(batch.num_rows):
                    out = m.T @ _values(batch.column(1), i).reshape(m.shape[0], -1)
                    for lo in range(0, len(out), width):
                        columns = [batch.column(0).slice(i, 1), _list_array(out[lo:lo + width].reshape(1, -1))]
                        yield pa.RecordBatch.from_arrays(columns if whole else [pa.array([lo // width], pa.int32()), *columns],
                                                         names=["block", "vec"] if whole else ["part", "block", "vec"])

        return rows.select("block", "vec").mapInArrow(run, "block int, vec array<double>" if whole else "part int, block int, vec array<double>")

    def round_trip(self, q: DataFrame, columns: int) -> DataFrame:
        """(block, vec) of X X^T Q from Q by columns."""
        def null(kind: str) -> Column:
            return F.lit(None).cast(kind)

        x = self.x.select("share", "docs", "terms", "weights", null("int").alias("block"), null("array<double>").alias("vec"),
                          null("array<double>").alias("d"))
        empty = [null("binary").alias(c) for c in ("docs", "terms", "weights")]
        out = None
        for part in range(-(-columns // self.width)):
            own = q.where(F.col("part") == part).select(*empty, "block", "vec", null("array<double>").alias("d"))
            for share in range(self.shares):
                # the diagonal is added once, the factors are for all
                n = (F.size("d") / 2).cast("int")
                d = F.col("d") if share == 0 else F.concat(F.array_repeat(F.lit(0.0), n), F.slice("d", n + 1, n))
                there = own.unionByName(self.diagonal.select(*empty, "block", null("array<double>").alias("vec"), d.alias("d")))
                there = there.unionByName(x.where(F.col("share") == share).drop("share"))
                cell = there.coalesce(1).mapInArrow(_product(self.offsets, part, scaled=True), "block int, part int, vec array<double>")
                out = cell if out is None else out.unionByName(cell)
        return out.repartition(self._spread(columns), "block").mapInArrow(_gathered(columns, self.width, self.offsets), "block int, vec array<double>")

    def gram(self, a: DataFrame, b: DataFrame, columns: tuple[int, int]) -> np.ndarray:
        """A^T B of two matrices by block, with so many columns."""
        def run(batches):
            total = None
            for batch in batches:
                for i in range(batch.num_rows):
                    left, right = (_values(batch.column(k), i).reshape(columns[k], -1) for k in (0, 1))
                    total = left @ right.T + (0 if total is None else total)
            if total is not None:
                yield pa.RecordBatch.from_arrays([_list_array(total.reshape(1, -1))], names=["vec"])

        with _Large(a.sparkSession):
            both = a.join(b.withColumnRenamed("vec", "right"), "block").select("vec", "right")
            rows = both.mapInArrow(run, "vec array<double>").collect()     # one for each partition
        return sum(np.array(r["vec"]) for r in rows).reshape(columns)

    def by_document(self, rows: DataFrame, columns: int, name: str) -> DataFrame:
        """(doc_id, <name>) of a matrix by block."""
        def run(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    m = _values(batch.column(1), i).reshape(columns, -1).T
                    yield pa.RecordBatch.from_arrays([batch.column(0)[i].values, _list_array(m)], names=["doc_id", name])

        return self.blocks.join(rows, "block").select("ids", "vec").mapInArrow(run, f"doc_id {self.key}, {name} array<double>")

    def terms(self, rows: DataFrame, columns: int, entries: DataFrame) -> DataFrame:
        """(term, vec) of X^T times the rows, for ``entries`` of X."""
        offsets, step = self.offsets, max(1, GATHER_BYTES // (8 * columns))

        def run(batches):
            matrix, held = {}, []
            for batch in batches:
                dense = pc.is_valid(batch.column("vec"))
                own = batch.filter(dense)
                for i in range(own.num_rows):
                    matrix[own.column("block")[i].as_py()] = _values(own.column("vec"), i).reshape(columns, -1)
                held.append(batch.filter(pc.invert(dense)).select(["block", "slot", "term", "weight"]))
            x = pa.Table.from_batches(held) if held else None
            if x is None or not x.num_rows:
                return
            at = np.zeros(len(offsets), np.int64)
            blocks = list(matrix)
            at[blocks] = np.concatenate([[0], np.cumsum([matrix[b].shape[1] for b in blocks])])[:-1]
            doc = at[x.column("block").to_numpy()] + x.column("slot").to_numpy()
            full = np.concatenate([matrix[b] for b in blocks], axis=1)
            terms = x.column("term").combine_chunks()
            terms = (terms if isinstance(terms, pa.Array) else pa.concat_arrays(terms.chunks)).dictionary_encode()
            code, weight = terms.indices.to_numpy(zero_copy_only=False).astype(np.int64), x.column("weight").to_numpy()
            order = np.argsort(code, kind="stable")
            ends = np.searchsorted(code[order], np.arange(0, len(terms.dictionary) + step, step))
            for lo, hi, first in zip(ends[:-1], ends[1:], range(0, len(terms.dictionary), step), strict=False):
                some = order[lo:hi]
                n = min(step, len(terms.dictionary) - first)
                z = np.stack([np.bincount(code[some] - first, weight[some] * full[k][doc[some]], n) for k in range(columns)], axis=1)
                yield pa.RecordBatch.from_arrays([terms.dictionary.slice(first, n), _list_array(z)], names=["term", "vec"])

        both = entries.select("block", "slot", "term", "weight").unionByName(rows.select("block", "vec"), allowMissingColumns=True)
        partial = both.repartition(self._spread(columns), "block").mapInArrow(run, "term string, vec array<double>")
        return partial.groupBy("term").agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("vec")))).alias("vec"))


class LsaModel:
    def __init__(self, tfidf: TfidfModel | None = None, doc_embeddings: DataFrame | None = None, products: _Products | None = None,
                 rows: DataFrame | None = None, singular_values=(), n_components: int = 0):
        self.tfidf = tfidf
        if tfidf is None:                         # not fitted yet: encode and search raise
            return
        self.corpus = tfidf.corpus
        self.doc_embeddings = doc_embeddings      # (doc_id, embedding) un-normalised, only docs with terms
        self.products = products
        self.rows = rows                          # (block, vec) of P: the components are X^T P
        self.singular_values = np.asarray(singular_values)
        self.n_components = n_components

    @classmethod
    def fit(cls, corpus: DataFrame, n_components: int = 128, n_iter: int = 5, n_oversamples: int = 10,
            seed: int = 42, rank_tol: float = RANK_TOL, tfidf: TfidfModel | None = None, heavy_df: int = HEAVY_DF,
            **tfidf_kw) -> LsaModel:
        tfidf = tfidf or TfidfModel.fit(corpus, **tfidf_kw)
        columns = n_components + n_oversamples
        products = _Products(tfidf, columns, heavy_df)
        spark = corpus.sparkSession
        paths = [scratch_path(spark, "lsa-y") for _ in range(2)]
        q_path = scratch_path(spark, "lsa-q")
        y = _stage_large(products.start(columns, seed), "lsa-y", paths[0])
        for i in range(n_iter + 2):
            before, t = y, orthonormalizer(y, columns, NOISE)
            q = _stage_large(products.times(before, t, whole=False), "lsa-q", q_path, "part")
            columns = t.shape[1]
            y = _stage_large(products.round_trip(q, columns), "lsa-y", paths[(i + 1) % 2])
        g = t.T @ products.gram(before, y, t.shape)              # Q^T X X^T Q
        values, u = np.linalg.eigh((g + g.T) / 2)
        s, u = np.sqrt(np.maximum(values[::-1], 0)), u[:, ::-1]
        k = int(min(n_components, np.count_nonzero(s > rank_tol * s[0])))
        m = u[:, :k] / s[:k]
        docs = _stage_large(products.by_document(products.times(y, m), k, "embedding"), "lsa-embeddings")
        rows = _stage_large(products.times(before, t @ m), "lsa-rows")
        return cls(tfidf, docs, products, rows, s[:k], k)

    # ---------------------------------------------------------------- components
    def components(self, terms: DataFrame | None = None) -> DataFrame:
        """(term, vec) of the ``terms`` that are in the vocabulary, or of all."""
        x = self.products.entries()
        return self.products.terms(self.rows, self.n_components, x if terms is None else x.join(terms.select("term").distinct(), "term"))

    def projected(self) -> tuple[DataFrame, np.ndarray]:
        """X V as (doc_id, xv), and V^T V, both from the product X (X^T P)."""
        k, p = self.n_components, self.products
        columns = _stage_large(p.times(self.rows, np.eye(k), whole=False), "lsa-p", by="part")
        xv = _stage_large(p.round_trip(columns, k), "lsa-xv")
        return _stage_large(p.by_document(xv, k, "xv"), "lsa-xv-rows"), p.gram(self.rows, xv, (k, k))

    # ---------------------------------------------------------------- encode
    def embeddings(self, normalize: bool = True) -> DataFrame:
        """(doc_id, pos, embedding) for every corpus document; documents
        without an in-vocabulary term get the zero vector."""
        zero = F.array_repeat(F.lit(0.0), self.n_components)
        docs = self.corpus.select("doc_id", "pos").join(self.doc_embeddings, "doc_id", "left")
        e = F.coalesce(F.col("embedding"), zero)
        return docs.select("doc_id", "pos", (l2_normalize(e) if normalize else e).alias("embedding"))

    def encode(self, queries: DataFrame, normalize: bool = True) -> DataFrame:
        """(query_id, embedding): TF-IDF transform, projection on the
        components, L2 normalisation (queries with no known term get zeros)."""
        need_index(self.tfidf, "search")
        qw = stage(self.tfidf.transform(queries), "lsa-query")
        there = self.components(qw).join(qw, "term")
        proj = (there.groupBy("query_id")
                .agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("vec")), F.col("weight"))).alias("e")))
        zero = F.array_repeat(F.lit(0.0), self.n_components)
        out = queries.select("query_id").join(proj, "query_id", "left")
        e = F.coalesce(F.col("e"), zero)
        return out.select("query_id", (l2_normalize(e) if normalize else e).alias("embedding"))

    def search(self, queries: DataFrame, k: int = 5, fields: bool = False) -> DataFrame:
        return dense_knn(stage(self.encode(queries), "lsa-encoded"), self.embeddings(), k,
                         fields=self.corpus if fields else None)

    def top_terms(self, queries: DataFrame, n: int = 10) -> DataFrame:
        return self.tfidf.top_terms(queries, n)

    # ---------------------------------------------------------------- stats
    def variance_frame(self) -> DataFrame:
        """One row (n_components, variance_explained, embedding_variance,
        total_variance): sum_j var(embedding_j) / sum_t var(X_t), population
        variances over all N documents (documents without terms are zero rows).
        All sums are Spark aggregates; nothing is collected."""
        n = F.lit(float(self.tfidf.n_docs))       # n * n of integers overflows from 46,341 documents on
        e = self.doc_embeddings
        sums = e.agg(
            vector_to_array(Summarizer.sum(array_to_vector(F.col("embedding")))).alias("s1"),
            vector_to_array(Summarizer.sum(array_to_vector(F.transform("embedding", lambda v: v * v)))).alias("s2"))
        # sum_j (s2_j / n - (s1_j / n)^2), reduced inside the lambdas, divided outside
        s2 = F.aggregate("s2", F.lit(0.0), lambda acc, v: acc + v)
        s1sq = F.aggregate("s1", F.lit(0.0), lambda acc, v: acc + v * v)
        exp_var = sums.select((s2 / n - s1sq / (n * n)).alias("exp_var"))
        x = self.tfidf.doc_weights
        w2 = x.agg(F.sum(F.col("weight") * F.col("weight"))).scalar()
        # a term of one document adds its square; the others meet by term
        one = x.where("df = 1").agg(F.sum(F.col("weight") * F.col("weight"))).scalar()
        shared = x.where("df > 1").groupBy("term").agg(F.sum("weight").alias("c")).agg(F.sum(F.col("c") * F.col("c"))).scalar()
        c2 = F.coalesce(one, F.lit(0.0)) + F.coalesce(shared, F.lit(0.0))
        full_var = w2 / n - c2 / (n * n)
        return exp_var.select(F.lit(self.n_components).cast("long").alias("n_components"),
                              F.when(full_var != 0, F.col("exp_var") / full_var).otherwise(F.lit(0.0))
                              .alias("variance_explained"),
                              F.col("exp_var").alias("embedding_variance"), full_var.alias("total_variance"))

    def explained_variance_ratio(self) -> float:
        return float(self.variance_frame().first()["variance_explained"])
