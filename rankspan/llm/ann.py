"""Nearest neighbours by inner product from low-dimensional stable projections.

Vectors are lifted by one coordinate to a common length, which turns the largest
inner product into the smallest Euclidean distance, and projected on ``DIMS``
Gaussian directions: the squared projected distance over the squared distance is
chi-square distributed with ``DIMS`` degrees of freedom.  A kd-tree over the
projections (its upper part, the cells, on a bounded sample; its lower part, the
leaves, inside each block) gives the candidates of a query in order of projected
distance; each is verified on its original vector.  The search stops when the
next projected distance D satisfies chi2_cdf(D^2 / d_k^2) >= ``CERTAINTY``, d_k
being the k-th smallest distance so far: a nearer vector would have been met
before with that probability, so the expected recall is at least ``CERTAINTY``.

Round one searches a query's own cell; its d_k sends the query in round two only
to the cells that the stopping test leaves open.  A cell with many rows is split
into blocks by id; the queries of a block come in chunks of bounded size; equal
vectors of a block are one point, so crowds of copies cost nothing.

Defined cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part; ties go to the smaller id; fewer
than k candidates are all returned; no queries or no vectors give no rows; a
repeated row is a candidate of its own; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import in_batches, staged

K = 20
DIMS = 8
CERTAINTY = 0.96
BLOCK = 4096
QUERIES = 4096
SAMPLE = 32_768
MOST_CELLS = 1024
LEAF = 64
SEED = 11


def chi2_cdf(x: float, dims: int) -> float:
    """Chi-square distribution function (series of the incomplete gamma function)."""
    a, y = dims / 2.0, x / 2.0
    if y <= 0:
        return 0.0
    term = total = 1.0 / a
    i = a
    while term > total * 1e-15:
        i += 1
        term *= y / i
        total += term
    return min(1.0, total * math.exp(-y + a * math.log(y) - math.lgamma(a)))


def chi2_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 10.0 * dims + 100.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, dims) < p else (low, mid)
    return high


def directions(size: int, dims: int, seed: int = SEED) -> np.ndarray:
    """(size + 1, dims) Gaussian directions for vectors lifted by a coordinate."""
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((size + 1, dims))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, width) if len(column) else np.zeros((0, width))


class Tree:
    """kd-tree of ``2**depth`` cells: splits at medians of the widest coordinate."""

    def __init__(self, points: np.ndarray, depth: int):
        self.depth = depth
        self.dim = np.zeros(2**depth - 1, np.int64)
        self.cut = np.zeros(2**depth - 1)
        parts = {0: np.arange(len(points))}
        for node in range(2**depth - 1):
            rows = parts.pop(node)
            own = points[rows]
            if len(own):
                d = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
                self.dim[node], self.cut[node] = d, np.median(own[:, d])
            right = own[:, self.dim[node]] > self.cut[node]
            parts[2 * node + 1], parts[2 * node + 2] = rows[~right], rows[right]

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[rows, self.dim[node]] > self.cut[node])
        return node - (2**self.depth - 1)


def project(vectors: np.ndarray, lengths2: np.ndarray, top2: float, axes: np.ndarray, query: bool) -> np.ndarray:
    """Projections; a query's extra coordinate is 0."""
    extra = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(top2 - lengths2, 0.0))
    return vectors @ axes[:-1] + extra[:, None] * axes[-1]


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Rows of each leaf of a kd-tree over a block."""
    todo, out = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        own = points[rows]
        d = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
        order = np.argpartition(own[:, d], len(rows) // 2)
        todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return out


def search_block(ids: np.ndarray, vectors: np.ndarray, points: np.ndarray, queries: np.ndarray, query_points: np.ndarray,
                 worst: np.ndarray, own: np.ndarray, top2: float, stop: float, k: int):
    """Best candidates of each query in one block.

    worst: k-th best inner product known so far (-inf if none); own: the queries'
    ids, which are no candidates.  Returns a list of (ids, scores)."""
    _, first, group = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    group = group.ravel()
    x, p = vectors[first], points[first]
    order = np.lexsort((ids, group))
    starts = np.searchsorted(group[order], np.arange(len(first) + 1))
    parts = leaves(p)
    low, high = np.array([p[r].min(axis=0) for r in parts]), np.array([p[r].max(axis=0) for r in parts])
    n, length2 = len(queries), (queries * queries).sum(axis=1)
    # squared projected distance of each query to each leaf's box
    near = np.zeros((n, len(parts)))
    for d in range(points.shape[1]):
        q = query_points[:, d][:, None]
        near += np.maximum(np.maximum(low[:, d] - q, q - high[:, d]), 0.0) ** 2
    turn = np.argsort(near, axis=1, kind="stable")
    wanted = k + 1                         # the query itself may be among them
    best = np.full((n, wanted), -np.inf)
    place = np.full((n, wanted), -1, np.int64)
    best[:, -1] = -np.inf
    live = np.arange(n)
    for step in range(len(parts)):
        leaf = turn[live, step]
        bound = np.maximum(best[live, 0], worst[live])
        distance2 = np.maximum(top2 + length2[live] - 2.0 * bound, 0.0)
        go = near[live, leaf] <= stop * distance2
        live, leaf = live[go], leaf[go]
        if not len(live):
            break
        by = np.argsort(leaf, kind="stable")
        edges = np.flatnonzero(np.diff(leaf[by])) + 1
        for rows in np.split(by, edges):
            q, part = live[rows], parts[leaf[rows[0]]]
            score = queries[q] @ x[part].T
            both = np.concatenate([best[q], score], axis=1)
            at = np.concatenate([place[q], np.broadcast_to(part, score.shape)], axis=1)
            top = np.argpartition(both, both.shape[1] - wanted, axis=1)[:, -wanted:]
            top = np.take_along_axis(top, np.argsort(np.take_along_axis(both, top, 1), axis=1), 1)
            best[q], place[q] = np.take_along_axis(both, top, 1), np.take_along_axis(at, top, 1)
    out = []
    for i in range(n):
        found = place[i][place[i] >= 0]
        rows = np.concatenate([order[starts[g]:min(starts[g + 1], starts[g] + wanted)] for g in found]) if len(found) else found
        rows = rows[ids[rows] != own[i]]
        score = (vectors[rows] * queries[i]).sum(axis=1)
        rank = np.lexsort((ids[rows], -score))[:k]
        rank = rank[score[rank] >= worst[i] - 1e-9]
        out.append((ids[rows][rank], score[rank]))
    return out


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda v: v != 0)


class Index:
    """Projected vectors in blocks, and the cells' boxes (bounded)."""

    def __init__(self, vectors: DataFrame, id_col: str, vector_col: str, dims: int = DIMS, block: int = BLOCK,
                 certainty: float = CERTAINTY):
        spark = vectors.sparkSession
        self.spark, self.dims, self.stop = spark, dims, chi2_quantile(certainty, dims)
        v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        v = v.where(F.col("id").isNotNull()).where(_usable(F.col("v")))
        length2 = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
        sizes = v.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(length2).alias("top")).orderBy(
            F.desc("n"), "d").limit(1).collect()
        self.n, self.width = (sizes[0]["n"], sizes[0]["d"]) if sizes else (0, 0)
        if not self.n:
            return
        self.top2 = float(sizes[0]["top"]) * (1 + 1e-12)
        self.axes = directions(self.width, dims)
        self.vectors = v.where(F.size("v") == self.width)
        depth = max(0, min(int(math.log2(MOST_CELLS)), math.ceil(math.log2(max(1.0, self.n / block)))))
        share = min(1.0, SAMPLE / self.n)
        rows = self.vectors.where(F.rand(SEED) <= share).limit(2 * SAMPLE).collect() if depth else []
        sample = np.array([r["v"] for r in rows], dtype=float).reshape(-1, self.width)
        self.tree = Tree(project(sample, (sample**2).sum(axis=1), self.top2, self.axes, False), depth)
        self.points = staged(self._placed(self.vectors, False), "ann-points")
        edge = [f(F.get("p", F.lit(i))).alias(f"{name}{i}") for i in range(dims) for f, name in ((F.min, "low"), (F.max, "high"))]
        cells = self.points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *edge).orderBy("cell").collect()
        self.cells = [(r["cell"], -(-r["n"] // block)) for r in cells]
        self.low = np.array([[r[f"low{i}"] for i in range(dims)] for r in cells])
        self.high = np.array([[r[f"high{i}"] for i in range(dims)] for r in cells])

    def _placed(self, vectors: DataFrame, query: bool) -> DataFrame:
        """(id, v, p, cell): projections and cells of vectors."""
        tree, axes, top2, width = self.tree, self.axes, self.top2, self.width

        def work(batches):
            for batch in batches:
                x = matrix(batch.column(1), width)
                p = project(x, (x * x).sum(axis=1), top2, axes, query)
                ends = np.arange(len(x) + 1, dtype=np.int32) * p.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(p.ravel())),
                     pa.array(tree.cell(p).astype(np.int32))], names=["id", "v", "p", "cell"])

        return in_batches(vectors, work, "id long, v array<double>, p array<double>, cell int")

    def _blocks(self) -> DataFrame:
        parts = F.create_map(*[F.lit(x) for pair in self.cells for x in pair])
        return self.points.withColumn("sub", F.pmod(F.xxhash64("id"), parts[F.col("cell")].cast("long")).cast("int"))

    def _search(self, requests: DataFrame, k: int) -> DataFrame:
        """(query, ids, scores) of each request (cell, sub, chunk, query, v, p, worst)."""
        width, dims, top2, stop = self.width, self.dims, self.top2, self.stop
        names = ["query", "ids", "scores"]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64())]

        def work(points: pa.Table, asked: pa.Table) -> pa.Table:
            if not points.num_rows or not asked.num_rows:
                return pa.table([pa.array([], t) for t in kinds], names=names)
            c = {n: points.column(n).combine_chunks() for n in ("id", "v", "p")}
            q = {n: asked.column(n).combine_chunks() for n in ("query", "v", "p", "worst")}
            own = q["query"].to_numpy()
            found = search_block(c["id"].to_numpy(), matrix(c["v"], width), matrix(c["p"], dims), matrix(q["v"], width),
                                 matrix(q["p"], dims), q["worst"].to_numpy(), own, top2, stop, k)
            keep = [i for i, (ids, _) in enumerate(found) if len(ids)]
            return pa.table([pa.array(own[keep], kinds[0]), pa.array([found[i][0] for i in keep], kinds[1]),
                             pa.array([found[i][1] for i in keep], kinds[2])], names=names)

        ship_package(self.spark)
        requests = staged(requests, "ann-requests")
        # each block goes once to every chunk of queries that asks for it
        asked = requests.select(F.col("cell").alias("c"), F.col("sub").alias("s"), F.col("chunk").alias("h")).distinct()
        blocks = self._blocks()
        blocks = blocks.join(asked, (blocks["cell"] == asked["c"]) & (blocks["sub"] == asked["s"]))
        return blocks.groupBy("c", "s", "h").cogroup(requests.groupBy("cell", "sub", "chunk")).applyInArrow(
            work, "query long, ids array<long>, scores array<double>")

    def search(self, queries: DataFrame, id_col: str, vector_col: str, k: int = K) -> DataFrame:
        """(query_id, rank, vec_id, score): the nearest found of each query."""
        schema = "query_id long, rank int, vec_id long, score double"
        if not self.n:
            return self.spark.createDataFrame([], schema)
        v = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
        v = v.where(F.col("id").isNotNull()).where(_usable(F.col("v")) & (F.size("v") == self.width)).dropDuplicates(["id"])
        placed = staged(self._placed(v, True).withColumnRenamed("id", "query"), "ann-queries")
        # chunks of neighbouring queries, at most about QUERIES each
        per_cell = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        chunk_of, salt_of, total, chunk = {}, {}, 0, 0
        for cell in sorted(per_cell):
            if total + per_cell[cell] > QUERIES:
                chunk, total = chunk + 1, 0
            chunk_of[cell], salt_of[cell] = chunk, -(-per_cell[cell] // QUERIES)
            total += per_cell[cell]
            if salt_of[cell] > 1:
                chunk, total = chunk + salt_of[cell], 0
        if not per_cell:
            return self.spark.createDataFrame([], schema)
        base = F.create_map(*[F.lit(x) for pair in chunk_of.items() for x in pair])
        salts = F.create_map(*[F.lit(x) for pair in salt_of.items() for x in pair])
        placed = placed.withColumn("chunk", (base[F.col("cell")] + F.pmod(F.xxhash64("query", F.lit(7)), salts[F.col("cell")].cast("long"))).cast("int"))
        home = self._home(placed)
        first = staged(self._search(home.withColumn("worst", F.lit(float("-inf"))), k), "ann-first")
        known = first.select("query", F.when(F.size("scores") >= k, F.array_min("scores")).alias("kth"))
        again = placed.join(known, "query", "left").withColumn("worst", F.coalesce("kth", F.lit(float("-inf")))).drop("kth")
        second = self._search(self._open(again), k)
        hits = first.unionByName(second).select("query", F.explode(F.arrays_zip("ids", "scores")).alias("h")).select(
            F.col("query").alias("query_id"), F.col("h.ids").alias("vec_id"), F.col("h.scores").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score")

    def _home(self, placed: DataFrame) -> DataFrame:
        """Each query's request to the first block of its nearest cell."""
        dims, cells, distance2 = self.dims, np.array([c for c, _ in self.cells], np.int32), self._boxes()

        def work(batches):
            for batch in batches:
                near = distance2(matrix(batch.column(2), dims)).argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), batch.column(2), pa.array(cells[near]), batch.column(4),
                     pa.array(np.zeros(batch.num_rows, np.int32))], names=["query", "v", "p", "cell", "chunk", "sub"])

        return in_batches(placed.select("query", "v", "p", "cell", "chunk"), work,
                          "query long, v array<double>, p array<double>, cell int, chunk int, sub int")

    def _boxes(self):
        low, high, dims = self.low, self.high, self.dims

        def distance2(p: np.ndarray) -> np.ndarray:
            out = np.zeros((len(p), len(low)))
            for d in range(dims):
                q = p[:, d][:, None]
                out += np.maximum(np.maximum(low[:, d] - q, q - high[:, d]), 0.0) ** 2
            return out

        return distance2

    def _open(self, asked: DataFrame) -> DataFrame:
        """Requests to all blocks that the stopping test leaves open, without the
        block searched first."""
        dims, width, top2, stop, distance2 = self.dims, self.width, self.top2, self.stop, self._boxes()
        cells = np.array([c for c, _ in self.cells], np.int32)
        subs = np.array([s for _, s in self.cells], np.int64)
        cell = np.repeat(cells, subs)
        sub = np.concatenate([np.arange(s) for s in subs]).astype(np.int32)
        box = np.repeat(np.arange(len(cells)), subs)

        def work(batches):
            for batch in batches:
                for lo in range(0, batch.num_rows, 512):
                    part = batch.slice(lo, 512)
                    x, p = matrix(part.column(1), width), matrix(part.column(2), dims)
                    worst = part.column(4).to_numpy()
                    near = distance2(p)
                    limit = stop * np.maximum(top2 + (x * x).sum(axis=1) - 2 * worst, 0.0)
                    open_cell = near <= limit[:, None]
                    mine = near.argmin(axis=1)
                    row, at = np.nonzero(open_cell[:, box] & ~((box[None, :] == mine[:, None]) & (sub[None, :] == 0)))
                    took = part.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([*took.columns, pa.array(cell[at]), pa.array(sub[at])],
                                                     names=["query", "v", "p", "chunk", "worst", "cell", "sub"])

        return in_batches(asked.select("query", "v", "p", "chunk", "worst"), work,
                          "query long, v array<double>, p array<double>, chunk int, worst double, cell int, sub int")


def nearest(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
            **options) -> DataFrame:
    return Index(vectors, id_col, vector_col, **options).search(queries, id_col, vector_col, k)
