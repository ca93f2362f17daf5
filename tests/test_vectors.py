import math
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankspan.operators.dense import _Best, block_top_k, dense_knn
from rankspan.operators.hybrid import BatchEncoder
from rankspan.operators import lsa as lsa_module
from rankspan.operators.common import spread, stage
from rankspan.functions.vector import l2_normalize
from rankspan.operators.lsa import LsaModel, gaussian_vector
from rankspan.operators import tfidf as tfidf_module
from rankspan.operators.tfidf import TfidfModel
from rankspan.session import checkpoint_dir
from rankspan.sources import testdata as td


@pytest.fixture(scope="module")
def tfidf(fx):
    return TfidfModel.fit(fx[0])


def scores(df, col="vector_score"):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["doc_id"], round(r[col], 6) + 0.0))
    return out


def test_vocabulary(tfidf):
    vocab = {r["term"] for r in tfidf.vocabulary.collect()}
    assert len(vocab) == 71 and "the" not in vocab and "season" in vocab and "offseason" not in vocab


def test_top_terms(tfidf, fx):
    got = {}
    for r in tfidf.top_terms(fx[1]).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["term"], round(r["weight"], 6)))
    assert got == {"q1": [("ferry", 0.894914), ("pier", 0.446239)],
                   "q2": [("coffee", 0.707107), ("bakery", 0.707107)],
                   "q3": [("valley", 1.0)],
                   "q5": [("passes", 0.707107), ("harbor", 0.707107)]}


def test_tfidf_cosine(tfidf, fx):
    got = scores(tfidf.search(fx[1], k=6))
    assert got["q1"] == [("m1", 0.430571), ("m2", 0.259039), ("m4", 0.109438), ("m3", 0.109438), ("m6", 0.0),
                         ("m5", 0.0)]
    assert got["q3"][:2] == [("m6", 0.208111), ("m5", 0.186789)]
    assert [d for d, _ in got["q4"]] == ["m6", "m5", "m4", "m3", "m2", "m1"]


def test_lsa_exact_on_rank_deficient_corpus(fx):
    m = LsaModel.fit(fx[0])
    assert m.n_components == 5
    got = scores(m.search(fx[1], k=6))
    assert got["q1"][:4] == [("m1", 0.884064), ("m2", 0.531869), ("m4", 0.224702), ("m3", 0.224702)]
    assert [d for d, _ in got["q1"][4:]] == ["m6", "m5"]
    assert got["q2"][:3] == [("m4", 0.75957), ("m3", 0.75957), ("m6", 0.732779)]
    assert got["q3"][:2] == [("m6", 0.755666), ("m5", 0.678243)]
    assert got["q5"][0] == ("m2", 0.992764)
    assert [d for d, _ in got["q4"]] == ["m6", "m5", "m4", "m3", "m2", "m1"]
    assert abs(m.explained_variance_ratio() - 1.0) < 1e-9


def test_dense_knn_matches_numpy(spark):
    rng = np.random.default_rng(7)
    docs = rng.normal(size=(300, 16))
    docs[5] = docs[9]  # an exact tie
    qs = rng.normal(size=(25, 16))
    ddf = spark.createDataFrame([(i, i, docs[i].tolist()) for i in range(300)],
                                "doc_id long, pos long, embedding array<double>")
    qdf = spark.createDataFrame([(i, qs[i].tolist()) for i in range(25)], "query_id long, embedding array<double>")
    un = docs / np.linalg.norm(docs, axis=1, keepdims=True)
    uq = qs / np.linalg.norm(qs, axis=1, keepdims=True)
    s = uq @ un.T
    want = {}
    for q in range(25):
        order = sorted(range(300), key=lambda d: (-round(s[q, d], 9), -d))[:7]
        want[q] = [(d, round(s[q, d], 6) + 0.0) for d in order]
    assert scores(dense_knn(qdf, ddf, k=7)) == want
    assert scores(dense_knn(qdf, ddf, k=7, q_blocks=3, c_blocks=4)) == want


def test_dense_knn_zero_and_equal_vectors(spark):
    docs = [(i, i, [0.0, 0.0] if i % 3 == 0 else [1.0, 1.0]) for i in range(60)]
    ddf = spark.createDataFrame(docs, "doc_id long, pos long, embedding array<double>")
    qdf = spark.createDataFrame([(1, [0.0, 0.0]), (2, [2.0, 2.0])], "query_id long, embedding array<double>")
    got = scores(dense_knn(qdf, ddf, k=3, q_blocks=2, c_blocks=3))
    assert [d for d, _ in got[1]] == [59, 58, 57]
    assert [d for d, _ in got[2]] == [59, 58, 56]


def test_dense_knn_moves_no_corpus(spark):
    ddf = spark.range(5000).select(F.col("id").alias("doc_id"), F.col("id").alias("pos"), F.array(F.rand(1), F.rand(2)).alias("embedding"))
    qdf = ddf.limit(20).select(F.col("doc_id").alias("query_id"), "embedding")
    plan = dense_knn(qdf, ddf, k=3)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "Exchange" not in below and "WindowGroupLimit" in plan


def test_stream_skips_pieces_that_cannot_improve():
    """Clustered documents: pieces far from a query are not multiplied, and the result is exact."""
    rng = np.random.default_rng(3)
    centres = np.repeat(np.eye(32), 300, axis=0)
    docs = centres + rng.normal(size=centres.shape) * 0.01
    docs /= np.linalg.norm(docs, axis=1, keepdims=True)
    qs = docs[rng.integers(0, len(docs), 40)]
    best, formed = _Best(qs, 5, pa.int64()), 0
    for lo in range(0, len(docs), 300):
        pos = np.arange(lo, lo + 300)[::-1]
        formed += best.add(docs[pos], pos, pa.array(pos))
    want = np.sort(np.argsort(-(qs @ docs.T), axis=1)[:, :5], axis=1)
    assert (np.sort(best.pos.reshape(40, 5), axis=1) == want).all()
    assert formed < 0.7 * len(qs) * len(docs)


def test_block_keeps_exactly_k_rows():
    q, d, s = block_top_k(np.zeros((2, 4)), np.ones((500, 4)), 5)
    assert len(q) == 10 and sorted(set(d.tolist())) == [0, 1, 2, 3, 4]


def test_tfidf_errors(spark):
    schema = "doc_id string, pos long, title string, text string"
    with pytest.raises(ValueError):
        TfidfModel.fit(spark.createDataFrame([("a", 1, None, "one lonely text")], schema))
    with pytest.raises(ValueError, match="empty vocabulary"):
        TfidfModel.fit(spark.createDataFrame([("a", 1, None, "the of"), ("b", 2, None, "and the")], schema), max_df=1.0)
    with pytest.raises(ValueError, match="no documents"):
        TfidfModel.fit(spark.createDataFrame([], schema))
    q = spark.createDataFrame([("q", "red")], "query_id string, query string")
    for model in (LsaModel(), TfidfModel()):
        with pytest.raises(RuntimeError, match="build the index before"):
            model.search(q)


def test_tfidf_stages_what_is_asked_for(spark):
    """A fit and its counts write nothing; a chunk is told df of shared terms only."""
    corpus = td.corpus(spark, "/root/testdata/sf0.001")
    folder = checkpoint_dir(spark)
    before = set(os.listdir(folder))
    model = TfidfModel.fit(corpus)
    assert model.term_counts.count() > 0 and set(os.listdir(folder)) == before
    plan = model.term_counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1                   # counted once


def test_tfidf_chunks_against_python(spark, monkeypatch):
    """Weights from many small chunks, with limits and a repeated document, against plain Python."""
    monkeypatch.setattr(tfidf_module, "CHUNK_BYTES", 100)
    words = ["amber", "birch", "cedar", "delta", "ember", "fjord", "grove"]
    rows = [(i, i, None, " ".join(words[(i * k + k * k) % 7] for k in range(i % 9))) for i in range(60)]
    rows.append((7, 7, None, "amber unique word amber"))
    corpus = spark.createDataFrame(rows, "doc_id long, pos long, title string, text string")
    for low, high in ((1, 0.95), (1, 12), (2, 40)):
        model = TfidfModel.fit(corpus, min_df=low, max_df=high)
        counts = []
        for d, _, _, text in rows:
            w = text.split()
            counts.append((d, Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)])))
        df = Counter(t for _, c in counts for t in c)
        most = high * len(rows) if isinstance(high, float) else high
        df = {t: n for t, n in df.items() if low <= n <= most}
        raw = [(d, t, (1 + math.log(n)) * (math.log((len(rows) + 1) / (df[t] + 1)) + 1)) for d, c in counts for t, n in c.items() if t in df]
        norm = Counter()
        for d, _, w in raw:
            norm[d] += w * w
        want = sorted((d, t, df[t], round(w / math.sqrt(norm[d]), 9)) for d, t, w in raw)
        got = sorted((r["doc_id"], r["term"], r["df"], round(r["weight"], 9)) for r in model.doc_weights.collect())
        assert got == want
        assert {r["term"]: r["df"] for r in model.vocabulary.collect()} == df


def test_one_row_group_is_dealt_out(spark, tmp_path):
    """A table of many splits whose rows lie in one of them is counted by all cores."""
    import pyarrow.parquet as pq
    n, cores = 2000, spark.sparkContext.defaultParallelism
    words = [f"w{i:03d}" for i in range(300)]
    texts = [" ".join(words[(i * 7 + j * j) % 300] for j in range(20)) for i in range(n)]
    pq.write_table(pa.table({"doc_id": np.arange(n), "text": texts}), tmp_path / "one.parquet", row_group_size=n)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        rows = spark.read.parquet(str(tmp_path / "one.parquet"))
        corpus = rows.select("doc_id", F.col("doc_id").alias("pos"), F.lit(None).cast("string").alias("title"), "text")
        assert corpus.rdd.getNumPartitions() >= cores
        assert corpus.select(F.spark_partition_id().alias("p")).distinct().count() == 1
        model = TfidfModel.fit(corpus)
        assert model.term_counts.select(F.spark_partition_id().alias("p")).distinct().count() > cores // 2
        even = spread(corpus.repartition(cores), "doc_id")
        assert even.rdd.getNumPartitions() == cores and "Exchange hashpartitioning" not in even._jdf.queryExecution().toString()
        got = Counter({(r["doc_id"], r["term"]): r["tf"] for r in model.term_counts.collect()})
        want = Counter()
        for d, text in enumerate(texts):
            w = text.split()
            want.update((d, t) for t in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)])
        assert got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_tfidf_terms_meet_in_bins(spark, monkeypatch):
    """What moves to count the documents of terms is a row for each chunk and bin, not for
    each term; three-grams, empty and missing word lists, against plain Python."""
    monkeypatch.setattr(tfidf_module, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(tfidf_module, "BIN_BYTES", 1000)
    texts = [" ".join(f"w{(i * i + 3 * j * i) % 97}" for j in range(i % 40)) for i in range(200)] + ["the of", "w5"]
    corpus = spark.createDataFrame([(i, i, None, t) for i, t in enumerate(texts)], "doc_id long, pos long, title string, text string")
    df = Counter()
    for t in texts[:-2] + ["w5"]:
        w = t.split()
        df.update({" ".join(w[j:j + k]) for k in (1, 2, 3) for j in range(len(w) - k + 1)})
    model = TfidfModel.fit(corpus, ngram_range=(1, 3))
    vocabulary = {r["term"]: r["df"] for r in model.vocabulary.collect()}
    assert vocabulary == df
    assert {r["term"]: r["df"] for r in model.doc_weights.select("term", "df").distinct().collect()} == df
    moved = model._chunked().groupBy("chunk").applyInArrow(tfidf_module._binned((1, 3), model.bins), "bin int, chunk long, terms string, n array<int>")
    assert model.bins > 8 and moved.count() <= model.chunks * model.bins
    assert moved.select(F.explode(F.split("terms", "\n"))).distinct().count() == len(df)
    g = tfidf_module._Grams(pa.array([["a", "b", "a", "b"], None, [], ["b"]], pa.list_(pa.string())), (1, 2))
    terms = g.terms.to_pylist()
    assert [(o, terms[c], n) for o, c, n in zip(g.owner, g.code, g.tf, strict=True)] == [
        (0, "a", 2), (0, "b", 2), (0, "a b", 2), (0, "b a", 1), (3, "b", 1)]


def test_lsa_against_numpy(spark):
    """Embeddings and query vectors against numpy subspace iteration from the
    same start on a 60-document corpus (32 of 60 directions)."""
    corpus = td.corpus(spark, "/root/testdata/sf0.001").where("doc_id < 60")
    tfidf = TfidfModel.fit(corpus)
    k, over = 24, 8
    m = LsaModel.fit(corpus, n_components=k, n_oversamples=over, tfidf=tfidf)
    w = tfidf.doc_weights.select("doc_id", "term", "weight").toPandas()
    docs, terms = sorted(w.doc_id.unique()), sorted(w.term.unique())
    row, col = {d: i for i, d in enumerate(docs)}, {t: i for i, t in enumerate(terms)}
    x = np.zeros((len(docs), len(terms)))
    x[w.doc_id.map(row), w.term.map(col)] = w.weight
    start = {r["doc_id"]: r["v"] for r in corpus.select("doc_id", gaussian_vector(F.col("doc_id"), k + over, 42).alias("v")).collect()}
    q = np.array([start[d] for d in docs])
    for _ in range(7):
        q = np.linalg.qr(q)[0]
        y = x @ (x.T @ q)
        last, q = q, y
    v = np.linalg.svd(x.T @ last, full_matrices=False)[0][:, :k]
    e = x @ v
    e /= np.linalg.norm(e, axis=1, keepdims=True)
    got = {r["doc_id"]: r["embedding"] for r in m.embeddings().collect()}
    ours = np.array([got[d] for d in docs])
    assert np.abs(ours @ ours.T - e @ e.T).max() < 1e-6
    # the share of variance, away from 1
    share = (x @ v).var(axis=0).sum() / x.var(axis=0).sum()
    assert len(docs) == tfidf.n_docs and 0.1 < share < 0.95 and abs(m.explained_variance_ratio() - share) < 1e-6
    # a document encoded as a query is its own embedding
    qs = corpus.select(F.col("doc_id").alias("query_id"), F.concat(F.lit(". "), "text").alias("query"))
    enc = {r["query_id"]: r["embedding"] for r in m.encode(qs).collect()}
    assert np.abs((np.array([enc[d] for d in docs]) * ours).sum(axis=1) - 1).max() < 1e-6
    # heavy terms take another way to the same result
    h = LsaModel.fit(corpus, n_components=k, n_oversamples=over, tfidf=tfidf, heavy_df=5)
    other = {r["doc_id"]: r["embedding"] for r in h.embeddings().collect()}
    theirs = np.array([other[d] for d in docs])
    assert np.abs(theirs @ theirs.T - ours @ ours.T).max() < 1e-6


def test_variance_of_many_documents(spark):
    """The square of the number of documents is beyond an integer from 46,341 documents on."""
    rows = [(i, i, None, text) for i, text in enumerate(["red fox", "red hen", "blue hen", "blue sky"])]
    tfidf = TfidfModel.fit(spark.createDataFrame(rows, "doc_id long, pos long, title string, text string"))
    n = tfidf.n_docs = 60_000                                  # all others have no term
    x = {}
    for r in tfidf.doc_weights.collect():
        x.setdefault(r["term"], []).append(r["weight"])
    e = [[3.0, 4.0], [1.0, 0.0]]
    model = LsaModel(tfidf, spark.createDataFrame(list(enumerate(e)), "doc_id long, embedding array<double>"), n_components=2)
    total = sum(sum(w * w for w in ws) / n - (sum(ws) / n) ** 2 for ws in x.values())
    ours = (10 + 16) / n - (16 + 16) / n ** 2
    row = model.variance_frame().first()
    assert row["total_variance"] == pytest.approx(total, rel=1e-9)
    assert row["embedding_variance"] == pytest.approx(ours, rel=1e-9)
    assert row["variance_explained"] == pytest.approx(ours / total, rel=1e-9)


def test_lsa_products_by_columns(spark, monkeypatch):
    """X X^T Q from many cells (few columns, several shares of the terms, small blocks)
    against numpy; neither Q nor X is shuffled, and the cells are tasks of their own."""
    for name, value in (("BLOCK_DOCS", 4), ("PART_BYTES", 8 * 60 * 5), ("TASK_WORK", 20_000), ("BUCKET_ENTRIES", 500)):
        monkeypatch.setattr(lsa_module, name, value)
    corpus = td.corpus(spark, "/root/testdata/sf0.001").where("doc_id < 60")
    tfidf = TfidfModel.fit(corpus)
    p = lsa_module._Products(tfidf, 12, 5)
    assert p.width <= 5 and p.shares > 1 and len(p.offsets) > 10
    w = tfidf.doc_weights.select("doc_id", "term", "weight").toPandas()
    ids = {r["block"]: r["ids"] for r in p.blocks.collect()}
    docs = [d for b in sorted(ids) for d in ids[b]]
    row, col = {d: i for i, d in enumerate(docs)}, {t: i for i, t in enumerate(sorted(w.term.unique()))}
    x = np.zeros((len(row), len(col)))
    x[w.doc_id.map(row), w.term.map(col)] = w.weight

    def matrix(df, name):
        got = {r["doc_id"]: r[name] for r in df.collect()}
        return np.array([got[d] for d in docs])

    start = stage(p.start(12, 42), "test-start")
    q = matrix(p.by_document(start, 12, "v"), "v")
    parts = stage(p.times(start, np.eye(12), whole=False), "test-q")
    with lsa_module._Large(spark):
        y = p.round_trip(parts, 12)
        assert y._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        y = stage(y, "test-y")
        cells = p.shares * -(-12 // p.width)
        assert p.round_trip(parts, 12)._jdf.queryExecution().optimizedPlan().toString().count("Repartition 1, false") == cells
    assert np.abs(matrix(p.by_document(y, 12, "v"), "v") - x @ (x.T @ q)).max() < 1e-9
    assert np.abs(p.gram(start, y, (12, 12)) - q.T @ x @ x.T @ q).max() < 1e-8
    some = spark.createDataFrame([(t,) for t in list(col)[::7]] + [("no such term",)], "term string")
    vt = {r["term"]: r["vec"] for r in p.terms(start, 12, p.entries().join(some, "term")).collect()}
    assert set(vt) == set(list(col)[::7]) and max(np.abs(np.array(v) - x[:, col[t]] @ q).max() for t, v in vt.items()) < 1e-9
    m = LsaModel.fit(corpus, n_components=12, n_oversamples=4, tfidf=tfidf)
    xv, vtv = m.projected()
    assert np.abs(vtv - np.eye(12)).max() < 1e-9 and np.abs(matrix(xv, "xv") - matrix(m.doc_embeddings, "embedding")).max() < 1e-9
    v = {r["term"]: r["vec"] for r in m.components().collect()}
    v = np.array([v[t] for t in col])
    assert np.abs(v.T @ v - np.eye(12)).max() < 1e-9 and np.abs(x @ v - matrix(xv, "xv")).max() < 1e-9


def test_lsa_start_is_dealt_out_and_x_is_buffers(spark):
    """The Gaussian start of many documents is not one task's work, and X is read without
    a conversion by value; the setting that gives up shuffle files is put back."""
    corpus = td.corpus(spark, "/root/testdata/sf0.001")
    tfidf = TfidfModel.fit(corpus)
    p = lsa_module._Products(tfidf, 12, 5)
    cores = spark.sparkContext.defaultParallelism
    rows = corpus.count()
    assert p.start(12, 42).rdd.getNumPartitions() == min(cores, -(-rows // lsa_module.BLOCK_DOCS))
    assert [t for c, t in p.x.dtypes if c != "share"] == ["binary"] * 3
    before = spark.conf.get(lsa_module.CLEANUP, None)
    with lsa_module.without_shuffle_files(spark):
        assert spark.conf.get(lsa_module.CLEANUP) == "true"
    assert spark.conf.get(lsa_module.CLEANUP, None) == before


def test_product_of_short_and_long_runs():
    """The sums by place (few entries a document) and by run, against numpy."""
    rng = np.random.default_rng(5)
    for n_docs, n in ((40, 4000), (4000, 3000)):
        offsets = np.array([0, n_docs // 2, n_docs])
        docs, terms = np.sort(rng.integers(0, n_docs, n)).astype(np.int32), rng.integers(0, 50, n).astype(np.int32)
        weights, q, d = rng.random(n), rng.normal(size=(3, n_docs)), rng.random(n_docs)
        x = np.zeros((n_docs, 50))
        np.add.at(x, (docs, terms), weights)
        names = ["docs", "terms", "weights", "block", "vec", "d"]
        schema = pa.schema(list(zip(names, [pa.binary()] * 3 + [pa.int32()] + [pa.list_(pa.float64())] * 2, strict=True)))
        rows = [dict(zip(names, [c.tobytes() for c in (docs, terms, weights)] + [None] * 3, strict=True))]
        for b in range(2):
            lo, hi = offsets[b:b + 2]
            rows.append({"block": b, "vec": q[:, lo:hi].ravel().tolist()})
            rows.append({"block": b, "d": d[lo:hi].tolist()})
        out = {r["block"][0].as_py(): r for r in lsa_module._product(offsets, 0)([pa.RecordBatch.from_pylist(rows, schema)])}
        y = np.concatenate([out[b]["vec"][0].values.to_numpy().reshape(3, -1) for b in range(2)], axis=1)
        assert np.abs(y - (q @ x @ x.T + q * d)).max() < 1e-9


def test_norm_is_formed_once_for_a_vector(spark):
    """Unit vectors: the norm is not formed again for each value (time with the square of
    the dimensions before); null and zero vectors, and the values."""
    rows = [(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [])]
    out = spark.createDataFrame(rows, "id int, v array<double>").select("id", l2_normalize(F.col("v")).alias("u"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    assert {r["id"]: r["u"] for r in out.collect()} == {1: [0.6, 0.8], 2: [0.0, 0.0], 3: None, 4: []}


def test_product_of_arranged_buckets(monkeypatch):
    """Buckets of entries as they are staged (factors of the tf, squares of the idf, factors
    of the documents; terms and documents of more entries than a piece or tile) against numpy;
    factors of 1 take no room."""
    monkeypatch.setattr(lsa_module, "TILE", 16)
    monkeypatch.setattr(lsa_module, "PIECE", 4)
    rng = np.random.default_rng(6)
    n_docs, offsets, names = 300, np.array([0, 100, 300]), ["docs", "terms", "weights", "block", "vec", "d"]
    schema = pa.schema(list(zip(names, [pa.binary()] * 3 + [pa.int32()] + [pa.list_(pa.float64())] * 2, strict=True)))
    q, d, factor = rng.normal(size=(6, n_docs)), rng.random(n_docs), rng.random(n_docs) + 0.5
    x, rows = [], []
    for n_terms, tfs in ((40, 4), (7, 2), (90, 1)):
        held = rng.random((n_docs, n_terms)) < rng.random(n_terms) ** 2
        held[0] = True
        t = held * (1 + np.log(rng.integers(1, tfs + 1, held.shape)))
        docs, terms = np.nonzero(t)
        squares = rng.random(n_terms) + 1
        buffers = lsa_module._arranged(docs, terms, t[docs, terms], n_docs, squares)
        if tfs == 1:
            assert buffers[2].nbytes == 8 * n_terms
        rows.append(dict(zip(names, [c.tobytes() for c in buffers] + [None] * 3, strict=True)))
        x.append(factor[:, None] * t * np.sqrt(squares))
    x = np.hstack(x)
    for b in range(2):
        lo, hi = offsets[b:b + 2]
        rows.insert(1, {"block": b, "vec": q[:, lo:hi].ravel().tolist()})
        rows.append({"block": b, "d": [*d[lo:hi].tolist(), *factor[lo:hi].tolist()]})
    out = {r["block"][0].as_py(): r for r in lsa_module._product(offsets, 0, scaled=True)([pa.RecordBatch.from_pylist(rows, schema)])}
    y = np.concatenate([out[b]["vec"][0].values.to_numpy().reshape(6, -1) for b in range(2)], axis=1)
    assert np.abs(y - (q @ x @ x.T + q * d)).max() < 1e-9


def test_cells_fill_the_cores():
    """12 cells on 8 cores took as long as 16 smaller ones would not."""
    assert lsa_module.balanced(4, 3, 8) == 4
    assert lsa_module.balanced(4, 2, 8) == 2 and lsa_module.balanced(1, 1, 8) == 1
    assert lsa_module.balanced(5, 4, 8) == 8


def _counting_factory(folder):
    def factory():
        import os
        import uuid
        open(os.path.join(folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w").close()
        return lambda texts: np.array([[len(t), t.count("a"), 1.0] for t in texts])
    return factory


def test_batch_encoder_loads_once_per_worker(spark, tmp_path):
    rows = [(i, None if i == 3 else "a" * (i % 7) + "b") for i in range(400)]
    texts = spark.createDataFrame(rows, "id long, text string").repartition(16)
    encoder = BatchEncoder(_counting_factory(str(tmp_path)), batch_size=9)
    for _ in range(2):
        got = {r["id"]: r["embedding"] for r in encoder(texts).collect()}
    assert got == {i: [float(len(t or "")), float((t or "").count("a")), 1.0] for i, t in rows}
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads)) <= 16                 # once in a process, though it ran many tasks
    with pytest.raises(Exception, match="shape"):
        BatchEncoder(lambda: lambda texts: np.zeros((1, 2)))(texts).collect()
    with pytest.raises(ValueError):
        BatchEncoder(_counting_factory(""), batch_size=0)
