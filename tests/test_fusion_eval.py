import itertools
import random

import pytest
from pyspark.sql import functions as F

from rankspan.operators.evaluation import compare, evaluate, per_query
from rankspan.operators.common import stage
from rankspan.operators.fusion import linear_fusion, minmax_bounds, reciprocal_rank_fusion
from rankspan.operators.hybrid import HybridIndex
from rankspan.operators.lsa import LsaModel
from rankspan.sources.sinks import comparison_table, explain_bars, result_lines


@pytest.fixture(scope="module")
def lsa_hybrid(fx):
    from rankspan.operators.bm25 import Bm25Index
    return Bm25Index.build(fx[0]), LsaModel.fit(fx[0])


def rows(df, col):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["doc_id"], round(r[col], 6) + 0.0))
    return out


def test_rrf_golden(lsa_hybrid, fx):
    bm25, lsa = lsa_hybrid
    h = HybridIndex(bm25, lsa, fusion="rrf")
    got = rows(h.search(fx[1], top_k=3).where("retriever = 'hybrid'"), "rrf_score")
    assert got["q1"] == [("m1", 0.032787), ("m2", 0.032258), ("m3", 0.031498)]
    assert got["q2"] == [("m4", 0.032018), ("m3", 0.032002), ("m1", 0.031545)]
    assert got["q3"] == [("m5", 0.032522), ("m6", 0.032522), ("m3", 0.031498)]
    assert got["q4"] == [("m1", 0.031545), ("m6", 0.031545), ("m2", 0.031514)]
    assert got["q5"] == [("m2", 0.032787), ("m1", 0.031281), ("m6", 0.031281)]
    shallow = rows(h.search(fx[1], top_k=10, fetch_k=3).where("retriever = 'hybrid'"), "rrf_score")
    assert shallow["q2"] == [("m3", 0.032002), ("m1", 0.016393), ("m4", 0.016393), ("m2", 0.016129),
                             ("m6", 0.015873)]


def test_linear_golden(lsa_hybrid, fx):
    bm25, lsa = lsa_hybrid
    h = HybridIndex(bm25, lsa, fusion="linear", alpha=0.7)
    got = rows(h.search(fx[1], top_k=10, fetch_k=3).where("retriever = 'hybrid'"), "linear_score")
    assert got["q1"] == [("m1", 1.0), ("m2", 0.590782), ("m4", 0.0), ("m3", -0.238551)]
    assert got["q2"] == [("m3", 0.7), ("m4", 0.7), ("m6", 0.0), ("m1", -19.146848), ("m2", -19.146848)]
    assert got["q3"] == [("m6", 0.959386), ("m5", 0.92828), ("m3", 0.0), ("m4", -0.197245)]
    h5 = HybridIndex(bm25, lsa, fusion="linear", alpha=0.5)
    g5 = rows(h5.search(fx[1], top_k=6).where("retriever = 'hybrid'"), "linear_score")
    assert g5["q1"] == [("m1", 1.0), ("m2", 0.741949), ("m3", 0.127085), ("m4", 0.127085), ("m5", 0.0), ("m6", 0.0)]


def test_field_precedence(spark):
    b = spark.createDataFrame([("q", "a", 1, 2.0), ("q", "b", 2, 1.0)], "query_id string, doc_id string, rank int, bm25_score double")
    v = spark.createDataFrame([("q", "b", 1, 0.9), ("q", "c", 2, 0.5)], "query_id string, doc_id string, rank int, vector_score double")
    r = {x["doc_id"]: x for x in reciprocal_rank_fusion([b, v]).collect()}
    assert r["b"]["bm25_score"] == 1.0 and r["b"]["vector_score"] is None   # first list wins
    li = {x["doc_id"]: x for x in linear_fusion(b, v).collect()}
    assert li["b"]["vector_score"] == 0.9 and li["b"]["bm25_score"] is None  # last list wins
    assert li["a"]["bm25_score"] == 2.0


def test_rrf_symmetry_property(spark):
    rnd = random.Random(3)
    docs = [f"d{i}" for i in range(30)]
    lists = []
    for _ in range(3):
        sample = rnd.sample(docs, 12)
        lists.append(spark.createDataFrame([("q", d, i + 1) for i, d in enumerate(sample)],
                                           "query_id string, doc_id string, rank int"))
    scores = None
    for perm in itertools.permutations(lists):
        s = {r["doc_id"]: r["rrf_score"] for r in reciprocal_rank_fusion(list(perm)).collect()}
        scores = scores or s
        assert s == scores


def test_evaluation_golden(lsa_hybrid, fx):
    bm25, lsa = lsa_hybrid
    out = HybridIndex(bm25, lsa, fusion="rrf").search(fx[1], top_k=3)
    res = {"BM25": out.where("retriever='bm25'"), "Vector": out.where("retriever='vector'"),
           "Hybrid": out.where("retriever='hybrid'")}
    m = {r["retriever"]: r for r in compare(res, fx[2], fx[1], k=3).collect()}
    assert (m["BM25"]["Precision@3"], m["BM25"]["Recall@3"], m["BM25"]["MRR"], m["BM25"]["HitRate@3"]) == \
        (0.3333, 0.6, 0.6, 0.6)
    assert m["Vector"]["MRR"] == 0.4667 and m["Hybrid"]["MRR"] == 0.6
    assert m["BM25"]["num_queries"] == 5
    table = {r["Retriever"]: r for r in comparison_table(compare(res, fx[2], fx[1], k=3), 3).collect()}
    assert table["Vector"]["MRR"] == "0.4667"


def test_metric_invariants(spark):
    rnd = random.Random(11)
    res, rel = [], []
    for q in range(20):
        docs = rnd.sample(range(50), 8)
        res += [(q, i + 1, d) for i, d in enumerate(docs)]
        rel += [(q, d) for d in rnd.sample(range(50), rnd.randint(0, 6))]
    rdf = spark.createDataFrame(res, "query_id long, rank int, doc_id long")
    qrels = spark.createDataFrame(rel, "query_id long, doc_id long")
    queries = spark.createDataFrame([(q,) for q in range(25)], "query_id long")  # 5 without results
    pq = per_query(rdf, qrels, queries, k=5).collect()
    nrel = {}
    for q, d in set(rel):
        nrel[q] = nrel.get(q, 0) + 1
    for r in pq:
        assert r["hit_rate"] in (0.0, 1.0)
        if nrel.get(r["query_id"]):
            assert abs(r["precision"] * 5 - r["recall"] * nrel[r["query_id"]]) < 1e-9
    m = evaluate(rdf, qrels, queries, k=5).first()
    assert m["num_queries"] == 25
    assert abs(m["Precision@5"] - round(sum(r["precision"] for r in pq) / 25, 4)) < 1e-12


def test_sinks(spark):
    res = spark.createDataFrame([("q", "hybrid", 1, "d1", None, None, 0.0327868, None)],
                                "query_id string, retriever string, rank int, doc_id string, bm25_score double, "
                                "vector_score double, rrf_score double, linear_score double")
    line = result_lines(res, title_col=None).first()["line"]
    assert line == "[1] " + "RRF=0.032787".ljust(20) + " | d1 | "
    terms = spark.createDataFrame([("q", "d", "a", 2.0), ("q", "d", "b", 1.0), ("q", "d", "c", 0.0)],
                                  "query_id string, doc_id string, term string, contribution double")
    bars = {r["term"]: r["bar"] for r in explain_bars(terms).collect()}
    assert len(bars["a"]) == 40 and len(bars["b"]) == 20 and bars["c"] == ""


def test_unknown_fusion(fx):
    with pytest.raises(ValueError):
        HybridIndex.build(fx[0], fusion="max")


def test_missing_list_is_an_error(spark):
    b = spark.createDataFrame([("q", "a", 1, 2.0)], "query_id string, doc_id string, rank int, bm25_score double")
    v = spark.createDataFrame([("r", "b", 1, 0.9)], "query_id string, doc_id string, rank int, vector_score double")
    with pytest.raises(Exception, match="list is empty for query"):
        linear_fusion(b, v).collect()


def test_silent_retriever_keeps_its_row(spark, fx):
    none = spark.createDataFrame([], "query_id string, rank int, doc_id string")
    rows_ = compare({"Silent": none}, fx[2], fx[1], k=3).collect()
    assert [(r["retriever"], r["MRR"], r["num_queries"]) for r in rows_] == [("Silent", 0.0, 5)]
    assert compare({}, fx[2], fx[1], k=3).count() == 0


def test_k_zero_and_duplicates(spark):
    res = spark.createDataFrame([("q", 1, "a"), ("q", 2, "a")], "query_id string, rank int, doc_id string")
    rel = spark.createDataFrame([("q", "a"), ("q", "a")], "query_id string, doc_id string")
    qs = spark.createDataFrame([("q",)], "query_id string")
    assert per_query(res, rel, qs, k=0).first()["precision"] == 0.0
    assert per_query(res, rel, qs, k=2).first()["precision"] == 1.0


def test_dispatch(fx, lsa_hybrid):
    h = HybridIndex(*lsa_hybrid, fusion="rrf")
    h.fusion = "max"
    with pytest.raises(ValueError, match="Unknown fusion"):
        h.search(fx[1], top_k=2)
    with pytest.raises(ValueError, match="Unknown encoder"):
        HybridIndex.build(fx[0], encoder="nope")


def test_alpha_is_taken_as_is(spark):
    """Weights outside [0, 1] are not clipped."""
    b = spark.createDataFrame([(1, 1, 10, 4.0), (1, 2, 11, 2.0)], "query_id long, rank int, doc_id long, bm25_score double")
    v = spark.createDataFrame([(1, 1, 11, 0.9), (1, 2, 10, 0.1)], "query_id long, rank int, doc_id long, vector_score double")
    for alpha in (1.5, -0.5):
        got = {r["doc_id"]: r["linear_score"] for r in linear_fusion(b, v, alpha=alpha).collect()}
        assert got == {10: 1.0 - alpha, 11: alpha}


def test_linear_fusion_reads_each_list_once(spark):
    """The bounds do not make the lists again; they are those of ``minmax_bounds``."""
    rows = [(1, 1, 10, 3.0), (1, 2, 11, 1.0), (2, 1, 10, 2.0), (2, 2, 12, 2.0)]
    b = stage(spark.createDataFrame(rows, "query_id long, rank int, doc_id long, bm25_score double"), "test-list")
    v = stage(spark.createDataFrame([(1, 1, 12, 0.9), (1, 2, 11, 0.4), (2, 1, 12, 0.0), (2, 2, 13, -0.5)],
                                    "query_id long, rank int, doc_id long, vector_score double"), "test-list")
    out = linear_fusion(b, v)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2
    bounds = {r["query_id"]: (r["m_min"], r["m_range"]) for r in minmax_bounds(b, "bm25_score", "m").collect()}
    assert bounds == {1: (1.0, 2.0), 2: (2.0, 1.0)}
    got = {(r["query_id"], r["doc_id"]): r["linear_score"] for r in out.collect()}
    assert got == {(1, 10): 0.1, (1, 11): 0.0, (1, 12): 0.25, (2, 10): 0.5, (2, 12): 0.5, (2, 13): -1.0}
