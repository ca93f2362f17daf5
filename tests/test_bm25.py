import re

import pytest
from pyspark.sql import functions as F

from rankspan.operators.bm25 import Bm25Index

GOLD = {
    "q1": [("m1", 1.853231), ("m2", 1.635066), ("m3", 0), ("m4", 0), ("m5", 0), ("m6", 0)],
    "q2": [(f"m{i}", 0) for i in range(1, 7)],
    "q3": [("m5", 0.989456), ("m6", 0.908638), ("m3", 0.392493), ("m4", 0.392493), ("m1", 0.358947),
           ("m2", 0.316691)],
    "q4": [(f"m{i}", 0) for i in range(1, 7)],
    "q5": [("m2", 3.058906), ("m1", 0), ("m3", 0), ("m4", 0), ("m5", 0), ("m6", 0)],
}


@pytest.fixture(scope="module")
def idx(fx):
    return Bm25Index.build(fx[0])


def ranking(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["doc_id"], round(r["bm25_score"], 6)))
    return out


def test_index_statistics(idx):
    s = idx.stats.first()
    assert s["n_docs"] == 6 and abs(s["avgdl"] - 13.833333) < 1e-6
    lens = {r["doc_id"]: r["doc_len"] for r in idx.doc_lengths.collect()}
    assert lens == {"m1": 17, "m2": 15, "m3": 12, "m4": 12, "m5": 13, "m6": 14}
    terms = {r["term"]: (r["df"], round(r["raw_idf"], 6), round(r["idf"], 6)) for r in idx.terms.collect()}
    assert len(terms) == 41
    assert terms["the"] == (6, -2.564949, 0.227693)
    assert terms["ferry"] == (2, 0.587787, 0.587787)
    assert terms["pier"][2] == 0 and terms["bakery"][2] == 0 and terms["coffee"][2] == 0
    assert terms["offseason"][2] == 1.299283 and terms["harbor"][2] == 1.299283


def test_full_ranking_with_padding(idx, fx):
    assert ranking(idx.search(fx[1], k=6)) == GOLD


def test_top_k_cut_and_zero(idx, fx):
    got = ranking(idx.search(fx[1], k=2))
    assert got == {q: v[:2] for q, v in GOLD.items()}
    assert idx.search(fx[1], k=0).count() == 0
    with pytest.raises(ValueError):
        idx.search(fx[1], k=-1)


def test_explain(idx, spark):
    pairs = spark.createDataFrame([("q1", "ferry ferry pier", "m1"), ("q1", "ferry ferry pier", "nope")],
                                  "query_id string, query string, doc_id string")
    rows = {r["doc_id"]: r for r in idx.explain(pairs).collect()}
    m1 = rows["m1"]
    assert m1["query_tokens"] == ["ferry", "ferry", "pier"]
    assert m1["doc_token_count"] == 17
    assert {k: round(v, 6) for k, v in m1["term_contributions"].items()} == {"ferry": 0.926615, "pier": 0.0}
    assert round(m1["total_score"], 6) == 0.926615 and m1["error"] is None
    assert rows["nope"]["error"] == "Document nope not found" and rows["nope"]["total_score"] is None


def test_explain_total_equals_search_for_distinct_tokens(idx, fx, spark):
    q = spark.createDataFrame([("q3", "the valley")], "query_id string, query string")
    res = {r["doc_id"]: r["bm25_score"] for r in idx.search(q, k=6).collect()}
    pairs = q.crossJoin(fx[0].select("doc_id"))
    tot = {r["doc_id"]: r["total_score"] for r in idx.explain(pairs).collect()}
    assert all(abs(res[d] - tot[d]) < 1e-12 for d in res)


def test_parameters(idx, fx):
    flat = ranking(idx.with_params(b=0.0).search(fx[1], k=6))
    full = ranking(idx.with_params(b=1.0).search(fx[1], k=6))
    assert flat != full
    assert flat["q1"][0][0] == "m1"


def test_negative_idf_floor_corpus(spark):
    # every term in more than half the documents -> mean raw idf < 0, negative scores
    docs = spark.createDataFrame([("a", 1, None, "red blue"), ("b", 2, None, "red blue"), ("c", 3, None, "red green")],
                                 "doc_id string, pos long, title string, text string")
    idx = Bm25Index.build(docs)
    assert idx.negative_floor()
    q = spark.createDataFrame([("q", "red")], "query_id string, query string")
    got = [(r["doc_id"], r["bm25_score"]) for r in idx.search(q, k=3).orderBy("rank").collect()]
    assert [d for d, _ in got] == ["a", "b", "c"] and all(s < 0 for _, s in got)


def test_plan_shape(idx, fx):
    plan = idx.search(fx[1], k=5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_partition_independence(spark, fx):
    base = None
    for n in (1, 7, 200):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        got = ranking(Bm25Index.build(fx[0]).search(fx[1], k=6))
        base = base or got
        assert got == base
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_staged_index_is_reused(idx, fx, spark, tmp_path):
    placed = Bm25Index.build(fx[0], path=str(tmp_path / "index"))
    assert ranking(placed.search(fx[1], k=6)) == GOLD
    assert ranking(placed.with_params(b=0.0).search(fx[1], k=6)) == ranking(idx.with_params(b=0.0).search(fx[1], k=6))


def test_scores_need_no_exchange_by_document(idx, fx):
    plan = idx.score(fx[1])._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\((query_id|doc_id)", plan), plan


def test_results_without_broadcast(fx, spark):
    """Every join as a shuffle join: results must not change."""
    from rankspan.operators.fusion import linear_fusion
    pairs = spark.createDataFrame([("q1", "ferry ferry pier", "m1")], "query_id string, query string, doc_id string")
    want_ex = {r["term"]: r["contribution"] for r in Bm25Index.build(fx[0]).explain_terms(pairs).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        idx = Bm25Index.build(fx[0])
        assert ranking(idx.search(fx[1], k=6)) == GOLD
        assert {r["term"]: r["contribution"] for r in idx.explain_terms(pairs).collect()} == want_ex
        b = idx.search(fx[1], k=3).select("query_id", "rank", "doc_id", "bm25_score")
        assert linear_fusion(b, b.withColumnRenamed("bm25_score", "vector_score")).count() == 15
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_build_errors(spark):
    schema = "doc_id string, pos long, title string, text string"
    with pytest.raises(ValueError, match="no documents"):
        Bm25Index.build(spark.createDataFrame([], schema))
    with pytest.raises(ValueError, match="no text"):
        Bm25Index.build(spark.createDataFrame([("a", 1, None, "x y"), ("b", 2, None, None)], schema))


def test_search_needs_an_index(spark):
    q = spark.createDataFrame([("q", "red")], "query_id string, query string")
    for call in (lambda: Bm25Index().search(q), lambda: Bm25Index().explain(q.withColumn("doc_id", F.lit("a"))),
                 lambda: Bm25Index().sweep(q, [(1.0, 0.5)])):
        with pytest.raises(RuntimeError, match="build the index before"):
            call()


def test_sweep_equals_single_searches(idx, fx, spark):
    params = [(1.5, 0.75), (1.2, 0.0), (2.0, 1.0)]
    found = idx.sweep(fx[1], params, k=4)
    got = sorted((r["k1"], r["b"], r["query_id"], r["rank"], r["doc_id"], round(r["bm25_score"], 9)) for r in found.collect())
    want = sorted((k1, b, r["query_id"], r["rank"], r["doc_id"], round(r["bm25_score"], 9))
                  for k1, b in params for r in idx.with_params(k1, b).search(fx[1], k=4).collect())
    assert got == want
    # one read of the index whatever the number of pairs (the other scans are weights and lengths)
    scans = [p.count("FileScan") for p in (idx.sweep(fx[1], x, k=4)._jdf.queryExecution().executedPlan().toString() for x in (params, params[:1]))]
    assert scans[0] == scans[1]
