"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Workload (whole tables): index build (BM25 postings + TF-IDF triplets written
to Parquet), substring judgments, batch search for every ``benchmark`` item
(BM25, TF-IDF cosine, hybrid RRF and linear), dense kNN of every embedding
against all embeddings, BM25 explain, evaluation of three retrievers, and an
LSA fit with the defaults (128 components, min_df=1).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from rankspan.operators.bm25 import Bm25Index  # noqa: E402
from rankspan.operators.dense import dense_knn  # noqa: E402
from rankspan.operators.evaluation import compare  # noqa: E402
from rankspan.operators.hybrid import HybridIndex  # noqa: E402
from rankspan.operators.lsa import LsaModel  # noqa: E402
from rankspan.operators.tfidf import TfidfModel  # noqa: E402
from rankspan.session import get_spark  # noqa: E402
from rankspan.sources import testdata as td  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):   # optional: stage timings via tools/stage_times.py
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = get_spark(f"local[{cpus}]", app="rankspan-bench", shuffle_partitions=2 * cpus, extra=extra)
    timings: dict[str, float] = {}

    def timed(name, fn):
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        out = fn()
        timings[name] = round(time.perf_counter() - t0, 3)
        return out

    corpus = td.corpus(spark, sf_dir)
    queries = td.queries(spark, sf_dir)
    k = 5

    bm25 = timed("index_bm25", lambda: Bm25Index.build(corpus))
    tfidf = timed("index_tfidf", lambda: TfidfModel.fit(corpus))
    from rankspan.session import scratch_path
    qrels_path = scratch_path(spark, "qrels")

    def judgments():
        td.qrels(spark, sf_dir).write.mode("overwrite").parquet(qrels_path)
        return spark.read.parquet(qrels_path)

    qrels = timed("qrels", judgments)
    bm25_res = timed("bm25_search", lambda: bm25.search(queries, k=k).collect())
    timed("tfidf_search", lambda: tfidf.search(queries, k=k).collect())
    emb = td.embeddings(spark, sf_dir)
    timed("dense_knn", lambda: dense_knn(emb.select(F.col("doc_id").alias("query_id"), "embedding"), emb,
                                         k=k).collect())
    hyb = HybridIndex(bm25, tfidf, fusion="rrf")
    timed("hybrid_rrf", lambda: hyb.search(queries, top_k=k).collect())
    timed("hybrid_linear", lambda: HybridIndex(bm25, tfidf, fusion="linear", alpha=0.7)
          .search(queries, top_k=k).collect())
    pairs = spark.createDataFrame([(r["query_id"], r["doc_id"]) for r in bm25_res if r["rank"] == 1],
                                  "query_id long, doc_id long").join(queries, "query_id")
    timed("bm25_explain", lambda: bm25.explain(pairs).collect())

    def evaluation():
        out = hyb.search(queries, top_k=k)
        res = {n: out.where(F.col("retriever") == r) for n, r in
               (("BM25", "bm25"), ("Vector", "vector"), ("Hybrid", "hybrid"))}
        return compare(res, qrels, queries, k=k).collect()

    timed("evaluation", evaluation)
    timed("lsa_fit", lambda: LsaModel.fit(corpus, tfidf=tfidf).n_components)

    total = round(sum(timings.values()), 3)
    print(json.dumps({"metric": "total_wall_sec", "value": total, "unit": "sec", "queries": timings,
                      "sf": os.path.basename(sf_dir).replace("sf", ""), "cores": cpus,
                      "spark": spark.version, "n_queries": queries.count()}))


if __name__ == "__main__":
    main()
