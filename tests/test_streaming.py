from rankspan.operators.bm25 import Bm25Index
from rankspan.streaming.search_stream import search_stream


def test_stream_of_queries(spark, fx, tmp_path):
    corpus, queries, _ = fx
    idx = Bm25Index.build(corpus)
    src = str(tmp_path / "src")
    out = str(tmp_path / "out")
    queries.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(queries.schema).parquet(src)
    q = search_stream(stream, lambda b: idx.search(b, k=3), out,
                      checkpoint_location=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    assert got.count() == 15
    want = {(r["query_id"], r["rank"], r["doc_id"]) for r in idx.search(queries, k=3).collect()}
    assert {(r["query_id"], r["rank"], r["doc_id"]) for r in got.collect()} == want
