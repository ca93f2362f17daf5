"""Registered workloads: one DataFrame-returning function per operator.

Each takes ``(spark, sf_dir)`` and runs over the whole driver tables.  Scores
are rounded to 6 decimals and integer columns cast to BIGINT so the output can
be compared value by value with the DuckDB statements in ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import bm25_tokens, vector_words, word_ngrams
from ..operators.bm25 import Bm25Index, query_terms
from ..operators.dense import dense_knn
from ..operators.evaluation import compare, evaluate, per_query
from ..operators.fusion import linear_fusion, minmax_bounds, reciprocal_rank_fusion
from ..operators.hybrid import BatchEncoder, HybridIndex
from ..operators.lsa import LsaModel
from ..operators.segments import SegmentIndex
from ..operators.tfidf import TfidfModel
from ..sources.sinks import comparison_table, explain_bars, index_stats, result_lines
from ..functions.vector import l2_norm, l2_normalize
from ..session import scratch_path
from ..sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

TOP_K = 5
FETCH_K = 15          # max(3 * TOP_K, 10)
SWEEP = ((1.2, 0.0), (2.0, 1.0))


def register(name: str):
    def wrap(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return wrap


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def _bm25(spark: SparkSession, sf_dir: str, **kw) -> Bm25Index:
    return Bm25Index.build(td.corpus(spark, sf_dir), **kw)


def _ranked(df: DataFrame, score: str) -> DataFrame:
    return df.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", r6(score).alias(score))


# --------------------------------------------------------------------------- text
@register("tokenize")
def tokenize(spark, sf_dir):
    toks = bm25_tokens(F.concat(F.lit(" "), F.col("text")))
    return (td.corpus(spark, sf_dir).select("doc_id", toks.alias("t"))
            .select("doc_id", F.size("t").cast("long").alias("n_tokens"), F.concat_ws(" ", "t").alias("tokens")))


# --------------------------------------------------------------------------- bm25 index
@register("term_frequency")
def term_frequency(spark, sf_dir):
    return _bm25(spark, sf_dir).postings.select("doc_id", "term", F.col("tf").cast("long").alias("tf"))


@register("doc_length")
def doc_length(spark, sf_dir):
    return _bm25(spark, sf_dir).doc_lengths.select("doc_id", F.col("doc_len").cast("long").alias("doc_len"))


@register("corpus_stats")
def corpus_stats(spark, sf_dir):
    return _bm25(spark, sf_dir).stats.select(F.col("n_docs").cast("long").alias("n_docs"), r6("avgdl").alias("avgdl"),
                                             F.col("n_tokens").cast("long").alias("n_tokens"))


@register("document_frequency")
def document_frequency(spark, sf_dir):
    return _bm25(spark, sf_dir).terms.select("term", F.col("df").cast("long").alias("df"))


@register("bm25_idf")
def bm25_idf(spark, sf_dir):
    return _bm25(spark, sf_dir).terms.select("term", F.col("df").cast("long").alias("df"),
                                             r6("raw_idf").alias("raw_idf"), r6("idf").alias("idf"))


@register("query_terms")
def bm25_query_terms(spark, sf_dir):
    return query_terms(td.queries(spark, sf_dir)).select("query_id", "term", F.col("qtf").cast("long").alias("qtf"))


# --------------------------------------------------------------------------- bm25 search
@register("bm25_search")
def bm25_search(spark, sf_dir):
    return _ranked(_bm25(spark, sf_dir).search(td.queries(spark, sf_dir), k=TOP_K), "bm25_score")


def _sparse_queries(spark, sf_dir) -> DataFrame:
    """Two queries per benchmark item that match few documents or none: its
    last token in alphabetical order, and its text without spaces (one word
    that no document has)."""
    qs = td.queries(spark, sf_dir)
    last = qs.select((F.col("query_id") * 2).alias("query_id"), F.array_max(bm25_tokens("query")).alias("query"))
    none = qs.select((F.col("query_id") * 2 + 1).alias("query_id"), F.regexp_replace("query", "[ \n]+", "").alias("query"))
    return last.unionByName(none)


@register("bm25_search_padded")
def bm25_search_padded(spark, sf_dir):
    """Fetch depth 15 for queries that match fewer documents than that: lists
    are filled with score 0 in corpus order."""
    return _ranked(_bm25(spark, sf_dir).search(_sparse_queries(spark, sf_dir), k=FETCH_K), "bm25_score")


@register("bm25_search_fields")
def bm25_search_fields(spark, sf_dir):
    res = _bm25(spark, sf_dir).search(td.queries(spark, sf_dir), k=TOP_K, fields=True)
    return res.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", r6("bm25_score").alias("bm25_score"),
                      "lang", "source", "n_chars")


@register("bm25_k1_b")
def bm25_k1_b(spark, sf_dir):
    found = _bm25(spark, sf_dir).sweep(td.queries(spark, sf_dir), SWEEP, k=TOP_K)
    return found.select("k1", "b", "query_id", F.col("rank").cast("long").alias("rank"), "doc_id", r6("bm25_score").alias("bm25_score"))


# --------------------------------------------------------------------------- an index that lives on
def _segments(spark, corpus) -> SegmentIndex:
    return SegmentIndex.create(corpus, scratch_path(spark, "segments"))


@register("bm25_reopened")
def bm25_reopened(spark, sf_dir):
    """Block-max pruned search of an index opened from its folder."""
    path = _segments(spark, td.corpus(spark, sf_dir)).path
    return _ranked(SegmentIndex.open(spark, path).search(td.queries(spark, sf_dir), k=TOP_K), "bm25_score")


@register("bm25_appended")
def bm25_appended(spark, sf_dir):
    """English documents first, all others appended to the opened index."""
    corpus = td.corpus(spark, sf_dir)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    path = _segments(spark, corpus.where(english)).path
    idx = SegmentIndex.open(spark, path).append(corpus.where(~english))
    return _ranked(idx.search(td.queries(spark, sf_dir), k=TOP_K), "bm25_score")


@register("bm25_deleted")
def bm25_deleted(spark, sf_dir):
    """The largest source taken out again."""
    corpus = td.corpus(spark, sf_dir)
    idx = _segments(spark, corpus).delete(corpus.where("source = 'src0'").select("doc_id"))
    return _ranked(SegmentIndex.open(spark, idx.path).search(td.queries(spark, sf_dir), k=TOP_K), "bm25_score")


def _explain_pairs(spark, sf_dir, idx: Bm25Index) -> DataFrame:
    qs = td.queries(spark, sf_dir)
    top1 = idx.search(qs, k=1).select("query_id", "doc_id")
    unknown = qs.select("query_id", F.lit(-1).cast("long").alias("doc_id"))
    return top1.unionByName(unknown).join(qs, "query_id")


@register("bm25_explain")
def bm25_explain(spark, sf_dir):
    idx = _bm25(spark, sf_dir)
    return idx.explain_terms(_explain_pairs(spark, sf_dir, idx)).select(
        "query_id", "doc_id", "term", r6("contribution").alias("contribution"))


@register("bm25_explain_total")
def bm25_explain_total(spark, sf_dir):
    idx = _bm25(spark, sf_dir)
    ex = idx.explain(_explain_pairs(spark, sf_dir, idx))
    found = F.col("error").isNull()
    return ex.select("query_id", "doc_id",
                     F.when(found, F.size("query_tokens")).cast("long").alias("n_query_tokens"),
                     F.col("doc_token_count").cast("long").alias("doc_token_count"),
                     F.when(found, F.size(F.map_keys("term_contributions"))).cast("long").alias("n_terms"),
                     r6("total_score").alias("total_score"), "error")


@register("bm25_explain_missing")
def bm25_explain_missing(spark, sf_dir):
    idx = _bm25(spark, sf_dir)
    ex = idx.explain(_explain_pairs(spark, sf_dir, idx))
    return ex.where(F.col("error").isNotNull()).select("query_id", "doc_id", "error")


# --------------------------------------------------------------------------- judgments
@register("qrels")
def qrels(spark, sf_dir):
    return td.qrels(spark, sf_dir)


# --------------------------------------------------------------------------- tf-idf
def _tfidf(spark: SparkSession, sf_dir: str, **kw) -> TfidfModel:
    return TfidfModel.fit(td.corpus(spark, sf_dir), **kw)


@register("ngrams")
def ngrams(spark, sf_dir):
    words = vector_words(F.concat(F.lit(". "), F.col("text")))
    return (td.corpus(spark, sf_dir).select("doc_id", words.alias("w"))
            .select("doc_id", word_ngrams(F.col("w")).alias("g"))
            .select("doc_id", F.size("g").cast("long").alias("n_ngrams"), F.concat_ws("|", "g").alias("ngrams")))


@register("ngram_tf")
def ngram_tf(spark, sf_dir):
    return _tfidf(spark, sf_dir).term_counts.select("doc_id", "term", F.col("tf").cast("long").alias("tf"))


@register("vocabulary")
def vocabulary(spark, sf_dir):
    return _tfidf(spark, sf_dir).vocabulary.select("term", F.col("df").cast("long").alias("df"))


@register("tfidf_idf")
def tfidf_idf(spark, sf_dir):
    return _tfidf(spark, sf_dir).vocabulary.select("term", F.col("df").cast("long").alias("df"), r6("idf").alias("idf"))


@register("tfidf")
def tfidf(spark, sf_dir):
    return _tfidf(spark, sf_dir).doc_weights.select("doc_id", "term", r6("weight").alias("weight"))


@register("tfidf_query")
def tfidf_query(spark, sf_dir):
    return _tfidf(spark, sf_dir).transform(td.queries(spark, sf_dir)).select("query_id", "term",
                                                                             r6("weight").alias("weight"))


@register("top_terms")
def top_terms(spark, sf_dir):
    t = _tfidf(spark, sf_dir).top_terms(td.queries(spark, sf_dir), n=10)
    return t.select("query_id", F.col("rank").cast("long").alias("rank"), "term", r6("weight").alias("weight"))


@register("tfidf_cosine_search")
def tfidf_cosine_search(spark, sf_dir):
    return _ranked(_tfidf(spark, sf_dir).search(td.queries(spark, sf_dir), k=TOP_K), "vector_score")


# --------------------------------------------------------------------------- dense vectors
@register("l2_normalize")
def l2_normalize_embeddings(spark, sf_dir):
    e = td.embeddings(spark, sf_dir)
    return (e.select("doc_id", F.posexplode(l2_normalize(F.col("embedding"))).alias("dim", "value"))
            .select("doc_id", F.col("dim").cast("long").alias("dim"), r6("value").alias("value")))


@register("dense_knn")
def dense_knn_embeddings(spark, sf_dir):
    """Every embedding as a query against the whole embedding table (kNN graph)."""
    e = td.embeddings(spark, sf_dir)
    res = dense_knn(e.select(F.col("doc_id").alias("query_id"), "embedding"), e, k=TOP_K)
    return _ranked(res, "vector_score")


# --------------------------------------------------------------------------- fusion / hybrid
LINEAR_ALPHA = 0.7


def _lists(spark, sf_dir, fetch_k: int = FETCH_K):
    qs = td.queries(spark, sf_dir)
    c = td.corpus(spark, sf_dir)
    bm25 = Bm25Index.build(c)
    b = bm25.search(qs, k=fetch_k).select("query_id", "rank", "doc_id", "bm25_score")
    v = TfidfModel.fit(c).search(qs, k=fetch_k).select("query_id", "rank", "doc_id", "vector_score")
    return qs, bm25, b, v


def _fused(df: DataFrame, score: str, extra=()) -> DataFrame:
    return df.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", r6(score).alias(score),
                     *[r6(c).alias(c) for c in extra])


@register("rrf")
def rrf(spark, sf_dir):
    _, _, b, v = _lists(spark, sf_dir)
    return _fused(reciprocal_rank_fusion([b, v]), "rrf_score")


@register("rrf_three_lists")
def rrf_three_lists(spark, sf_dir):
    qs, bm25, b, v = _lists(spark, sf_dir)
    k1, bb = SWEEP[0]
    b2 = bm25.with_params(k1=k1, b=bb).search(qs, k=FETCH_K).select("query_id", "rank", "doc_id")
    return _fused(reciprocal_rank_fusion([b.drop("bm25_score"), v.drop("vector_score"), b2]), "rrf_score")


@register("rrf_fields")
def rrf_fields(spark, sf_dir):
    _, _, b, v = _lists(spark, sf_dir)
    return _fused(reciprocal_rank_fusion([b, v]), "rrf_score", ("bm25_score", "vector_score"))


@register("linear_fusion")
def linear_fusion_q(spark, sf_dir):
    _, _, b, v = _lists(spark, sf_dir)
    return _fused(linear_fusion(b, v, alpha=0.5), "linear_score")


@register("minmax_normalize")
def minmax_normalize(spark, sf_dir):
    _, _, b, v = _lists(spark, sf_dir)
    bb = minmax_bounds(b, "bm25_score", "m").withColumn("list", F.lit("bm25"))
    vb = minmax_bounds(v, "vector_score", "m").withColumn("list", F.lit("vector"))
    return bb.unionByName(vb).select("query_id", "list", r6("m_min").alias("min_score"),
                                     r6("m_range").alias("score_range"))


@register("linear_fields")
def linear_fields(spark, sf_dir):
    _, _, b, v = _lists(spark, sf_dir)
    return _fused(linear_fusion(b, v, alpha=LINEAR_ALPHA), "linear_score", ("bm25_score", "vector_score"))


def _hybrid_out(df: DataFrame) -> DataFrame:
    return df.select("query_id", "retriever", F.col("rank").cast("long").alias("rank"), "doc_id",
                     *[r6(c).alias(c) for c in ("bm25_score", "vector_score", "rrf_score", "linear_score")])


def _hybrid(spark, sf_dir, **kw) -> HybridIndex:
    return HybridIndex.build(td.corpus(spark, sf_dir), encoder="tfidf", **kw)


@register("hybrid_rrf")
def hybrid_rrf(spark, sf_dir):
    return _hybrid_out(_hybrid(spark, sf_dir, fusion="rrf").search(td.queries(spark, sf_dir), top_k=TOP_K))


@register("vector_search_fields")
def vector_search_fields(spark, sf_dir):
    res = _tfidf(spark, sf_dir).search(td.queries(spark, sf_dir), k=TOP_K, fields=True)
    return res.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", r6("vector_score").alias("vector_score"),
                      "lang", "source", "n_chars")


@register("hybrid_fields")
def hybrid_fields(spark, sf_dir):
    """Every list with the query text and the document's columns."""
    out = _hybrid(spark, sf_dir, fusion="rrf").search(td.queries(spark, sf_dir), top_k=TOP_K, fields=True)
    return out.select("query_id", F.length("query").cast("long").alias("query_chars"), "retriever",
                      F.col("rank").cast("long").alias("rank"), "doc_id", "lang", "source", "n_chars",
                      F.length("text").cast("long").alias("text_chars"))


def _byte_share_encoder(texts: DataFrame) -> DataFrame:
    """A callable encoder: shares of the vowels among the characters of a text."""
    low = F.lower("text")
    size = F.greatest(F.length("text"), F.lit(1))
    parts = [((F.length(low) - F.length(F.translate(low, v, ""))) / size).cast("double") for v in "aeiou"]
    return texts.select("id", F.array(*parts).alias("embedding"))


@register("encoder_callable")
def encoder_callable(spark, sf_dir):
    """Vector list of a hybrid index whose encoder is a function of texts."""
    h = HybridIndex.build(td.corpus(spark, sf_dir), encoder=_byte_share_encoder)
    return _ranked(h.vector.search(td.queries(spark, sf_dir), k=TOP_K), "vector_score")


def _vowel_encoder():
    """Factory of a batch encoder that does in Python what ``_byte_share_encoder`` does."""
    def encode(texts):
        return [[t.lower().count(v) / max(len(t.lower()), 1) for v in "aeiou"] for t in texts]
    return encode


@register("encoder_batches")
def encoder_batches(spark, sf_dir):
    """Vector list of a hybrid index whose encoder is loaded once per worker."""
    h = HybridIndex.build(td.corpus(spark, sf_dir), encoder=BatchEncoder(_vowel_encoder))
    return _ranked(h.vector.search(td.queries(spark, sf_dir), k=TOP_K), "vector_score")


@register("hybrid_fetch_k")
def hybrid_fetch_k(spark, sf_dir):
    """top_k = 3 -> default fetch depth max(9, 10) = 10."""
    return _hybrid_out(_hybrid(spark, sf_dir, fusion="rrf").search(td.queries(spark, sf_dir), top_k=3))


@register("hybrid_linear")
def hybrid_linear(spark, sf_dir):
    h = _hybrid(spark, sf_dir, fusion="linear", alpha=LINEAR_ALPHA)
    return _hybrid_out(h.search(td.queries(spark, sf_dir), top_k=4))


# --------------------------------------------------------------------------- evaluation
def _per_query(spark, sf_dir) -> DataFrame:
    qs = td.queries(spark, sf_dir)
    res = Bm25Index.build(td.corpus(spark, sf_dir)).search(qs, k=TOP_K)
    return per_query(res, td.qrels(spark, sf_dir), qs, k=TOP_K)


@register("precision_at_k")
def precision_at_k(spark, sf_dir):
    return _per_query(spark, sf_dir).select("query_id", r6("precision").alias("precision"))


@register("recall_at_k")
def recall_at_k(spark, sf_dir):
    return _per_query(spark, sf_dir).select("query_id", r6("recall").alias("recall"))


@register("reciprocal_rank")
def reciprocal_rank(spark, sf_dir):
    return _per_query(spark, sf_dir).select("query_id", r6("reciprocal_rank").alias("reciprocal_rank"))


@register("hit_rate_at_k")
def hit_rate_at_k(spark, sf_dir):
    return _per_query(spark, sf_dir).select("query_id", r6("hit_rate").alias("hit_rate"))


@register("evaluate_retriever")
def evaluate_retriever(spark, sf_dir):
    qs = td.queries(spark, sf_dir)
    res = Bm25Index.build(td.corpus(spark, sf_dir)).search(qs, k=TOP_K).withColumn("retriever", F.lit("BM25"))
    return evaluate(res, td.qrels(spark, sf_dir), qs, k=TOP_K)


def _comparison(spark, sf_dir) -> DataFrame:
    qs = td.queries(spark, sf_dir)
    out = _hybrid(spark, sf_dir, fusion="rrf").search(qs, top_k=TOP_K)
    names = {"BM25": "bm25", "Vector": "vector", "Hybrid": "hybrid"}
    return compare({n: out.where(F.col("retriever") == r) for n, r in names.items()}, td.qrels(spark, sf_dir), qs,
                   k=TOP_K)


@register("compare_retrievers")
def compare_retrievers(spark, sf_dir):
    return _comparison(spark, sf_dir)


@register("evaluate_empty")
def evaluate_empty(spark, sf_dir):
    """A retriever that returned nothing keeps its row of zeros."""
    qs = td.queries(spark, sf_dir)
    res = Bm25Index.build(td.corpus(spark, sf_dir)).search(qs, k=TOP_K)
    return compare({"BM25": res, "Silent": res.where("rank < 0")}, td.qrels(spark, sf_dir), qs, k=TOP_K)


@register("comparison_table")
def comparison_table_q(spark, sf_dir):
    return comparison_table(_comparison(spark, sf_dir), k=TOP_K)


# --------------------------------------------------------------------------- reports
@register("result_lines")
def result_lines_q(spark, sf_dir):
    out = _hybrid(spark, sf_dir, fusion="rrf").search(td.queries(spark, sf_dir), top_k=TOP_K)
    return result_lines(out, title_col=None).select("query_id", "retriever", F.col("rank").cast("long").alias("rank"),
                                                    "line")


@register("result_lines_titled")
def result_lines_titled(spark, sf_dir):
    """The language stands in for the title that the test documents lack."""
    out = _hybrid(spark, sf_dir, fusion="rrf").search(td.queries(spark, sf_dir), top_k=TOP_K, fields=True)
    return result_lines(out, title_col="lang").select("query_id", "retriever", F.col("rank").cast("long").alias("rank"), "line")


@register("explain_bars")
def explain_bars_q(spark, sf_dir):
    idx = _bm25(spark, sf_dir)
    bars = explain_bars(idx.explain_terms(_explain_pairs(spark, sf_dir, idx)))
    return bars.select("query_id", "doc_id", "term", r6("contribution").alias("contribution"), "bar",
                       F.col("position").cast("long").alias("position"))


@register("index_stats")
def index_stats_q(spark, sf_dir):
    c = td.corpus(spark, sf_dir)
    s = index_stats(Bm25Index.build(c), TfidfModel.fit(c))
    return s.select(F.col("n_docs").cast("long").alias("n_docs"), r6("avgdl").alias("avgdl"),
                    F.col("bm25_terms").cast("long").alias("bm25_terms"),
                    F.col("bm25_postings").cast("long").alias("bm25_postings"),
                    F.col("tfidf_features").cast("long").alias("tfidf_features"))


# --------------------------------------------------------------------------- LSA
# A randomised SVD has no SQL statement, but its invariants have: dimensions,
# unit norms, orthonormal components, embeddings equal to X V, list shapes.
_LSA: dict[tuple[str, str], LsaModel] = {}


def _lsa(spark, sf_dir) -> LsaModel:
    """Reference defaults (128 components, 5 power iterations, 10
    oversamples); one fit per application and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LSA:
        _LSA[key] = LsaModel.fit(td.corpus(spark, sf_dir))
    return _LSA[key]


def _norms(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.size("embedding").cast("long").alias("dims"), r6(l2_norm(F.col("embedding"))).alias("norm"))


@register("lsa_embeddings")
def lsa_embeddings(spark, sf_dir):
    return _norms(_lsa(spark, sf_dir).embeddings(), "doc_id")


@register("lsa_encode_query")
def lsa_encode_query(spark, sf_dir):
    return _norms(_lsa(spark, sf_dir).encode(td.queries(spark, sf_dir)), "query_id")


def _list_shape(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.min("rank").cast("long").alias("first_rank"),
                                 F.max("rank").cast("long").alias("last_rank"),
                                 F.countDistinct("doc_id").alias("n_docs"))


@register("lsa_search")
def lsa_search(spark, sf_dir):
    return _list_shape(_lsa(spark, sf_dir).search(td.queries(spark, sf_dir), k=TOP_K), "query_id")


@register("lsa_variance")
def lsa_variance(spark, sf_dir):
    v = _lsa(spark, sf_dir).variance_frame()
    inside = (F.col("variance_explained") > 0) & (F.col("variance_explained") <= 1)
    share = F.col("embedding_variance") / F.col("total_variance")
    return v.select("n_components", inside.alias("is_share"), r6("total_variance").alias("total_variance"),
                    (F.abs(share - F.col("variance_explained")) < 1e-9).alias("is_ratio"))


@register("lsa_components")
def lsa_components(spark, sf_dir):
    """Largest deviation of V^T V from the identity, and of the embeddings from X V."""
    m = _lsa(spark, sf_dir)
    xv, vtv = m.projected()
    off = float(abs(vtv - np.eye(m.n_components)).max())
    gap = F.array_max(F.zip_with("xv", "embedding", lambda a, b: F.abs(a - b)))
    both = xv.join(m.doc_embeddings, "doc_id", "full_outer").select(F.coalesce(gap, F.lit(1.0)).alias("gap"))
    return both.agg(F.round(F.max("gap"), 6).alias("max_gap"), F.round(F.lit(off), 6).alias("max_off"))


@register("hybrid_lsa")
def hybrid_lsa(spark, sf_dir):
    c = td.corpus(spark, sf_dir)
    h = HybridIndex(Bm25Index.build(c), _lsa(spark, sf_dir), fusion="rrf")
    return _list_shape(h.search(td.queries(spark, sf_dir), top_k=TOP_K), "query_id", "retriever")


@register("lsa_index_stats")
def lsa_index_stats(spark, sf_dir):
    m = _lsa(spark, sf_dir)
    s = index_stats(Bm25Index.build(td.corpus(spark, sf_dir)), m.tfidf, m)
    return s.select(F.col("n_docs").cast("long").alias("n_docs"), F.col("embedding_rows").cast("long").alias("embedding_rows"),
                    F.col("embedding_dims").cast("long").alias("embedding_dims"),
                    ((F.col("variance_explained") > 0) & (F.col("variance_explained") <= 1)).alias("is_share"))
