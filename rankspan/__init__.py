"""rankspan: hybrid retrieval (BM25, TF-IDF / LSA / dense vectors, rank
fusion) and retrieval evaluation as Spark DataFrame jobs."""

from .operators.bm25 import Bm25Index, query_terms
from .operators.dense import dense_knn
from .operators.evaluation import compare, evaluate, per_query
from .operators.fusion import linear_fusion, reciprocal_rank_fusion
from .operators.hybrid import BatchEncoder, HybridIndex
from .operators.lsa import LsaModel
from .operators.segments import SegmentIndex
from .operators.tfidf import TfidfModel
from .sources.corpus import as_corpus, as_qrels, as_queries

__all__ = ["BatchEncoder", "Bm25Index", "HybridIndex", "LsaModel", "SegmentIndex", "TfidfModel", "as_corpus", "as_qrels", "as_queries", "compare",
           "dense_knn", "evaluate", "linear_fusion", "per_query", "query_terms", "reciprocal_rank_fusion"]
