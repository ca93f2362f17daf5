"""Retrieval operators: BM25, TF-IDF, LSA, dense kNN, fusion, evaluation."""
