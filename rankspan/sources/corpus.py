"""Adapters from user tables to the engine's column conventions.

Corpus:  ``doc_id, pos, title, text`` + passthrough columns.  ``pos`` replaces
         list order: ties in rankings resolve on it.
Queries: ``query_id, query``.
Qrels:   ``query_id, doc_id`` (distinct).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CORPUS_COLUMNS = ("doc_id", "pos", "title", "text")


def as_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", title_col: str | None = None,
              order_col: str | None = None) -> DataFrame:
    """Rename/derive the standard corpus columns, keep every other column."""
    order_col = order_col or id_col
    title = F.col(title_col).cast("string") if title_col else F.lit(None).cast("string")
    std = [F.col(id_col).alias("doc_id"), F.col(order_col).alias("pos"), title.alias("title"),
           F.col(text_col).alias("text")]
    used = {id_col, text_col, order_col} | ({title_col} if title_col else set())
    rest = [F.col(c) for c in df.columns if c not in used and c not in CORPUS_COLUMNS]
    return df.select(*std, *rest)


def as_queries(df: DataFrame, id_col: str = "query_id", text_col: str = "query") -> DataFrame:
    return df.select(F.col(id_col).alias("query_id"), F.col(text_col).alias("query"))


def as_qrels(df: DataFrame, query_col: str = "query_id", doc_col: str = "doc_id") -> DataFrame:
    """Long-form judgments.  An array column of ids is exploded."""
    dtype = dict(df.dtypes)[doc_col]
    docs = F.explode(F.col(doc_col)) if dtype.startswith("array") else F.col(doc_col)
    return df.select(F.col(query_col).alias("query_id"), docs.alias("doc_id")).dropDuplicates()
