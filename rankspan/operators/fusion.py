"""Fusion of ranked lists: reciprocal rank fusion and min-max linear fusion.

Lists are DataFrames with (query_id, doc_id, rank, ...); ``rank`` is the
1-based position in the list.  Both operators work on at most
(#queries x fetch_k) rows per list: one small shuffle on (query_id, doc_id)
and one on query_id for the final ranking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import top_k

KEYS = ("query_id", "doc_id")


def reciprocal_rank_fusion(lists: Sequence[DataFrame], k: int = 60) -> DataFrame:
    """Sum of 1/(k + rank) over the lists a document appears in (twice in one
    list counts twice).  Order: unrounded sum desc, then first appearance
    (earlier list, then earlier position).  Every other column is taken from
    the first list containing the document.  Output: (query_id, rank, doc_id,
    rrf_score rounded to 6, <fields of the first list>)."""
    if not lists:
        raise ValueError("at least one ranked list is required")
    tagged = None
    for i, df in enumerate(lists):
        t = df.withColumn("_list", F.lit(i))
        tagged = t if tagged is None else tagged.unionByName(t, allowMissingColumns=True)
    fields = [c for c in tagged.columns if c not in (*KEYS, "rank", "_list")]
    first_key = F.struct(F.col("_list"), F.col("rank"))
    agg = [F.sum(F.lit(1.0) / (F.lit(float(k)) + F.col("rank"))).alias("_rrf"),
           F.min(first_key).alias("_first")]
    if fields:
        agg.append(F.min_by(F.struct(*fields), first_key).alias("_fields"))
    fused = tagged.groupBy(*KEYS).agg(*agg)
    # Sums of >2 reciprocals depend on addition order in the last bits.
    order = [F.round("_rrf", 12).desc(), F.col("_first._list").asc(), F.col("_first.rank").asc()]
    ranked = fused.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id",
                         F.round("_rrf", 6).alias("rrf_score"), *[F.col(f"_fields.{f}").alias(f) for f in fields])


def minmax_bounds(df: DataFrame, score_col: str, prefix: str) -> DataFrame:
    """(query_id, <prefix>_min, <prefix>_range) over one fetched list; a zero
    range becomes 1.0."""
    b = df.groupBy("query_id").agg(F.min(score_col).alias(f"{prefix}_min"), F.max(score_col).alias("_max"))
    return b.select("query_id", f"{prefix}_min", _range(F.col(f"{prefix}_min"), F.col("_max")).alias(f"{prefix}_range"))


def _range(least: Column, most: Column) -> Column:
    return F.when(most - least == 0, F.lit(1.0)).otherwise(most - least)


def linear_fusion(bm25: DataFrame, vector: DataFrame, alpha: float = 0.5, bm25_col: str = "bm25_score",
                  vector_col: str = "vector_score") -> DataFrame:
    """alpha * minmax(vector) + (1 - alpha) * minmax(bm25) over the union of
    both lists (full outer join).  Bounds come from each fetched list alone;
    a document missing from a list counts raw 0.0 there *before* normalising,
    so its normalised value is -min/range.  The score is rounded to 6 before
    sorting; ties keep BM25 list order, then vector-only documents in vector
    order.  Fields come from the vector list when present (the last list
    wins).  A query that one list lacks altogether is an error when it is evaluated
    (its scores cannot be normalised).  Output: (query_id, rank, doc_id, linear_score, fields...)."""
    bfields = [c for c in bm25.columns if c not in (*KEYS, "rank")]
    vfields = [c for c in vector.columns if c not in (*KEYS, "rank")]
    b = bm25.select(*KEYS, F.col("rank").alias("_brank"), *[F.col(c).alias(f"_b_{c}") for c in bfields])
    v = vector.select(*KEYS, F.col("rank").alias("_vrank"), *[F.col(c).alias(f"_v_{c}") for c in vfields])
    # the bounds of minmax_bounds, over the joined rows: a join with them would make the lists twice
    own = Window.partitionBy("query_id")
    bounds = {}
    for p, c in (("_bb", f"_b_{bm25_col}"), ("_vb", f"_v_{vector_col}")):
        least, most = F.min(c).over(own), F.max(c).over(own)
        bounds |= {f"{p}_min": least, f"{p}_range": _range(least, most)}
    joined = b.join(v, list(KEYS), "full_outer").withColumns(bounds)
    nb = (F.coalesce(F.col(f"_b_{bm25_col}"), F.lit(0.0)) - F.col("_bb_min")) / F.col("_bb_range")
    nv = (F.coalesce(F.col(f"_v_{vector_col}"), F.lit(0.0)) - F.col("_vb_min")) / F.col("_vb_range")
    a = float(alpha)
    # without a list there are no bounds to normalise by (the reference raises too)
    absent = F.raise_error(F.concat(F.lit("a ranked list is empty for query "), F.col("query_id").cast("string")))
    scored = joined.withColumn("linear_score", F.when(
        F.col("_bb_min").isNotNull() & F.col("_vb_min").isNotNull(),
        F.round(F.lit(a) * nv + F.lit(1.0 - a) * nb, 6)).otherwise(absent.cast("double")))
    in_v = F.col("_vrank").isNotNull()
    out_fields = []
    for c in dict.fromkeys(bfields + vfields):
        if c in vfields and c in bfields:
            out_fields.append(F.when(in_v, F.col(f"_v_{c}")).otherwise(F.col(f"_b_{c}")).alias(c))
        elif c in vfields:
            out_fields.append(F.when(in_v, F.col(f"_v_{c}")).alias(c))
        else:
            out_fields.append(F.when(~in_v, F.col(f"_b_{c}")).alias(c))
    order = [F.col("linear_score").desc(), F.col("_brank").asc_nulls_last(), F.col("_vrank").asc()]
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "linear_score", *out_fields)


def cut(df: DataFrame, k: int) -> DataFrame:
    """First k rows of each ranked list."""
    return df.where(F.col("rank") <= F.lit(k))


__all__ = ["reciprocal_rank_fusion", "linear_fusion", "minmax_bounds", "cut", "top_k"]
