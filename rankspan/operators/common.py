"""Shared plan fragments: staging, per-group top-k, padding, lookups."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def need_index(built: object, call: str) -> None:
    """The reference's guard: nothing is searched or explained before it is indexed."""
    if built is None:
        raise RuntimeError(f"build the index before .{call}()")


def score_key(score: Column | str, digits: int = 9) -> Column:
    """Ranking key: the score rounded so summation-order noise cannot break
    exact ties; ``+ 0.0`` folds -0.0 into 0.0."""
    s = F.col(score) if isinstance(score, str) else score
    return F.round(s, digits) + F.lit(0.0)


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """``df`` over at least one partition per core.  A table of many splits is left
    where it is (no exchange), one of fewer splits than cores is dealt out, by ``key``
    if given.  With a ``key`` the rows of the splits are counted (of a scan, from the
    footers), and a table is also dealt out if half the cores would idle: a Parquet row
    group is read by the split of its middle, the other splits stay empty."""
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if splits >= cores:
        if key is None:
            return df
        held = df.select(F.spark_partition_id().alias("split")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))
        row = held.agg(F.sum("n").alias("all"), F.max("n").alias("most")).first()
        if not row["all"] or row["most"] * cores <= 2 * row["all"]:
            return df
    return df.repartition(max(cores, splits), *([key] if key else []))


@contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """While it lasts, a query's shuffle files are given up when it ends: nothing reads
    them again once a table is written."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` to Parquet (below ``spark.checkpoint.dir`` by default) and
    read it back.  The lineage is cut, and Catalyst knows the true size of what
    it joins next, so broadcasts follow from ``autoBroadcastJoinThreshold``."""
    path = path or scratch_path(df.sparkSession, name)
    with without_shuffle_files(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def document_buckets(df: DataFrame) -> int:
    """A bucket for each partition of ``df`` (at least one per core), so that a
    bucket does not grow with the table; the session's limit on buckets holds."""
    spark = df.sparkSession
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    return max(spark.sparkContext.defaultParallelism, min(df.rdd.getNumPartitions(), most))


def stage_by_document(df: DataFrame, name: str, path: str | None = None, buckets: int | None = None) -> DataFrame:
    """``stage`` as a table bucketed by ``doc_id``: aggregates and joins keyed on
    the document (alone or with more columns) then need no exchange.  Given
    ``buckets``, ``df`` is hash-partitioned into so many by ``doc_id`` already."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    if buckets is None:
        buckets = document_buckets(df)
        df = df.repartition(buckets, "doc_id")
    table = f"rankspan_{name}_{uuid.uuid4().hex[:12]}".replace("-", "_")
    with without_shuffle_files(spark):
        (df.write.bucketBy(buckets, "doc_id").option("path", path).option("compression", "zstd").format("parquet")
         .mode("overwrite").saveAsTable(table))
    return spark.table(table)


def exact_sum(col: Column | str) -> Column:
    """Sum of doubles through DECIMAL(38,18): exact to 1e-18 and independent
    of summation order, so results do not move with the partitioning."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c.cast("decimal(38,18)")).cast("double")


def exact_mean(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return exact_sum(c) / F.count(c)


def top_k(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column], k: int,
          rank_col: str = "rank") -> DataFrame:
    """``row_number() <= k`` per group.  Catalyst plans it as a partial
    WindowGroupLimit before the exchange, so at most k rows per group and map
    partition are shuffled."""
    if k < 0:
        raise ValueError("k must be >= 0")
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= F.lit(k))


def lookup(keys: DataFrame, table: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of a big ``table`` whose key is among ``keys``: a left-semi join."""
    return table.join(keys.select(*on).dropDuplicates(), list(on), "left_semi")


def first_docs(docs: DataFrame, depth: int, descending: bool = False) -> Column:
    """Array<struct<pos, doc_id>> of the first ``depth`` documents in corpus
    order (last ones if ``descending``), as a scalar subquery: bounded by
    ``depth`` rows, evaluated once per query plan."""
    order = F.col("pos").desc() if descending else F.col("pos").asc()
    first = docs.select("pos", "doc_id").orderBy(order).limit(depth)
    return first.agg(F.collect_list(F.struct("pos", "doc_id"))).scalar()


def rank_padded(queries: DataFrame, scored: DataFrame, docs: DataFrame, k: int, score_col: str,
                pos_desc: bool = False, depth: int | None = None, keep_all_nonzero: bool = False) -> DataFrame:
    """Top-k per query over *all* documents, where documents missing from
    ``scored`` (query_id, doc_id, pos, <score_col>) score 0.

    Order: score desc (rounded key), then pos asc (or desc).  The zero-score
    documents that can reach the top k are among the first ``depth`` (default
    k) documents in pos order, so they come from a bounded candidate array
    exploded per query -- never a queries x corpus product.  With
    ``keep_all_nonzero`` every scored candidate keeps its score even outside
    the top-k (needed when negative scores exist)."""
    if k < 0:
        raise ValueError("top_k must be >= 0")
    pos_order = F.col("pos").desc() if pos_desc else F.col("pos").asc()
    order = [F.col("_sk").desc(), pos_order]
    nonzero = scored.withColumn("_sk", score_key(score_col)).where(F.col("_sk") != 0)
    cols = ["query_id", "doc_id", "pos", score_col]
    best = top_k(nonzero, ["query_id"], order, k, "_r").select(*cols)
    cand = (queries.select("query_id", F.explode(first_docs(docs, depth or k, pos_desc)).alias("c"))
            .select("query_id", F.col("c.doc_id").alias("doc_id"), F.col("c.pos").alias("pos"),
                    F.lit(0.0).alias(score_col), F.lit(0).alias("_scored")))
    if keep_all_nonzero:
        best = best.unionByName(lookup(cand, nonzero, ["doc_id"]).select(*cols))
    both = best.withColumn("_scored", F.lit(1)).unionByName(cand)
    merged = (both.groupBy("query_id", "doc_id", "pos")
              .agg(F.max_by(score_col, "_scored").alias(score_col))
              .withColumn("_sk", score_key(score_col)))
    ranked = top_k(merged, ["query_id"], order, k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "doc_id", "pos", score_col)


def attach_fields(results: DataFrame, corpus: DataFrame, queries: DataFrame | None = None) -> DataFrame:
    """Result rows with the corpus columns of their document (those that the
    rows do not have yet) and, given ``queries``, the query text.  The rows are
    staged (at most queries x k), so the corpus is streamed against them."""
    rows = stage(results, "results")
    fields = [c for c in corpus.columns if c not in rows.columns]
    out = corpus.select("doc_id", *fields).join(rows, "doc_id").select(*rows.columns, *fields)
    if queries is not None:
        out = out.join(queries.select("query_id", "query"), "query_id").select("query_id", "query", *out.columns[1:])
    return out
