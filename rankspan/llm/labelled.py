"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int,
                    longest: int | None = None) -> DataFrame:
    """(doc_id, text, y) of at most ``per_class`` documents of each class.

    ``learn`` selects the label rows that may be learned from.  The sample is a
    hash sample of the label rows; being bounded it is broadcast, so the
    documents are scanned once and their texts are not shuffled.  ``longest``
    leaves out longer texts (in bytes) from the sample only."""
    rows = (labels.where(learn & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")))
    count = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    bound = F.lit(0)
    for y, n in count.items():
        bound = F.when(F.col("y") == y, min(1_000_000, 1 + per_class * 1_000_000 // n)).otherwise(bound)
    drawn = rows.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < bound)
    drawn = drawn.dropDuplicates(["doc_id"]).limit(3 * per_class)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    if longest is not None:
        text = text.where(F.octet_length("text") <= longest)
    return text.join(F.broadcast(drawn), "doc_id")


def class_counts(labels: DataFrame, label: str, learn: Column) -> dict[int, int]:
    rows = labels.where(learn & F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("y"))
    return {r["y"]: r["n"] for r in rows.agg(F.count(F.lit(1)).alias("n")).collect()}
