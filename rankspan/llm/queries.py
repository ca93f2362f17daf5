"""Registered queries of this package: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann, bpe, decontamination, divergence, extraction, licenses, neardup, periodic, pii, quality, substring, toxicity, urls,
)
from .common import table
from .oracle import ORACLE  # noqa: F401

VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.deduplicate(table(spark, sf_dir, "documents"), digests=True)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_main_text(table(spark, sf_dir, "pages"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.collapse_runs(table(spark, sf_dir, "documents"), digests=True, rewrite=True)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


# Fixed values of the contract: host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.filter_urls(table(spark, sf_dir, "pages"), rules)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest": op1_nearest,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_main_text": op4_main_text,
    "op5_toxicity": op5_toxicity,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_pii": op8_pii,
    "op9_license_scan": op9_license_scan,
    "op10_bpe": op10_bpe,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_source_divergence": op12_source_divergence,
    "op13_url_filter": op13_url_filter,
}
