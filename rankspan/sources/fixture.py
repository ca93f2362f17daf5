"""The six-document golden fixture (own text) used by the unit tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FIXTURE_DOCS = [
    ("m1", 1, "River ferry timetable", "The ferry leaves the north pier at nine, and the ferry returns at noon."),
    ("m2", 2, "Harbor ferry fares", "Ferry fares are low in the off-season; the harbor office sells passes."),
    ("m3", 3, None, "The bakery on the pier sells rye bread and the best coffee."),
    ("m4", 4, None, "The bakery on the pier sells rye bread and the best coffee."),
    ("m5", 5, "Night train", "The night train crosses the northern valley, then the long tunnel."),
    ("m6", 6, "Coffee notes", "Coffee beans from the valley: roasted, ground, and brewed at the bakery."),
]

FIXTURE_QUERIES = [
    ("q1", "ferry ferry pier"),
    ("q2", "bakery coffee"),
    ("q3", "the valley"),
    ("q4", "zeppelin"),
    ("q5", "harbor passes"),
]

FIXTURE_QRELS = [("q1", "m1"), ("q1", "m2"), ("q2", "m6"), ("q3", "m5"), ("q3", "m6"), ("q4", "m1")]


def fixture_corpus(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXTURE_DOCS, "doc_id string, pos long, title string, text string")


def fixture_queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXTURE_QUERIES, "query_id string, query string")


def fixture_qrels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(FIXTURE_QRELS, "query_id string, doc_id string")
