"""Shared by the operators of this package: tables, staging and task code."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ..session import checkpoint_dir, ship_package

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: the lineage
    is cut, and a lost executor costs no more than its own tasks.  The shuffle
    files of the write are given up when it ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def in_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
               schema: str) -> DataFrame:
    """``mapInArrow`` with this package importable on the workers, which give
    Arrow's free memory back when a task ends: they live on beside later stages."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)


def widened(df: DataFrame, name: str, kind: str) -> StructType:
    """Schema of ``df`` with one more column."""
    return StructType([*df.schema.fields, StructField(name, _parse_datatype_string(kind))])


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so
    (column names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_groups(df: DataFrame, key: str, work, schema: str) -> DataFrame:
    ship_package(df.sparkSession)
    return df.groupBy(key).applyInArrow(work, schema)


def crc_of_id(doc_id: Column | str) -> Column:
    """crc32 of an id as text, the key by which labels are split."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary"))
