"""Search a stream of queries against a static index.

Queries arrive through any Structured Streaming source as (query_id, query)
rows; each micro-batch is searched with the same batch operators (BM25, vector
or hybrid) and written to ``<path>/epoch=<id>`` with overwrite, so a replayed
epoch after a failure rewrites the same folder instead of duplicating rows.
Progress is tracked in the stream's checkpoint location.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def search_stream(queries: DataFrame, search: Callable[[DataFrame], DataFrame], path: str,
                  checkpoint_location: str, trigger: dict | None = None) -> StreamingQuery:
    """Start a streaming query; ``search`` maps a static batch of queries to
    results (e.g. ``lambda q: index.search(q, k=5)``)."""
    if not queries.isStreaming:
        raise ValueError("queries must be a streaming DataFrame (spark.readStream...)")
    if not checkpoint_location:
        raise ValueError("a stream needs a checkpoint location of its own: a restart continues from it")

    def run(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        out = search(batch.select("query_id", "query")).withColumn("epoch", F.lit(epoch_id))
        out.write.mode("overwrite").parquet(f"{path.rstrip('/')}/epoch={epoch_id}")

    writer = queries.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(**trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()
