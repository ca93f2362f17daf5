"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each linked node is connected to.

    Each round takes the smallest label among the neighbours and then the label
    of that label (pointer jumping), so the rounds grow with the logarithm of a
    component's diameter; labels are written under ``spark.checkpoint.dir``
    after each.  An empty table gives no rows."""
    both = links.select(F.col(a).alias("node"), F.col(b).alias("to")).where("node != to")
    edges = staged(both.unionByName(both.select(F.col("to").alias("node"), F.col("node").alias("to"))).distinct(), "edges")
    labels = staged(edges.groupBy("node").agg(F.min("to").alias("near")).select(
        "node", F.least("node", "near").alias("root")), "labels")
    for _ in range(most_rounds):
        label_of = labels.select(F.col("node").alias("to"), F.col("root").alias("seen"))
        near = edges.join(label_of, "to").groupBy("node").agg(F.min("seen").alias("seen"))
        lower = labels.join(near, "node").select("node", F.col("root").alias("was"), F.least("root", "seen").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("jumped"))
        new = staged(lower.join(jump, "low", "left").select(
            "node", "was", F.least("low", F.coalesce("jumped", "low")).alias("root")), "labels")
        labels = new.select("node", "root")
        if new.where("was != root").isEmpty():
            return labels
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
