"""Connected components of a table of links, without collecting nodes or links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from loglake.session import written


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` as rows of node and component, the least node that can be reached.

    Every round takes the least label among the neighbours and then that label's own label, and is
    one job; the number of rounds grows with the logarithm of a chain's length. A hub's labels meet in partial
    minima. Self-links only name their node.
    """
    ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(links.select(F.inline(ways)).distinct(), "links")
    if both.isEmpty():
        return both.toDF("node", "component")
    labels = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node")
    labels = written(labels, "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        above = labels.select(F.col("node").alias("up"), F.col("label").alias("up_label"))
        met = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        jumped = met.join(above, met["label"] == above["up"], "left").select(
            "node", "old", F.least("label", F.coalesce("up_label", "label")).alias("label")
        )
        changes = Observation()
        changed = F.count_if(F.col("old") != F.col("label")).alias("changed")
        labels = written(jumped.observe(changes, changed), "labels").select("node", "label")
        if not changes.get["changed"]:
            return labels.withColumnRenamed("label", "component")
