"""Connected components of a graph given as a table of links.

Every node starts with itself as label and takes the smallest label among its
neighbours, then the label of its label, until nothing changes: about log(n)
rounds, as each round's jump doubles the distance a label travels. A hub (a
node in a third of all links) meets only in partial aggregates and in joins
whose other side has one row per node, which adaptive execution splits. Each
round is written with ``checkpoint()`` to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstream.session import shared_root


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, label`` for every node of ``links``; ``label`` is the smallest node reachable."""
    shared_root(links.sparkSession)  # names the checkpoint folder
    ends = links.select(F.explode(F.array(F.struct(F.col(a).alias("node"), F.col(b).alias("near")),
                                          F.struct(F.col(b).alias("node"), F.col(a).alias("near")))).alias("e"))
    edges = ends.select("e.node", "e.near").where("node <> near").distinct().checkpoint()
    labels = edges.groupBy("node").agg(F.min("near").alias("low")).select("node", F.least("node", "low").alias("label")).checkpoint()
    while True:
        near = edges.join(labels.withColumnRenamed("node", "near"), "near").groupBy("node").agg(F.min("label").alias("low"))
        hooked = labels.join(near, "node").select("node", F.least("label", "low").alias("hook"), "label")
        jump = hooked.select(F.col("node").alias("hook"), F.col("hook").alias("far"))
        new = (hooked.join(jump, "hook")
               .select("node", F.least("hook", "far").alias("label"), (F.least("hook", "far") < F.col("label")).alias("moved"))
               .checkpoint())
        labels = new.select("node", "label")
        if new.where("moved").isEmpty():
            return labels
