"""Connected components of a table of links, as joins and sums of minima.

Every node keeps a parent, at first itself. A round gives each node, and its
parent, the least grandparent among its neighbours, and shortens its own path;
labels settle in about log(diameter) rounds. State is cut off from its lineage
by tables written in the shared folder; as the joins read those, Spark can
split the partition of a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """(node, component) of all nodes of ``links`` (a, b); component is its least node."""
    keep = (scratch or Scratch(links.sparkSession, "components")).keep
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = keep(both.where("a <> b").distinct())
    state = keep(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("up")))
    while True:
        top = state.select(F.col("node").alias("up"), F.col("up").alias("upper"))
        far = state.join(top, "up").select("node", "up", "upper")
        near = (edges.join(far.select(F.col("node").alias("b"), "upper"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("upper").alias("near")))
        step = keep(far.join(near, "node"))
        if step.where("near < upper or upper < up").isEmpty():
            return step.select("node", F.col("up").alias("component"))
        low = F.least("near", "upper").alias("up")
        state = keep(step.select("node", low).unionAll(step.select(F.col("up").alias("node"), F.col("near").alias("up")))
                     .groupBy("node").agg(F.min("up").alias("up")))
