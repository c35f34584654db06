"""Connected components of a graph held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) for the nodes of ``edges`` (``a``, ``b`` long).

    Each round takes the smallest root among a node's neighbours, a combining
    minimum that a hub cannot overload, and then replaces each root by its own
    root, so that long chains halve.  Rounds are written to the shared folder.
    An empty graph gives an empty table.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = staged(both.where("a <> b").distinct(), "links")
    roots = staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "roots")
    while True:
        near = both.join(roots.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("root").alias("near"))
        lower = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("low"))
        far = roots.select(F.col("node").alias("low"), F.col("root").alias("far"))
        moved = lower.join(far, "low").select("node", "root", F.least("low", "far").alias("next"))
        moved = staged(moved, "roots")
        roots = moved.select("node", F.col("next").alias("root"))
        if moved.where("next <> root").isEmpty():
            return roots
