"""Connected components of links between nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for all nodes of ``links`` (columns a, b).

    Each round a node takes the smallest root among its neighbours and then that root's own root, so
    distances halve. Every round is written, as are the links; rounds end when nothing changes. Rows of one node
    combine before they are shuffled, and joins split hot nodes (adaptive execution).
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.filter("a <> b").distinct(), "component-links")
    roots = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    roots = written(roots.select("node", F.least("node", "near").alias("root")), "component-roots")
    while True:
        of_near = both.join(roots.withColumnRenamed("node", "b"), "b")
        near = of_near.groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        step = written(step, "component-step")
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        roots = step.join(jump, "root", "left").select("node", "old", F.least("root", "next").alias("root"))
        roots = written(roots, "component-roots")
        if roots.filter("root <> old").isEmpty():
            return roots.select("node", "root")
        roots = roots.select("node", "root")
