"""Connected components of a graph given as an edge table.

Alternating large-star and small-star rounds over edges from a node to a smaller one.
Each round is two joins on node ids, written to the shared folder; a hub's edges are
folded by ``min`` before they are shuffled, and AQE splits what still is skewed.  Nothing
but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import written


def _lowest(edges: DataFrame) -> DataFrame:
    """The smallest parent of each node that has one."""
    return written(
        edges.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("low")), "component-parents"
    )


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("child", "parent").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b`` longs); the root is the smallest node."""
    edges = written(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
        .distinct(),
        "component-edges",
    )
    before = None
    while (now := _state(edges)) != before:
        before = now
        low = _lowest(edges)
        # Large star: children move to the smallest parent of their parent.
        edges = written(
            edges.join(low, edges["parent"] == low["node"], "left")
            .select("child", F.coalesce("low", "parent").alias("parent"))
            .distinct(),
            "component-edges",
        )
        low = _lowest(edges)
        # Small star: the parents of a node, and the node, move to the smallest of them.
        edges = written(
            edges.join(low, edges["child"] == low["node"])
            .select(F.when(F.col("parent") == F.col("low"), F.col("child")).otherwise(F.col("parent")).alias("child"), F.col("low").alias("parent"))
            .union(low.select("node", "low"))
            .distinct(),
            "component-edges",
        )
    roots = edges.groupBy(F.col("child").alias("node")).agg(F.min("parent").alias("root"))
    return written(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "component-roots")
