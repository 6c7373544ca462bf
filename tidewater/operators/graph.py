"""Graph operators over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.storage import checkpointed


def bounded_bfs(edges: DataFrame, roots: DataFrame, depth: int = 3) -> DataFrame:
    """(root, node, depth) for every node within `depth` steps of a root, by the least number of steps.

    edges is (src, dst), roots is (root).  Each level is one join of the frontier with the edges; nodes that are known are dropped before
    the next level, so cycles end.  Every level is written to the shared folder, so none is computed twice.
    """
    edges = checkpointed(edges.select("src", "dst").distinct())
    seen = roots.select("root", F.col("root").alias("node"), F.lit(0).alias("depth"))
    frontier = seen
    for level in range(1, depth + 1):
        met = frontier.join(edges, F.col("node") == F.col("src")).select("root", F.col("dst").alias("node")).distinct()
        frontier = checkpointed(met.join(seen.select("root", "node"), ["root", "node"], "left_anti").withColumn("depth", F.lit(level)))
        seen = seen.unionByName(frontier)
    return seen


def budgeted(found: DataFrame, pages: int) -> DataFrame:
    """The first `pages` nodes of each root in the order of (depth, node)."""
    w = Window.partitionBy("root").orderBy("depth", "node")
    return found.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= pages).drop("_rk")


def branching(edges: DataFrame) -> DataFrame:
    """One row: nodes with an edge out, edges, mean and largest out-degree."""
    out = edges.groupBy("src").agg(F.countDistinct("dst").alias("n"))
    return out.agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("edges"), F.round(F.avg("n"), 4).alias("mean_out"), F.max("n").alias("max_out"))
