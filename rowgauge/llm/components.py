"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import settle


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); root is the least node that it is connected with.

    Every node hooks to its least neighbour, and on to that one's; then edges
    lead from root to root, and those within a component go, so that a round
    has far fewer than the one before. Each round is written to the shared
    folder: a lost executor costs a round at most, and the driver sees only
    whether edges are left.
    """
    left = settle(_edges(edges), "edges")
    found = None
    while True:
        both = left.union(left.select("b", "a"))
        up = both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("up"))
        up = settle(up, "hooks")
        # what a node hooks to is a node itself, and so has a row
        top = settle(up.join(up.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", "top"), "tops")
        if found is None:
            found = top.withColumnRenamed("top", "root")
        else:
            above = top.withColumnRenamed("node", "root")
            found = found.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
            found = settle(found, "roots")
        ends = [top.select(F.col("node").alias(c), F.col("top").alias(f"top_{c}")) for c in ("a", "b")]
        moved = left.join(ends[0], "a").join(ends[1], "b").select(F.col("top_a").alias("a"), F.col("top_b").alias("b"))
        left = settle(_edges(moved), "edges")
        if left.isEmpty():
            return found


def _edges(pairs: DataFrame) -> DataFrame:
    """Each edge once, the lesser node first; none from a node to itself."""
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
