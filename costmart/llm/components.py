"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costmart.session import stage_table


def _with_least(pairs: DataFrame) -> DataFrame:
    """Each pair (node, other) with the least of the node and its others; partial minima before the shuffle."""
    least = pairs.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select(F.col("node").alias("_node"), F.least("node", "least").alias("least"))
    return pairs.join(least, F.col("node") == F.col("_node")).drop("_node")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (node, other): root is the least node that it reaches.

    Kiveris et al., 2014. Each round replaces edges by edges to smaller nodes and stores them; a path
    shrinks geometrically, and a hub only ever meets one row per neighbour, which the skew join splits.
    """
    current = stage_table(
        edges.filter("node <> other").select(F.greatest("node", "other").alias("node"), F.least("node", "other").alias("other")).distinct(),
        "edges",
    )
    while True:
        both = current.unionByName(current.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _with_least(both).filter("other > node").select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()
        small = _with_least(large).select("other", "node", "least")
        parts = F.explode(F.array(F.struct(F.col("other").alias("node"), F.col("least").alias("other")), F.struct("node", F.col("least").alias("other"))))
        after = stage_table(small.select(parts.alias("e")).select("e.*").filter("node <> other").distinct(), "edges")
        # Done when every node has one parent and no parent has a parent: then each tree is a star.
        doubled = after.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
        chained = after.join(after.select(F.col("node").alias("other")), "other", "left_semi")
        current = after
        if not doubled.head(1) and not chained.head(1):
            break
    roots = current.select(F.col("other").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select("node", F.col("other").alias("root")).unionByName(roots)
