"""Connected components of a large edge list by alternating large-star and small-star steps.

Every step is a grouped minimum (with map-side combining) joined back to the
edges; nothing but a row count and a checksum comes to the driver. A node with very
many neighbours is split by AQE's skew join, since the other side has one row per node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.staging import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v), u > v, each undirected edge held once."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m"))
    near = both.join(least, both["u"] == least["n"])
    if large:  # neighbours above the node go to the least of its neighbourhood
        out = near.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the node and its lower neighbours go to the least of them
        out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select(F.col("n").alias("u"), F.col("m").alias("v"))
        )
    return out.filter("u != v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the least node of its component.

    ``edges`` has long columns u and v in any order, repeats and self-links allowed.
    """
    now = staged(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u != v").distinct(), "edges"
    )
    seen = _state(now)
    while seen[0]:
        now = staged(_star(_star(now, large=True), large=False), "edges")
        state = _state(now)
        if state == seen:
            break
        seen = state
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
