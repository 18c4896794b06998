"""Connected components by alternating large and small stars."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import materialized


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """(u, v) with u > v. Large: each node hands its larger neighbours the smallest id it
    knows. Small: the same among a node's smaller neighbours and the node itself."""
    if large:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        around = edges
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    known = around.join(least, "u")
    if large:
        moved = known.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = known.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return moved.filter("u > v").distinct()


def smallest_reachable(pairs: DataFrame) -> DataFrame:
    """(id, component): for every id in pairs (a, b) but the smallest of a component, the smallest.

    Each round is written to the shared folder; a hot node's rows are joined, never gathered.
    Self loops and repeated pairs change nothing; without pairs the result is empty.
    """
    edges = materialized(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u > v").distinct(),
        "edges",
    )
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        state = now
        edges = materialized(_stars(_stars(edges, True), False), "edges")
