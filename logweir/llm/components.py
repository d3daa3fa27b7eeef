"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logweir.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); component is the smallest node reachable.

    Each round gives every node its smallest smaller neighbour as parent and passes its other smaller
    neighbours on to that parent.  When each node has one parent left, the trees are flattened by
    jumping to the parent's parent.  All steps are aggregations with map-side combination and joins;
    edges and labels stay distributed, the driver only sees counts.  Empty links give no rows.
    """
    oriented = F.col("a") != F.col("b")
    edges = cut(links.filter(oriented).select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("up")).distinct())
    n_edges, n_nodes = edges.count(), edges.select("node").distinct().count()
    while n_edges > n_nodes:
        parent = edges.groupBy("node").agg(F.min("up").alias("top"))
        moved = (edges.join(parent, "node")
                 .select(F.explode(F.array(F.struct("node", F.col("top").alias("up")),
                                           F.struct(F.col("up").alias("node"), F.col("top").alias("up")))).alias("e"))
                 .select("e.node", "e.up").filter("node <> up").distinct())
        edges = cut(moved)
        n_edges, n_nodes = edges.count(), edges.select("node").distinct().count()
    while True:
        above = edges.select(F.col("node").alias("up"), F.col("up").alias("higher"))
        jumped = cut(edges.join(above, "up", "left")
                     .select("node", F.coalesce("higher", "up").alias("up"), F.col("higher").isNotNull().alias("changed")))
        edges = jumped.select("node", "up")
        if jumped.filter("changed").isEmpty():
            break
    roots = edges.select(F.col("up").alias("node"), F.col("up").alias("component")).distinct()
    return edges.select("node", F.col("up").alias("component")).unionByName(roots)
