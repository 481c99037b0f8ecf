"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step. The smallest neighbour comes from an aggregate and is joined back, so a node
    with a third of all edges is pre-aggregated first and its join can be split."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.where("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    near = both.where("b > a") if large else both
    moved = near.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the (a, b) long edges; the component is its smallest node.

    Edges may repeat, run either way or be loops; null ends are left out. Every round is
    written to the shared folder, so a lost executor costs one round. Only counts reach the driver.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a is not null and b is not null and a <> b").distinct()
    n = None
    for _ in range(rounds):
        new = materialize(_star(_star(edges, True), False), "components")
        n_new = new.count()
        # Both tables hold distinct edges: equal counts and nothing new mean equal tables.
        done = not n_new or (n_new == n and new.join(edges, ["a", "b"], "left_anti").isEmpty())
        edges, n = new, n_new
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
