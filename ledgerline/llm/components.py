"""Connected components of an edge table, by alternating large-star and small-star steps.

Every step is one join or aggregation over the edges; no component is ever gathered in one
task. Each round's edges are written to the shared folder, so a lost executor costs at
most one round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import written


def large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    out = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return out.where("a != b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    linked = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(least.select("a", F.col("m").alias("b"))).where("a != b").distinct()


def state(edges: DataFrame) -> tuple:
    """Equal for equal edge tables."""
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"))
    return tuple(row.first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the least node of its
    component, itself included. Loops and repeated edges are allowed; no edges give no rows."""
    now = written(edges.where("a != b").select("a", "b").distinct(), "components")
    seen = state(now)
    while True:
        now = written(small_star(large_star(now)), "components")
        after = state(now)
        if after == seen:
            break
        seen = after
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
