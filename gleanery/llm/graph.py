"""Connected components by alternating stars: no task ever gathers a node's neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import dropped, written


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the undirected edges (u, v); component is its smallest node.

    Each round is a large star and a small star: minima are combined before the shuffle and joined back, and the
    join splits skewed nodes. Self-loops and repeated edges do no harm; nodes without an edge to another are absent.
    """
    e = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = written(e, "edges")
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, e = e, written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        dropped(before)
        # settled when no node's parent has a parent itself and no node has two
        inner = e.join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi").select("u")
        if inner.unionByName(e.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")).limit(1).isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
