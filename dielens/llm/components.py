"""Connected components by alternating large-star and small-star steps (public algorithm)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dielens.plans.hold import hold


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); component: its smallest node.

    A step takes each node's smallest neighbour by a combined aggregate and joins it back,
    so a node with very many links is neither collected nor a single task's. The links are
    written to the shared folder after each round; rounds grow with the logarithm of the
    longest chain. Links with a null end and links of a node to itself are ignored.
    """
    links = hold(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours move to the smallest one of the closed neighbourhood
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # small star: smaller neighbours, and the node itself, move to the smallest of them
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        links = hold(small.union(down.select("u", F.col("m").alias("v"))).distinct())
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
