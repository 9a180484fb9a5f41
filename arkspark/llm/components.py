"""Connected components over link tables, kept distributed throughout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arkspark.llm.common import Scratch


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): the smallest node reachable by links (a, b), for every node that has a link.

    Alternating large-star and small-star rewiring: each round connects every node with the least of its
    neighbours, first those above it, then those below it, until all edges run from a node to the least of its
    component. Minima are taken by partial aggregation, so a hub with very many links isn't gathered in one task.
    Null ends and loops are ignored; no links give no rows.
    """
    edges = scratch.write(links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(below, "u")
        old, edges = edges, scratch.write(small.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(below.select("u", F.col("m").alias("v"))).distinct(), "edges")
        scratch.drop(old)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
