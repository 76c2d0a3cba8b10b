"""Connected components of a table of links, by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.lineage import checkpointed


def _lowest(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of each node and its neighbours."""
    return edges.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of links (u, v): the smallest node that each can reach.

    Two steps take turns: larger neighbours of a node are hung on its smallest one, then the smaller ones with itself.
    The rounds grow with the logarithm of the longest way, not with the way; nothing but counts reaches the driver.
    """
    edges = checkpointed(links.select("u", "v").where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        met = down.join(_lowest(down), "u")
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(met.select("u", F.col("m").alias("v")))
        edges = checkpointed(small.distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    nodes = links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node"))).distinct()
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").withColumn("component", F.coalesce("component", "node"))
