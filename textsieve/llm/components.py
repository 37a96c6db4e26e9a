"""Connected components of a link table, as alternating star contractions.

Each round is two joins of the links with the per-node minimum (large star,
then small star).  Links and minima are written tables, so both join sides are
plain exchanges that AQE can split when a node (the root of a large group)
holds many links; minima are aggregated before they are shuffled.  Nothing is
collected; the driver only reads one count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


def _minimum(links: DataFrame, node: str, other: str) -> DataFrame:
    return links.groupBy(F.col(node).alias("n")).agg(F.min(other).alias("m"))


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 50) -> DataFrame:
    """(node, root) for every node that occurs in a link; root = smallest node reachable.

    ``links`` holds undirected pairs of longs in columns ``a`` and ``b``; null
    and self links are ignored, repeated links are harmless, an empty table
    gives an empty result.
    """
    spark = links.sparkSession
    scratch = Scratch(spark)
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v")
    edges = scratch.put("links0", pairs.distinct())  # u > v
    for i in range(max_rounds):
        # large star: every larger neighbour of a node points to the node's smallest neighbour
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = scratch.put(f"low{i}", _minimum(both, "u", "v").select("n", F.least("n", "m").alias("m")))
        star = edges.join(low, edges["v"] == low["n"]).select("u", F.col("m").alias("v"))
        large = scratch.put(f"large{i}", star.filter("u <> v").distinct())
        # small star: all smaller neighbours of a node, and the node, point to the smallest of them
        least = scratch.put(f"least{i}", _minimum(large, "u", "v"))
        nxt = (large.join(least, large["u"] == least["n"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
               .unionByName(least.select(F.col("n").alias("u"), F.col("m").alias("v"))))
        new = scratch.put(f"links{i + 1}", nxt.filter("u <> v").distinct())
        # done when every node has one target and no target points further (a forest of stars)
        targets = new.select(F.col("v").alias("u")).distinct()
        heads = new.groupBy("u").agg(F.count("*").alias("c"))
        open_nodes = heads.filter("c > 1").select("u").unionByName(heads.join(targets, "u", "left_semi").select("u"))
        done = open_nodes.limit(1).count() == 0
        scratch.drop(f"links{i}", f"low{i}", f"large{i}", f"least{i}")
        edges = new
        if done:
            break
    else:
        raise RuntimeError("connected components did not settle")
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
