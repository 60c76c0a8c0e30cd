"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoloom.session import settle


def _stars_marked(edges: DataFrame) -> DataFrame:
    """The edges with ``open``: false where the edge's group is a star, which is done."""
    members = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    centres = edges.select(F.col("v").alias("u"), F.lit(True).alias("centre")).distinct()
    loose = members.join(centres, "u", "left").where("n > 1 OR centre").select("u")
    # A centre is done unless it is loose itself or is tied to a loose node.
    unsure = edges.join(loose, "u", "left_semi").select("v").unionByName(loose.select(F.col("u").alias("v"))).distinct()
    return edges.join(unsure.withColumn("open", F.lit(True)), "v", "left").select("u", "v", F.coalesce("open", F.lit(False)).alias("open"))


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): every node of the links with the smallest node it is connected to.

    Alternating star contraction. Edges are kept as (larger ``u``, smaller ``v``). A large-star step
    ties the larger neighbours of every node to the smallest node around it, a small-star step does
    so with the smaller neighbours. Neither makes more edges than there were, groups are only ever
    reduced to a minimum, and rounds are about the logarithm of the longest chain. A round is
    settled, so lineage stays short. The end is exact: every node is a centre, or tied to one alone.
    Groups that have come to that leave the rounds, so a round costs what the groups still open hold.
    Nodes may be of any type with an order; links with a null end or from a node to itself are no
    links, repeated ones count once.
    """
    u, v = F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")
    edges = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y").select(u, v)
    marked = settle(_stars_marked(settle(edges.distinct())))
    stars = marked.where("NOT open")
    while not (edges := marked.where("open").select("u", "v")).isEmpty():
        around = edges.select(F.col("u").alias("n"), F.col("v").alias("m")).unionByName(edges.select(F.col("v").alias("n"), F.col("u").alias("m")))
        least = around.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("c"))
        large = settle(around.where("m > n").join(least, "n").select(F.col("m").alias("u"), F.col("c").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("c"))
        tied = large.join(least, "u").select(F.col("v").alias("u"), F.col("c").alias("v")).where("u <> v")
        edges = settle(tied.unionByName(least.select("u", F.col("c").alias("v"))).distinct())
        marked = settle(_stars_marked(edges))
        stars = stars.unionByName(marked.where("NOT open"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
