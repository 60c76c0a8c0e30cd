"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genoloom.llm.common import settle


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node's larger neighbours are tied to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b").where("a != b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them."""
    least = settle(edges.groupBy("b").agg(F.min("a").alias("m")))
    ties = edges.join(least, "b").select(F.col("a").alias("b"), F.col("m").alias("a")).where("a != b")
    return ties.unionByName(least.select("b", F.col("m").alias("a"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, label (its component's smallest node) for every node of ``links`` (a, b).

    Edges are kept as (smaller, larger). Both steps are groupings and joins whose rows never exceed
    the edges; they are settled at each round, and rounds end when the edges stay the same, which
    takes about the logarithm of the longest chain. Stars are what remains.
    """
    edges = settle(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    seen = None
    while True:
        edges = settle(_small_star(_large_star(edges)).select("a", "b"))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct())
