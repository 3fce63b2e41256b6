"""Connected components of a table of links, by rounds of joins; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.base import Scratch


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root: every node that has a link to another, with the smallest node it can reach.

    Large-star and small-star rounds: each node tells its larger neighbours of the smallest one it knows, then
    its smaller neighbours. Rounds grow with the logarithm of the component size, not with its diameter. The
    smallest neighbour is a partial minimum per task, and the join that hands it out has one row per node on
    one side, so a node with a third of all links is split by the skew join. Each round is written.
    """
    scratch = Scratch(links.sparkSession, "components")
    low, high = F.least(a, b), F.greatest(a, b)
    edges = scratch.cut(links.filter(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct())
    seen = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = scratch.cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Every node keeps its own smallest neighbour, too: components stay connected.
        kept = least.filter(F.col("m") < F.col("u")).select("u", F.col("m").alias("v"))
        star = scratch.cut(large.union(kept).filter(F.col("u") != F.col("v")).distinct())
        scratch.drop(least)
        least = scratch.cut(star.groupBy("u").agg(F.min("v").alias("m")))
        small = star.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        new = scratch.cut(small.union(least.select("u", F.col("m").alias("v"))).filter(F.col("u") != F.col("v")).distinct())
        scratch.drop(least, star, edges)
        edges = new
        # All stars: no node points to one that points on.
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state


def with_roots(found: DataFrame) -> DataFrame:
    """The same, with a row for each root itself."""
    return found.union(found.select("root", "root").distinct())
