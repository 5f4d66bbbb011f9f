"""Connected components of links between ids, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from canopy.session import cut_lineage


def large_star(links: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the node's smallest neighbour (itself included)."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where(F.col("v") > F.col("u")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def small_star(links: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them; links lead from larger to smaller."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return (links.join(least, "u").where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has a link: the smallest node reachable.

    Links are undirected; repeated links, self links and links with a null end are ignored. A round is two
    stars; the result of each is checkpointed, and the rounds end when a round changes no link. Hot nodes
    are aggregated before the shuffle, and their links are joined, not gathered.
    """
    ends = links.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x is not null and y is not null and x <> y")
    stars = cut_lineage(ends.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    state = None
    while True:
        new = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state or new[0] == 0:
            break
        state = new
        stars = cut_lineage(small_star(large_star(stars)))
    roots = stars.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
