"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.session import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node of its component.

    Large stars hang a node's larger neighbours under its smallest one, small
    stars the smaller ones, until every node hangs under its root. Rounds grow
    with the logarithm of the path lengths. Edges are written after every
    round, so the lineage stays short and nothing passes through the driver.
    Links of a node with itself and repeated links change nothing; an empty
    table has no nodes.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent"))
        .where("child != parent").distinct(), "edges",
    )
    while not _settled(edges):
        edges = stage(_small_star(stage(_large_star(edges), "edges")), "edges")
    roots = edges.select(F.col("parent").alias("node")).distinct()
    return edges.select(F.col("child").alias("node"), F.col("parent").alias("root")).union(
        roots.select("node", F.col("node").alias("root")))


def _settled(edges: DataFrame) -> bool:
    twice = edges.groupBy("child").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chained = edges.join(edges.select(F.col("child").alias("parent")), "parent", "left_semi")
    return twice.isEmpty() and chained.isEmpty()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("child").alias("u"), F.col("parent").alias("v")).union(
        edges.select(F.col("parent").alias("u"), F.col("child").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("child"), F.col("low").alias("parent")).where("child != parent").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("child").agg(F.min("parent").alias("low"))
    hung = edges.join(least, "child")
    return (hung.select(F.col("parent").alias("child"), F.col("low").alias("parent"))
            .union(hung.select("child", F.col("low").alias("parent"))).where("child != parent").distinct())
