"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import staged

LINKS_PER_FILE = 200_000


def are_stars(edges: DataFrame) -> bool:
    """Whether every greater node of (a, b) hangs on one node, and that one on none."""
    inner = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
    double = edges.groupBy("a").agg(F.count("*").alias("n")).filter("n > 1")
    return inner.select("a").unionByName(double.select("a")).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): the least node it reaches.

    Each round hangs the greater neighbours of every node, then the lesser ones, onto the
    least of them, until only stars are left; the number of rounds grows with the logarithm
    of the longest path.  A node's neighbours are only ever counted and joined, never
    gathered; counts are written before they are joined, so that Spark can split a node of
    very many links.
    """
    order = lambda frame: frame.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = staged(order(links), "components")
    files = 1 + edges.count() // LINKS_PER_FILE
    keep = lambda frame: staged(frame.coalesce(files), "components")
    while not are_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: greater neighbours move to the least of the node's neighbourhood
        least = keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = keep(order(large))
        # small star: lesser neighbours, and the node itself, move to the least of them
        least = keep(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = keep(order(small.unionByName(least.select("a", F.col("m").alias("b")))))
    pairs = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = pairs.select(F.col("component").alias("node"), "component").distinct()
    return pairs.unionByName(roots)


def merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (node, component) after further links (a, b), which merge components."""
    links = staged(links, "components-links")
    nodes = links.select(F.col("a").alias("node")).unionByName(links.select(F.col("b").alias("node"))).distinct()
    alone = nodes.join(label, "node", "left_anti").withColumn("component", F.col("node"))
    label = label.unionByName(alone)
    end = lambda side: label.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
    between = links.join(end("a"), "a").join(end("b"), "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
    moved = components(between).select(F.col("node").alias("component"), F.col("component").alias("into"))
    found = label.join(moved, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    return staged(found, "components-label")
