"""Connected components of links between rows, by alternating star steps; hub nodes are split.

A node is a value of any type that Spark can order; links within a key have nodes that are structs of the key and the row,
so one run closes all keys at once, and no task holds one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave import tables
from tallyweave.tables import Successive, with_facts


def _stars(edges: DataFrame) -> bool:
    """Whether no node hangs from two others, and none from one that hangs itself."""
    if edges.groupBy("a").count().where("count > 1").limit(1).count():
        return False
    above = edges.select("b").distinct()
    return above.join(edges.select(F.col("a").alias("b")), "b", "left_semi").limit(1).count() == 0


def _pointed(edges: DataFrame, least: DataFrame, few: bool = False) -> DataFrame:
    """(a, m): the least node that is linked with each edge's other end. least: a, m, and n, how many edges a has. few: no node can be a hub."""
    met = edges.join(least, "a") if few else with_facts(edges, least, "a", "n")
    return met.select(F.col("b").alias("a"), F.col("m").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each linked node can reach. links: (a, b), repeated or not, in any direction.

    Large-star and small-star steps alternate until all nodes hang on their component's least one; each step is written. The
    least neighbours of hubs (nodes with more than a thousandth of all links, of which there are few) are broadcast, so the
    links of a hub stay where they are. Nodes without links, and links of a node with itself, give no rows.
    """
    written, starred = Successive(), Successive()
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(edges):
        few = 2 * edges.count() <= tables.HOT_ROWS
        # large star: larger neighbours of a node go to its least neighbour
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        large = _pointed(both.where("b > a"), least, few).distinct()
        if not few:
            large = starred(large)
        # small star: smaller neighbours of a node, and the node, go to its least neighbour
        least = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = _pointed(large, least, few).union(least.select("a", F.col("m").alias("b")))
        edges = written(small.where("a <> b").distinct())
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
