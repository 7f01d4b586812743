"""Connected components of a graph of any size by alternating large and small stars.

In a large-star step every neighbour of a node that is larger than the node is linked to the smallest neighbour;
in a small-star step every neighbour that is not larger is. The components stay the same and the number of links
does not grow; after some rounds (logarithmic in the longest chain) every node is linked to the smallest of its
component only. A step has one exchange: a node's links stand together and sorted, so that the first has its smallest neighbour and
repeated ones are next to each other. A node with very many links keeps them in one task, two values each, which Spark sorts
and spills. Callers return forests, so there are fewer links than nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyweave.llm.common import Scratch


def _with_least(links: DataFrame) -> DataFrame:
    """(a, b, m) without repeated rows; m is the smallest b that a has. One exchange, in which a node's rows are sorted."""
    by_node = Window.partitionBy("a").orderBy("b")
    marked = links.select("a", "b", F.first("b").over(by_node).alias("m"), F.lag("b").over(by_node).alias("last"))
    return marked.where("last is null or last <> b").drop("last")


def _large_star(links: DataFrame) -> DataFrame:
    ways = links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*")
    return _with_least(ways).where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Of links from larger to smaller nodes. A node's link to its smallest stays; its others become links of theirs."""
    return _with_least(links).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) for every node that `links` (columns a, b) names; component is its smallest node.

    Nodes may be of any type that can be ordered. Links from a node to itself and repeated links do no harm; an
    empty table gives an empty one.
    """
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    links = scratch.write(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), f"{name}-0")
    before, step = links.agg(F.count("*"), mark).first(), 0
    while before[0]:
        step += 1
        links = scratch.write(_small_star(_large_star(links)), f"{name}-{step}")
        after = links.agg(F.count("*"), mark).first()
        scratch.remove(f"{name}-{step - 1}")
        if after == before:
            break
        before = after
    # The last round has dropped repeated rows.
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select(F.col("b"), F.col("b")).distinct())
