"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crawldelta.llm.scratch import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = low.select("a", F.col("m").alias("b"))
    return moved.unionByName(own).where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")), F.bit_xor(F.xxhash64("b", "a"))).first()
    )


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the smallest node reachable.

    Self links, repeated and reversed edges are allowed; an edge with a null
    end is left out; no edges give no rows. The rounds grow with the logarithm
    of the number of nodes.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    ends = edges.where("a is not null and b is not null and a <> b").select(high.alias("a"), low.alias("b"))
    now = stored(ends.distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    tree = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return tree.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
