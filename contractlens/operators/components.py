"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from contractlens.session import cut_lineage


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges as a written table, and a mark that tells edge sets apart, found while
    writing."""
    seen = Observation()
    ab, ba = F.xxhash64("a", "b"), F.xxhash64("b", "a")
    marked = edges.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(ab).alias("x"), F.bit_xor(ba).alias("y"))
    table = cut_lineage(marked)
    return table, tuple(seen.get[name] for name in ("n", "x", "y"))


def _with_least(pairs: DataFrame) -> DataFrame:
    """Pairs (a, b) with the least of a and all its b.

    The least values are written first: the join then reads plain tables, and Spark can
    split the rows of a node with very many neighbours.
    """
    least = cut_lineage(pairs.groupBy("a").agg(F.min("b").alias("least")))
    return pairs.join(least, "a").select("a", "b", F.least("a", "least").alias("least"))


def connected_components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) of all nodes with an edge.

    `edges` has two columns a and b of one orderable type, in any direction, possibly
    repeated; loops and nulls are no edges. Neighbours are only counted, compared and
    joined, never collected; the number of rounds grows with the logarithm of a
    component's size.
    """
    edges = edges.select("a", "b").filter("a <> b")
    edges, mark = _written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while mark[0] and mark != before:
        before = mark
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both).filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = cut_lineage(large.filter("a <> b").distinct())
        # every edge points down now, so the least of a is the least of its b
        small = _with_least(large)
        down = small.select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
        own = small.select("a", F.col("least").alias("b"))
        edges, mark = _written(down.unionByName(own).distinct())
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
