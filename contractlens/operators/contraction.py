"""Truth values over a forest, by contraction in rounds that grow with log n.

Every node's value is an OR over its children, each child's value taken as it is or
negated. Walking up from the leaves settles one layer at a time, so a chain would take
as many rounds as it has nodes. Here a round does two things to all open nodes at once:

* rake: links to nodes that were settled in the round before are resolved; a link that
  says true settles its parent, and a parent without open links is false;
* compress: a node with one open link is a function of one other node, so each link to it
  is replaced by a link to that node with the two negations composed. Chains are halved.

Both together settle a forest of any shape in O(log n) rounds (tree contraction of Miller
and Reif, 1985). A round is two equi joins and one aggregate with partial results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlens.session import cut_lineage, shuffled


def _raked(links: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links whose child is not among the freshly settled nodes, and the parents' state:
    takes (a link said true), open links, and the open one if it is the only one."""
    says = links.join(shuffled(fresh), F.col("child") == F.col("node"), "left").select(
        "parent", "child", "flip", (F.col("flip") != F.col("value")).alias("says")
    )
    says = cut_lineage(says)
    only = F.struct("child", "flip")
    state = cut_lineage(
        says.groupBy("parent").agg(
            F.coalesce(F.bool_or("says"), F.lit(False)).alias("takes"),
            F.count_if(F.col("says").isNull()).alias("open"),
            F.max(F.when(F.col("says").isNull(), only)).alias("only"),
        )
    )
    return says.filter("says IS NULL").drop("says"), state


def _compressed(links: DataFrame, state: DataFrame) -> DataFrame:
    """The open links of open parents; links to a node with one link go past it."""
    live = state.filter("NOT takes AND open > 0")
    links = links.join(shuffled(live.select(F.col("parent").alias("live"))), F.col("parent") == F.col("live"), "left_semi")
    single = live.filter("open = 1").select(
        F.col("parent").alias("past"), F.col("only.child").alias("beyond"), F.col("only.flip").alias("turn")
    )
    return links.join(shuffled(single), F.col("child") == F.col("past"), "left").select(
        "parent",
        F.coalesce("beyond", "child").alias("child"),
        F.when(F.col("past").isNull(), F.col("flip")).otherwise(F.col("flip") != F.col("turn")).alias("flip"),
    )


def forest_values(links: DataFrame, known: DataFrame) -> tuple[DataFrame, int]:
    """(node, value) of all parents, and the number of rounds.

    links: parent, child, flip (take the child's value negated), one row for each child,
    without circles. known: node and value of the children that are no parents.
    """
    links, fresh, settled, rounds = cut_lineage(links.select("parent", "child", "flip")), known, [], 0
    while not links.isEmpty():
        rounds += 1
        still, state = _raked(links, fresh)
        fresh = state.filter("takes OR open = 0").select(F.col("parent").alias("node"), F.col("takes").alias("value"))
        settled.append(fresh)
        links = cut_lineage(_compressed(still, state))
    if not settled:
        return known.filter(F.lit(False)), 0
    return reduce(DataFrame.unionByName, settled), rounds
