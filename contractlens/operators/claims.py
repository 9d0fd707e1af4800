"""First-come claims over shared keys, as rounds of joins.

Rows come in one order. Each row looks at two keys and, when no earlier accepted
row has claimed either of them, is accepted and claims two keys itself. Taken one
by one this is a loop over the whole group. Here it is taken apart, without changing
the outcome:

* a round accepts every row that is first at both of its keys among the rows still
  open, and closes the rows whose keys were claimed (the parallel greedy matching of
  Blelloch, Fineman and Shun, 2012). Rows in an order that has nothing to do with their
  keys are nearly all settled by a few rounds;
* the rows that are left are split into connected components over their keys. Rows of
  different components never meet at a key, so every component of bounded size is walked
  in order by itself, many of them in one job;
* only components beyond that bound go on with rounds, and are split again after them.

Rounds and components are aggregates with map-side combine and joins, so no key is
ever gathered, however large. Every round closes at least the first open row, so the
loop ends for any data.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.operators.components import connected_components
from contractlens.operators.grouping import same_key
from contractlens.session import cut_lineage, small_side

# Rows that one job may walk in order; a bound on the whole rest, not on each group.
TAIL_ROWS = 100_000
# Rows of a component that one task may walk in order.
COMPONENT_ROWS = 50_000
# Rounds before the rest is split into components.
ROUNDS = 4


def at_most(rows: DataFrame, bound: int) -> bool:
    """Whether a written table has no more rows than the bound (counted from its footers)."""
    return rows.count() <= bound


def _first(rows: DataFrame, key: str, name: str) -> DataFrame:
    # the least struct is found by sorting; with the hash first, numbers are sorted
    keys = [F.xxhash64(key).alias("_hash"), F.col(key).alias(f"{name}_key")]
    return rows.groupBy(*keys).agg(F.min("ord").alias(name)).drop("_hash")


def _with_first(rows: DataFrame, firsts: DataFrame, key: str, name: str) -> DataFrame:
    """Add the first `ord` found under the row's key; missing where there is none."""
    return rows.join(firsts, same_key(F.col(key), F.col(f"{name}_key")), "left").drop(f"{name}_key")


def _walk(group: pd.DataFrame) -> pd.DataFrame:
    """The loop itself, over the short rest of one group, linear in its rows."""
    ordered = group.sort_values(["a", "b"], kind="stable")
    taken_1, taken_2, kept = set(), set(), []
    columns = (ordered[c] for c in ("r1", "w1", "r2", "w2"))
    for r1, w1, r2, w2 in zip(*columns, strict=True):
        free = r1 not in taken_1 and r2 not in taken_2
        kept.append(free)
        if free:
            taken_1.add(w1)
            taken_2.add(w2)
    return ordered.loc[kept, ["a", "b"]]


def _walked(open_rows: DataFrame, name: Column, order: list[str]) -> DataFrame:
    """Accepted rows; the rows of one name, of bounded number, are walked by themselves."""
    types = {f.name: f.dataType.simpleString() for f in open_rows.schema["ord"].dataType.fields}
    keys = [F.to_json(F.struct(F.col(c).alias("k"))).alias(n) for c, n in
            (("read_1", "r1"), ("write_1", "w1"), ("read_2", "r2"), ("write_2", "w2"))]
    a, b = order
    accepted = (
        open_rows.select(name.alias("g"), F.col(f"ord.{a}").alias("a"), F.col(f"ord.{b}").alias("b"), *keys)
        .groupBy("g")
        .applyInPandas(_walk, f"a {types[a]}, b {types[b]}")
    )
    return open_rows.join(
        accepted, (F.col(f"ord.{a}") == F.col("a")) & (F.col(f"ord.{b}") == F.col("b")), "left_semi"
    )


def _round(open_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows that are first at both of their keys, and the rows that stay open."""
    ranked = _with_first(open_rows, _first(open_rows, "write_1", "first_1"), "read_1", "first_1")
    ranked = _with_first(ranked, _first(open_rows, "write_2", "first_2"), "read_2", "first_2")
    fresh = cut_lineage(
        ranked.filter(
            F.coalesce(F.col("ord") <= F.col("first_1"), F.lit(True))
            & F.coalesce(F.col("ord") <= F.col("first_2"), F.lit(True))
        ).drop("first_1", "first_2")
    )
    left = _with_first(open_rows, _first(fresh, "write_1", "taken_1"), "read_1", "taken_1")
    left = _with_first(left, _first(fresh, "write_2", "taken_2"), "read_2", "taken_2")
    left = left.filter(
        F.coalesce(F.col("ord") < F.col("taken_1"), F.lit(True))
        & F.coalesce(F.col("ord") < F.col("taken_2"), F.lit(True))
    ).drop("taken_1", "taken_2")
    return fresh, cut_lineage(left)


def with_component(open_rows: DataFrame) -> DataFrame:
    """The rows with `component`, equal for rows that are linked through keys.

    A row links its keys to each other. Keys are told apart by a hash; keys that share one
    would only make a component larger.
    """
    side = lambda number, name: F.xxhash64(F.lit(number), F.col(name))
    first = side(1, "write_1")
    links = open_rows.select(first.alias("a"), side(2, "read_2").alias("b")).unionByName(
        open_rows.select(first.alias("a"), side(2, "write_2").alias("b"))
    )
    roots = connected_components(links.distinct())
    named = open_rows.withColumn("_key", first).join(roots, F.col("_key") == F.col("node"), "left")
    return named.withColumn("component", F.coalesce("root", "_key")).drop("_key", "node", "root")


def _by_component(open_rows: DataFrame, order: list[str], bound: int) -> tuple[DataFrame, DataFrame]:
    """Accepted rows of the components of up to `bound` rows, and all rows of larger ones."""
    named = cut_lineage(with_component(open_rows))
    large = cut_lineage(
        named.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bound).select("component")
    )
    side = small_side(large)
    small = named.join(side, "component", "left_anti")
    rest = cut_lineage(named.join(side, "component", "left_semi").drop("component"))
    return cut_lineage(_walked(small, F.col("component"), order).drop("component")), rest


def accepted_rows(
    candidates: DataFrame, group: list[str], tail_rows: int = TAIL_ROWS,
    component_rows: int = COMPONENT_ROWS, rounds: int = ROUNDS,
) -> DataFrame:
    """The accepted rows among `candidates(ord, read_1, write_1, read_2, write_2, ...)`.

    `ord` is a unique struct of two sortable fields. `write_1` must equal `read_1`,
    which lets rows with equal read keys be reduced to their first one before anything
    is joined. This takes two steps: rows that differ in the second field of `ord` alone are
    reduced by the least number, for which nothing is sorted, and the few others by the
    least struct; columns beside the keys should not repeat that field. All key structs hold the `group` fields. With no more than `tail_rows` open
    rows in all, each group's rest is walked in order; components are split off after
    every `rounds` rounds.
    """
    rest = [c for c in candidates.columns if c not in ("ord", "read_1", "read_2", "write_1")]
    order = candidates.schema["ord"].dataType.fieldNames()
    a, b = order
    keys = ["_hash", "read_1", "read_2"]
    alike = (
        candidates.withColumn("_hash", F.xxhash64("read_1", "read_2"))
        .groupBy(*keys, F.col(f"ord.{a}").alias(a), *rest)
        .agg(F.min(f"ord.{b}").alias(b))
    )
    open_rows = cut_lineage(
        alike.groupBy(*keys)
        .agg(F.min(F.struct(F.struct(a, b).alias("ord"), *rest)).alias("row"))
        .select("read_1", F.col("read_1").alias("write_1"), "read_2", "row.*")
    )
    accepted, done = [], 0
    while not at_most(open_rows, tail_rows):
        if done and done % rounds == 0:
            walked, open_rows = _by_component(open_rows, order, component_rows)
            accepted.append(walked)
            if at_most(open_rows, tail_rows):
                break
        fresh, open_rows = _round(open_rows)
        accepted.append(fresh)
        done += 1
    whole = F.to_json(F.struct(*[F.col(f"read_1.{g}") for g in group]))
    accepted.append(_walked(open_rows, whole, order) if tail_rows else open_rows)
    return cut_lineage(reduce(DataFrame.unionByName, accepted))
