"""Amendment groups: an entry and the entries that amend it.

Entries of one department and vendor are taken in (source_fiscal, id) order. An
entry that is still without a group gathers every other entry without a group that
has its reference number, or whose original value is its contract value in the same
start year. If it gathers any, it becomes the group's contract and they become its
amendments. Members belong to the gatherer only (the links are not transitive), and
a later entry may gather an earlier one that gathered nothing itself.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.operators.claims import TAIL_ROWS, accepted_rows, at_most
from contractlens.operators.contraction import forest_values
from contractlens.operators.grouping import FOLD_LIMIT, same_key, split_by_group_size, together
from contractlens.session import cut_lineage, shuffled

GROUP = ["owner_acronym", "gen_vendor_normalized"]
ADDED = ["gen_is_amendment", "gen_amendment_via", "gen_amendment_group_id"]


def eligible(rows: DataFrame) -> Column:
    return ~F.col("gen_is_duplicate") & ~F.col("gen_is_error") & F.col("source_fiscal").isNotNull()


def _flags(group_id: Column) -> list[Column]:
    joined = group_id.isNotNull() & (group_id != F.col("id"))
    return [
        joined.alias("gen_is_amendment"),
        F.when(joined, 1).alias("gen_amendment_via"),
        group_id.alias("gen_amendment_group_id"),
    ]


def _linked(gatherer: Column, row: Column) -> Column:
    by_value = row["original_value"].eqNullSafe(gatherer["contract_value"]) & row[
        "gen_start_year"
    ].eqNullSafe(gatherer["gen_start_year"])
    return row["reference_number"].eqNullSafe(gatherer["reference_number"]) | by_value


def _fold(rows: DataFrame) -> DataFrame:
    """Groups of bounded size: `owner_of[i]` is the position of entry i's gatherer."""
    others = [c for c in rows.columns if c not in (*GROUP, "source_fiscal", "id")]
    grouped = together(rows, GROUP).groupBy(*GROUP).agg(
        F.array_sort(F.collect_list(F.struct("source_fiscal", "id", *others))).alias("entries")
    )
    entries = F.col("entries")
    positions = F.sequence(F.lit(0), F.size(entries) - 1)

    def gather(owner_of: Column, i: Column) -> Column:
        def wanted(j: Column) -> Column:
            return (
                (j != i)
                & F.get(owner_of, j).isNull()
                & _linked(F.get(entries, i), F.get(entries, j))
            )

        gathered = F.transform(
            owner_of,
            lambda owner, j: F.when((j == i) | wanted(j), i).otherwise(owner),
        )
        nothing_to_do = F.get(owner_of, i).isNotNull() | ~F.exists(positions, wanted)
        return F.when(nothing_to_do, owner_of).otherwise(gathered)

    none = F.array_repeat(F.lit(None).cast("int"), F.size(entries))
    walked = grouped.withColumn("owner_of", F.aggregate(positions, none, gather)).select(
        *GROUP,
        F.inline(
            F.transform(
                "entries",
                lambda row, i: F.struct(
                    row.alias("row"),
                    F.get(entries, F.get(F.col("owner_of"), i))["id"].alias("group_id"),
                ),
            )
        ),
    )
    flat = walked.select(*GROUP, "row.*", F.col("group_id").alias("_group_id"))
    return flat.select(*rows.columns, *_flags(F.col("_group_id")))


def _judge(group: pd.DataFrame) -> pd.DataFrame:
    """Whether each open acting entry of one group gathers, in order.

    A child always comes before its parent, so one walk settles all of them.
    """
    gathers = dict(zip(group["id"], group["sure"], strict=True))
    open_ids = set(group.loc[group["waits"], "id"])
    ordered = group.sort_values(["fiscal", "id"], kind="stable")
    for child, parent in zip(ordered["id"], ordered["parent"], strict=True):
        if parent in open_ids and not gathers[child]:
            gathers[parent] = True
    found = [i for i in open_ids if gathers[i]]
    return group.loc[group["id"].isin(found), ["fiscal", "id"]]


def _gathering(neighbours: DataFrame, tail_rows: int) -> DataFrame:
    """(d): the acting entries that gather something.

    An acting entry surely gathers when an entry that does not act falls to it. The
    others gather exactly when an acting entry that falls to them gathers nothing: an OR
    of negations over a forest. A short rest is walked in order, a longer one is
    contracted, in rounds that grow with the logarithm of its rows.
    """
    surely = neighbours.filter(~F.col("acts")).select(F.col("neighbour").alias("n")).distinct()
    acting = cut_lineage(
        neighbours.filter("acts")
        .join(shuffled(surely), F.col("ord") == F.col("n"), "left")
        .select("grp", "ord", "neighbour", F.col("n").isNotNull().alias("sure"))
    )
    done = acting.filter("sure").select(F.col("ord").alias("d"))
    # only entries that wait, and the acting entries that fall to them, are looked at
    unsure = acting.filter(~F.col("sure")).select(F.col("ord").alias("u"))
    parents = acting.join(shuffled(unsure), F.col("neighbour") == F.col("u")).select(F.col("u")).distinct()
    judged = cut_lineage(
        acting.join(shuffled(parents), F.col("ord") == F.col("u"), "left")
        .withColumnRenamed("u", "as_parent")
        .join(shuffled(parents), F.col("neighbour") == F.col("u"), "left")
        .filter(F.col("as_parent").isNotNull() | F.col("u").isNotNull())
        .select(
            "grp", "ord", "sure", F.col("u").alias("parent"),
            (F.col("as_parent").isNotNull() & ~F.col("sure")).alias("waits"),
        )
    )
    if tail_rows and at_most(judged, tail_rows):
        flat = judged.select(
            "grp", F.col("ord.source_fiscal").alias("fiscal"), F.col("ord.id").alias("id"),
            F.col("parent.id").alias("parent"), "sure", "waits",
        )
        kind = dict(flat.dtypes)["id"]
        found = flat.groupBy("grp").applyInPandas(_judge, f"fiscal string, id {kind}")
        return done.union(
            found.select(F.struct(F.col("fiscal").alias("source_fiscal"), "id").alias("d"))
        )
    settled, _ = forest_values(
        judged.filter(F.col("parent").isNotNull()).select("parent", F.col("ord").alias("child"), F.lit(True).alias("flip")),
        judged.filter(~F.col("waits")).select(F.col("ord").alias("node"), F.col("sure").alias("value")),
    )
    return done.union(settled.filter("value").select("node"))


def _join_rounds(rows: DataFrame, tail_rows: int) -> DataFrame:
    """Groups of any size.

    An entry acts (gathers) when no earlier acting entry holds its reference number
    or has its original value as contract value: rounds of joins find these. Then
    each entry's first acting neighbour other than itself is looked up, and acting
    entries that gathered nothing fall to that neighbour.
    """
    group = [F.col(c) for c in GROUP]
    reference = F.struct(*group, "reference_number")
    wanted = F.struct(*group, F.col("original_value").alias("v"), F.col("gen_start_year").alias("y"))
    offered = F.struct(*group, F.col("contract_value").alias("v"), F.col("gen_start_year").alias("y"))
    keyed = rows.select(
        F.struct("source_fiscal", "id").alias("ord"),
        reference.alias("read_1"),
        reference.alias("write_1"),
        wanted.alias("read_2"),
        offered.alias("write_2"),
    )
    acting = accepted_rows(keyed, GROUP, tail_rows).select("ord", "write_1", "write_2")

    by_reference = acting.select(F.col("write_1").alias("key_1"), F.col("ord").alias("act_1"))
    hashed = F.xxhash64("write_2").alias("_hash")
    first_offer = acting.groupBy(hashed, F.col("write_2").alias("key_2")).agg(F.min("ord").alias("act_2")).drop("_hash")
    # An acting entry can offer the very value it wants; it then needs the second offer.
    second_offer = (
        acting.join(shuffled(first_offer), same_key(F.col("write_2"), F.col("key_2")))
        .filter(F.col("ord") > F.col("act_2"))
        .groupBy(F.xxhash64("key_2").alias("_hash"), "key_2")
        .agg(F.min("ord").alias("act_3"))
        .select(F.col("key_2").alias("key_3"), "act_3")
    )
    offers = first_offer.join(
        shuffled(second_offer), same_key(F.col("key_2"), F.col("key_3")), "left"
    ).drop("key_3")

    neighbours = (
        keyed.select("ord", "read_1", "read_2")
        .join(shuffled(by_reference), same_key(F.col("read_1"), F.col("key_1")), "left")
        .join(shuffled(offers), same_key(F.col("read_2"), F.col("key_2")), "left")
        .select(
            "ord",
            F.to_json(F.struct(*[F.col(f"read_1.{c}") for c in GROUP])).alias("grp"),
            F.coalesce(F.col("act_1") == F.col("ord"), F.lit(False)).alias("acts"),
            F.least(
                F.when(F.col("act_1") != F.col("ord"), F.col("act_1")),
                F.when(F.col("act_2") != F.col("ord"), F.col("act_2")).otherwise(F.col("act_3")),
            ).alias("neighbour"),
        )
    )
    neighbours = cut_lineage(neighbours)

    gathering = _gathering(neighbours, tail_rows)
    outcome = (
        neighbours.join(shuffled(gathering), F.col("ord") == F.col("d"), "left").select(
            F.col("ord.id").alias("_id"),
            F.when(F.col("d").isNotNull(), F.col("ord.id"))
            .otherwise(F.col("neighbour.id"))
            .alias("_group_id"),
        )
    )
    return rows.join(shuffled(outcome), F.col("id") == F.col("_id")).select(
        *rows.columns, *_flags(F.col("_group_id"))
    )


def find_amendments(
    rows: DataFrame, fold_limit: int = FOLD_LIMIT, tail_rows: int = TAIL_ROWS
) -> DataFrame:
    """Add gen_is_amendment, gen_amendment_via and gen_amendment_group_id."""
    work, skipped = taking_part(rows)
    return amendment_groups(work, fold_limit, tail_rows).unionByName(ungrouped(skipped))


def taking_part(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may be in amendment groups, all others)."""
    return rows.filter(eligible(rows)), rows.filter(~F.coalesce(eligible(rows), F.lit(False)))


def ungrouped(rows: DataFrame) -> DataFrame:
    """The flags of rows that are in no group."""
    return rows.select("*", *_flags(F.lit(None).cast("bigint")))


def amendment_groups(
    work: DataFrame, fold_limit: int = FOLD_LIMIT, tail_rows: int = TAIL_ROWS
) -> DataFrame:
    """The flags of rows that all take part."""
    small, large = split_by_group_size(work, GROUP, fold_limit)
    out = _fold(small)
    if large is not None:
        out = out.unionByName(_join_rounds(large, tail_rows))
    return out


def linked_pairs(rows: DataFrame) -> DataFrame:
    """(from_id, to_id) links by value: to_id's original value is from_id's value.

    Reference links are given as a star from the first entry of each reference, so
    no key emits all its pairs.
    """
    keys = ["owner_acronym", "gen_vendor_normalized", "reference_number"]
    first = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("id").alias("from_id"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    by_reference = (
        rows.join(shuffled(first), same)
        .filter(F.col("id") != F.col("from_id"))
        .select("from_id", F.col("id").alias("to_id"))
    )
    offer = rows.groupBy(
        F.col("owner_acronym").alias("_o"),
        F.col("gen_vendor_normalized").alias("_v"),
        F.col("contract_value").alias("_value"),
        F.col("gen_start_year").alias("_year"),
    ).agg(F.min("id").alias("from_id"))
    by_value = (
        rows.filter(F.col("original_value").isNotNull())
        .join(
            shuffled(offer),
            F.col("owner_acronym").eqNullSafe(F.col("_o"))
            & F.col("gen_vendor_normalized").eqNullSafe(F.col("_v"))
            & (F.col("original_value") == F.col("_value"))
            & F.col("gen_start_year").eqNullSafe(F.col("_year")),
        )
        .filter(F.col("id") != F.col("from_id"))
        .select("from_id", F.col("id").alias("to_id"))
    )
    return by_reference.union(by_value).distinct()
