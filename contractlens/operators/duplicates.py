"""Duplicate entries: the first entry stays, later copies point to it.

Entries of one department are taken in (source_fiscal, id) order. An entry that no
kept entry matches is kept. A kept entry marks the others that share its value and
  1. vendor and contract date, else
  2. vendor, reference and start year, else
  3. reference number.
Missing values match each other. A marked entry does not mark anything itself, so
this is not "every row after the first of its key".
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens.operators.claims import TAIL_ROWS, accepted_rows
from contractlens.operators.grouping import FOLD_LIMIT, same_key, split_by_group_size, together

GROUP = ["owner_acronym", "contract_value"]


def eligible(rows: DataFrame) -> Column:
    return ~F.col("gen_is_error") & F.col("source_fiscal").isNotNull()


def _flags(keeper: Column, via: Column) -> list[Column]:
    return [
        keeper.isNotNull().alias("gen_is_duplicate"),
        F.when(keeper.isNotNull(), via).cast("int").alias("gen_duplicate_via"),
        keeper.alias("gen_duplicate_source_id"),
    ]


def _same_purchase(a: Column, b: Column) -> Column:
    return a["gen_vendor_normalized"].eqNullSafe(b["gen_vendor_normalized"]) & a[
        "raw_contract_date"
    ].eqNullSafe(b["raw_contract_date"])


def _same_reference(a: Column, b: Column) -> Column:
    return a["reference_number"].eqNullSafe(b["reference_number"])


def _via(kept: Column, row: Column) -> Column:
    return (
        F.when(_same_purchase(kept, row), 1)
        .when(
            kept["gen_vendor_normalized"].eqNullSafe(row["gen_vendor_normalized"])
            & kept["gen_start_year"].eqNullSafe(row["gen_start_year"]),
            2,
        )
        .otherwise(3)
    )


KEPT_FIELDS = [
    "id",
    "gen_vendor_normalized",
    "raw_contract_date",
    "reference_number",
    "gen_start_year",
]


def _small_groups(rows: DataFrame) -> DataFrame:
    """Groups of bounded size, after one shuffle.

    Entries that share neither rule's key with another entry are kept as they are;
    only the others are gathered and walked.
    """
    # Spark normalises floating keys in each grouping, which would shuffle again every
    # time; the value as text keeps the one partitioning good for all steps below
    keyed = rows.withColumn("_value", (F.col("contract_value") + 0.0).cast("string"))
    group = ["owner_acronym", "_value"]
    purchase = Window.partitionBy(*group, "gen_vendor_normalized", "raw_contract_date")
    reference = Window.partitionBy(*group, "reference_number")
    one = F.count(F.lit(1))
    counted = together(keyed, group).withColumn(
        "_shared", (one.over(purchase) > 1) | (one.over(reference) > 1)
    )
    alone = counted.filter(~F.col("_shared")).select(
        *rows.columns, *_flags(F.lit(None).cast("bigint"), F.lit(1))
    )
    walked = _fold(counted.filter("_shared").drop("_shared"), group)
    return alone.unionByName(walked.select(*alone.columns))


def _fold(rows: DataFrame, group: list[str]) -> DataFrame:
    """Sort inside each group and walk it once."""
    others = [c for c in rows.columns if c not in (*group, "source_fiscal", "id")]
    types = dict(rows.dtypes)
    kept_type = "array<struct<" + ",".join(f"{c}:{types[c]}" for c in KEPT_FIELDS) + ">>"
    grouped = rows.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct("source_fiscal", "id", *others))).alias("entries")
    )

    def matches(kept: Column, row: Column) -> Column:
        return _same_purchase(kept, row) | _same_reference(kept, row)

    def keep(kept: Column, row: Column) -> Column:
        return F.when(F.exists(kept, lambda k: matches(k, row)), kept).otherwise(
            F.concat(kept, F.array(F.struct(*[row[c].alias(c) for c in KEPT_FIELDS])))
        )

    kept = F.aggregate("entries", F.array().cast(kept_type), keep)
    walked = grouped.withColumn("kept", kept).select(
        *group,
        F.inline(
            F.transform(
                "entries",
                lambda row: F.struct(
                    row.alias("row"),
                    F.filter("kept", lambda k: matches(k, row))[0].alias("keeper"),
                ),
            )
        ),
    )
    keeper, row = F.col("keeper"), F.col("row")
    source = F.when(keeper["id"] != row["id"], keeper["id"])
    return walked.select(*group, "row.*", *_flags(source, _via(keeper, row)))


def _join_rounds(rows: DataFrame, tail_rows: int) -> DataFrame:
    """Groups of any size: accepted rows by rounds, then one lookup per key."""
    group = [F.col(c) for c in GROUP]
    purchase = F.struct(*group, "gen_vendor_normalized", "raw_contract_date")
    reference = F.struct(*group, "reference_number")
    order = F.struct("source_fiscal", "id")
    candidates = rows.select(
        order.alias("ord"),
        purchase.alias("read_1"),
        purchase.alias("write_1"),
        reference.alias("read_2"),
        reference.alias("write_2"),
        F.struct("gen_vendor_normalized", "gen_start_year").alias("info"),
    )
    kept = accepted_rows(candidates, GROUP, tail_rows).select("ord", "write_1", "write_2", "info")
    by_purchase = kept.select(
        F.col("write_1").alias("key_1"), F.struct("ord", "info").alias("kept_1")
    )
    by_reference = kept.select(
        F.col("write_2").alias("key_2"), F.struct("ord", "info").alias("kept_2")
    )
    joined = (
        rows.withColumn("_p", purchase)
        .withColumn("_r", reference)
        .withColumn("_o", order)
        .join(by_purchase, same_key(F.col("_p"), F.col("key_1")), "left")
        .join(by_reference, same_key(F.col("_r"), F.col("key_2")), "left")
    )
    one, two = F.col("kept_1"), F.col("kept_2")
    by_one = one.isNotNull() & (two.isNull() | (one["ord"] <= two["ord"]))
    keeper = F.when(by_one, one).otherwise(two)
    # a kept row finds itself first; only an earlier row is a keeper
    source = F.when(keeper["ord"] < F.col("_o"), keeper["ord"]["id"])
    via = (
        F.when(by_one, 1)
        .when(
            two["info"]["gen_vendor_normalized"].eqNullSafe(F.col("gen_vendor_normalized"))
            & two["info"]["gen_start_year"].eqNullSafe(F.col("gen_start_year")),
            2,
        )
        .otherwise(3)
    )
    return joined.select(*[F.col(c) for c in rows.columns], *_flags(source, via))


def find_duplicates(
    rows: DataFrame, fold_limit: int = FOLD_LIMIT, tail_rows: int = TAIL_ROWS
) -> DataFrame:
    """Add gen_is_duplicate, gen_duplicate_via and gen_duplicate_source_id.

    Pass the narrow key columns rather than whole records: every column given here
    goes through the shuffle.
    """
    work = rows.filter(eligible(rows))
    skipped = rows.filter(~F.coalesce(eligible(rows), F.lit(False)))
    small, large = split_by_group_size(work, GROUP, fold_limit)
    out = _small_groups(small)
    if large is not None:
        out = out.unionByName(_join_rounds(large, tail_rows))
    none = F.lit(None).cast("bigint")
    return out.unionByName(skipped.select(*rows.columns, *_flags(none, F.lit(1))))


def first_in_key(rows: DataFrame, key: list[str]) -> DataFrame:
    """One matching rule alone: every later row of a key points to the first one."""
    first = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in key]).agg(
        F.min(F.struct("source_fiscal", "id")).alias("_first")
    )
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    source = F.when(F.col("_first.id") != F.col("id"), F.col("_first.id"))
    return rows.join(first, same, "left").select(
        *rows.columns,
        source.isNotNull().alias("is_later"),
        source.alias("first_id"),
    )


def duplicate_pairs(rows: DataFrame, key: list[str]) -> DataFrame:
    """(first id, later id) of every key: a star, never all pairs of a key."""
    flagged = first_in_key(rows, key)
    return flagged.filter("is_later").select(
        F.col("first_id").alias("first_id"), F.col("id").alias("later_id")
    )
