"""Helpers for work inside groups whose size is not known in advance."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens.session import cut_lineage, small_side

# Groups up to this many rows are sorted and folded inside one row; larger ones
# are never gathered, they take the join-based path.
FOLD_LIMIT = 512


def all_equal(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the keys of two aliased sides."""
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )


def same_key(left: Column, right: Column) -> Column:
    """Null-safe equality of two key structs of the same types.

    Their hashes come first: a join then sorts by a number, and compares structs only where
    the numbers are equal.
    """
    return (F.xxhash64(left) == F.xxhash64(right)) & left.eqNullSafe(right)


def split_by_group_size(
    rows: DataFrame, keys: list[str], limit: int
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups up to the limit, rows of larger groups or None).

    The sizes come from a count with map-side combine over the key columns alone.
    """
    large = cut_lineage(
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("group_rows"))
        .filter(F.col("group_rows") > limit)
        .select(*keys)
    )
    if large.isEmpty():
        return rows, None
    side = small_side(large)
    match = all_equal("r", "g", keys)
    small = rows.alias("r").join(side.alias("g"), match, "left_anti")
    big = rows.alias("r").join(side.alias("g"), match, "left_semi")
    return small, big


def together(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Bring groups together over all shuffle partitions, at least one per core.

    The rows are few bytes but the work on them is not, so the adaptive merge of small
    partitions would leave most cores idle. Later grouping by these or more keys needs
    no further shuffle.
    """
    spark = rows.sparkSession
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(configured, spark.sparkContext.defaultParallelism), *keys)


def numbered(
    rows: DataFrame, groups: list[str], order: list[str], bucket: Column, name: str = "seq"
) -> DataFrame:
    """1-based position of each row in its group, without one task per group.

    `bucket` must not decrease along the order. Rows are numbered inside
    (group, bucket); the rows of earlier buckets are added from a table of counts.
    """
    keyed = rows.withColumn("_bucket", bucket)
    by_bucket = keyed.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = by_bucket.select(
        *[F.col(c).alias(f"_o_{c}") for c in (*groups, "_bucket")],
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"),
    )
    same = F.lit(True)
    for c in (*groups, "_bucket"):
        same = same & F.col(c).eqNullSafe(F.col(f"_o_{c}"))
    inside = Window.partitionBy(*groups, "_bucket").orderBy(*order)
    return (
        keyed.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, same, "inner")
        .select(*rows.columns, (F.col("_rank") + F.col("_offset")).alias(name))
    )
