"""Chart-ready series: one row per label with a value for every point of the axis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens.functions.money import table_currency
from contractlens.operators.lookup import label_lookup
from contractlens.session import cut_lineage


def axis_table(spark, axis: Column, name: str) -> DataFrame:
    """The points of an axis as rows, in order."""
    return spark.range(1).select(F.posexplode(axis).alias("position", name))


def gap_fill_series(
    rows: DataFrame,
    label: str,
    time: str,
    value: str,
    axis: Column,
    default: float = 0,
    within: list[str] | None = None,
    order: str | None = None,
) -> DataFrame:
    """(label, values): the value at every axis point, the default where there is none.

    Points outside the axis are dropped, but a label that has only such points stays.
    Missing and zero values leave the default. Of several values at one point the last
    by `order` wins (any, without an order). The values are first reduced to one per
    label and point, so a label gathers at most one entry per axis point. With `within`
    every combination of these columns has its own series.
    """
    keys = [*(within or []), label]
    kind = dict(rows.dtypes)[value]
    usable = (
        F.array_contains(axis, F.col(time))
        & (F.coalesce(F.col(value), F.lit(0)) != 0)
        & ~F.coalesce(F.col(label).cast("string"), F.lit("")).isin("", "0")
    )
    usable = F.coalesce(usable, F.lit(False))
    rank = F.col(order) if order else F.lit(0)
    points = rows.groupBy(*keys, F.when(usable, F.col(time)).alias("_time")).agg(
        F.max_by(F.when(usable, F.col(value)), F.when(usable, F.struct(rank, F.col(value)))).alias(
            "_value"
        )
    )
    known = F.map_from_entries(
        F.collect_list(F.when(F.col("_time").isNotNull(), F.struct("_time", "_value")))
    )
    start = F.lit(default).cast(kind)
    return (
        points.groupBy(*keys)
        .agg(known.alias("_known"))
        .select(
            *keys,
            F.transform(axis, lambda t: F.coalesce(F.try_element_at("_known", t), start)).alias(
                "values"
            ),
        )
    )


def unpivot_series(
    rows: DataFrame,
    time: str,
    value_columns: list[str],
    axis: Column,
    default: float = 0,
    within: list[str] | None = None,
) -> DataFrame:
    """Value columns become labels, each with its series. Columns without rows stay out."""
    keys = [*(within or []), time]
    long = rows.select(
        *keys, *[F.col(c).cast("double").alias(c) for c in value_columns]
    ).unpivot(keys, value_columns, "label", "value")
    return gap_fill_series(long, "label", time, "value", axis, default, within)


def single_series(
    rows: DataFrame, time: str, value: str, axis: Column, label: str = "Values", default: float = 0
) -> DataFrame:
    return gap_fill_series(
        rows.withColumn("label", F.lit(label)), "label", time, value, axis, default
    )


def with_label_text(series: DataFrame, label: str) -> DataFrame:
    return label_lookup(series, label, "label_text")


def label_positions(rows: DataFrame, label: str, order: list[str] | None = None) -> DataFrame:
    """0-based position of each distinct label, by first appearance in the order.

    Labels that first appear at the same place share a position. Ranges of places go to
    tasks; a range is numbered by itself and starts at the number of distinct places in
    the ranges before it. One number for each range comes to the driver.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = rows.groupBy(label).agg(F.min(F.struct(*(order or [label]))).alias("_first"))
    # equal places are in one range
    ranged = cut_lineage(first.repartitionByRange(parts, "_first").withColumn("_part", F.spark_partition_id()))
    inside = F.dense_rank().over(Window.partitionBy("_part").orderBy("_first")) - 1
    counts = ranged.groupBy("_part").agg(F.count_distinct("_first").alias("n")).collect()
    before, offsets = 0, []
    for row in sorted(counts):
        offsets.append((row[0], before))
        before += row[1]
    starts = spark.createDataFrame(offsets, "_part int, _start int")
    position = (F.col("_start") + F.col("_inside")).cast("int")
    return ranged.withColumn("_inside", inside).join(F.broadcast(starts), "_part").select(label, position.alias("position"))


def labelled_table(
    rows: DataFrame, order: list[Column], count: int, currency: list[str], labels: dict[str, str]
) -> DataFrame:
    """First rows of a report with display headings and currency text."""
    top = rows.orderBy(*order).limit(count)
    return top.select(
        *[
            (table_currency(F.col(c)) if c in currency else F.col(c)).alias(labels.get(c, c))
            for c in rows.columns
        ]
    )
