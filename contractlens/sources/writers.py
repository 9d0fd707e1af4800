"""Writers: contracts by origin and department, reports, records, aliases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.functions.money import plain_currency
from contractlens.functions.text import slug
from contractlens.operators.lookup import renormalize_vendors
from contractlens.schema import ORIGIN_CSV, ORIGIN_PAGES
from contractlens.sources import snapshots


PARTITIONS = ["source_origin", "owner_acronym"]


def replace_csv_rows(rows: DataFrame, path: str) -> None:
    """All earlier bulk rows go, whatever their department; pages' rows stay.

    Readers see the old rows until the new ones are written whole.
    """
    bulk = rows.withColumn("source_origin", F.lit(ORIGIN_CSV))
    snapshots.replace(bulk, path, PARTITIONS, lambda old, new: old[0] == f"source_origin={ORIGIN_CSV}")


def replace_owner_rows(rows: DataFrame, path: str, owners: list[str]) -> None:
    """All earlier rows of these departments go, of both origins, also of those that have
    no row now, then `rows` are added as rows from pages.

    Earlier page rows of any other department among `rows` go too. Readers see the old
    rows until the new ones are written whole; a load that fails changes nothing.
    """
    named = {snapshots.folder_name(rows.sparkSession, "owner_acronym", owner) for owner in owners}
    pages = rows.withColumn("source_origin", F.lit(ORIGIN_PAGES))
    snapshots.replace(pages, path, PARTITIONS, lambda old, new: old[1] in named or old in new)


def read_contracts(spark: SparkSession, path: str, schema) -> DataFrame:
    return snapshots.read(spark, path, schema)


def rewrite_partitions(
    spark: SparkSession, path: str, schema, touched: DataFrame, change: Callable[[DataFrame], DataFrame]
) -> int:
    """Replace the partitions named in `touched` (the partition columns) by what `change`
    makes of their rows; returns how many. The others' files stay as they are.

    Partitions are departments of an origin, so their names come to the driver.
    """
    names = {
        tuple(snapshots.folder_name(spark, column, value) for column, value in zip(PARTITIONS, row, strict=True))
        for row in touched.select(*PARTITIONS).distinct().collect()
    }
    if names:
        rows = snapshots.read(spark, path, schema, names.__contains__)
        snapshots.replace(change(rows), path, PARTITIONS, lambda old, new: old in names)
    return len(names)


def renormalize_contracts(
    spark: SparkSession, path: str, schema, table: DataFrame,
    clean: str = "gen_vendor_clean", normalized: str = "gen_vendor_normalized",
) -> int:
    """Apply changed aliases to the stored contracts, copy on write.

    Names and partition columns alone tell which departments hold a name whose parent is
    another one now; only these are rewritten. Returns the number of partitions.
    """
    names = snapshots.read(spark, path, schema).select(clean, normalized, *PARTITIONS)
    was = names.groupBy(*names.columns).agg(F.lit(1).alias("one")).withColumn("was", F.col(normalized))
    touched = renormalize_vendors(was, table, clean, normalized).filter(~F.col(normalized).eqNullSafe(F.col("was")))
    change = lambda rows: renormalize_vendors(rows, table, clean, normalized)
    return rewrite_partitions(spark, path, schema, touched, change)


def report_text(report: DataFrame, currency: list[str]) -> DataFrame:
    """Currency columns as plain two-decimal text."""
    return report.select(
        *[plain_currency(F.col(c)).alias(c) if c in currency else F.col(c) for c in report.columns]
    )


def write_report(
    report: DataFrame, path: str, currency: list[str] = (), by: str | None = None
) -> None:
    """A report as CSV with a header; values with commas are quoted.

    With `by` there is one folder per value, all written by the same job.
    """
    rows = report_text(report, list(currency))
    writer = rows.write.mode("overwrite").option("header", True).option("escape", '"')
    if by:
        writer = writer.partitionBy(by)
    writer.csv(path)


def with_vendor_slug(report: DataFrame, vendor: str) -> DataFrame:
    return report.withColumn("vendor_slug", slug(F.col(vendor)))


def write_records(records: DataFrame, path: str) -> None:
    """Records as JSON lines, one folder per department."""
    records.write.mode("overwrite").partitionBy("owner_acronym").json(path)


def write_aliases(aliases: DataFrame, path: str) -> None:
    """The sorted alias list with the headings of the alias file."""
    (
        aliases.select(
            F.col("parent_company").alias("Parent company"),
            F.col("company_name").alias("Company name"),
        )
        .write.mode("overwrite")
        .option("header", True)
        .csv(path)
    )
