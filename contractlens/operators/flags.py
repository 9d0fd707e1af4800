"""Row rules: rejection, error codes, validity, ranges, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens import fixed_values as fixed
from contractlens.functions.money import truthy
from contractlens.schema import GENERATED


def default_fields(rows: DataFrame) -> DataFrame:
    """Empty text becomes missing; a missing origin is 1 (pages)."""
    out = rows.select(
        *[
            F.nullif(F.col(name), F.lit("")).alias(name) if kind == "string" else F.col(name)
            for name, kind in rows.dtypes
        ]
    )
    if "sourceOrigin" not in out.columns:
        return out.withColumn("sourceOrigin", F.lit(1))
    return out.withColumn("sourceOrigin", F.coalesce(F.col("sourceOrigin"), F.lit(1)))


def accepted(vendor: Column, value: Column, original: Column, owner: Column) -> Column:
    """A bulk row needs a vendor, a value (or an original value) and a department."""
    has_value = F.when(F.coalesce(value, F.lit("")) == "", truthy(original)).otherwise(truthy(value))
    return truthy(vendor) & has_value & truthy(owner)


def reject_incomplete_rows(rows: DataFrame) -> DataFrame:
    return rows.filter(
        accepted(
            F.col("vendorName"), F.col("contractValue"), F.col("originalValue"), F.col("ownerAcronym")
        )
    )


def error_code(
    rows: DataFrame, manual_ids: list[str] = fixed.MANUAL_ERROR_CONTRACT_IDS
) -> Column:
    """4 for ids flagged by hand, else the earlier code, else 2 or 3 by content."""
    earlier = F.col("gen_error_via") if "gen_error_via" in rows.columns else F.lit(None).cast("int")
    contract_id = (
        F.col("gen_contract_id") if "gen_contract_id" in rows.columns else F.lit(None).cast("string")
    )
    return (
        F.when(contract_id.isin(manual_ids), 4)
        .when(earlier.isNotNull(), earlier)
        .when(F.col("source_fiscal").isNull(), 2)
        .when(F.col("contract_value") == 0, 3)
        .cast("int")
    )


def flag_data_errors(
    rows: DataFrame, manual_ids: list[str] = fixed.MANUAL_ERROR_CONTRACT_IDS
) -> DataFrame:
    kept = [c for c in rows.columns if c not in ("gen_is_error", "gen_error_via")]
    via = error_code(rows, manual_ids)
    return rows.select(*kept, via.isNotNull().alias("gen_is_error"), via.alias("gen_error_via"))


def valid_entries(rows: DataFrame, present: str = "source_fiscal") -> DataFrame:
    """Neither duplicate nor error, and dated."""
    return rows.filter(
        F.col(present).isNotNull() & ~F.col("gen_is_duplicate") & ~F.col("gen_is_error")
    )


def year_range(
    rows: DataFrame, column: str, years: tuple[int, int] = fixed.REPORT_YEARS
) -> DataFrame:
    """Both ends included."""
    return rows.filter(F.col(column).between(*years))


def equals_if_given(rows: DataFrame, column: str, value: str | None) -> DataFrame:
    """Optional department or vendor filter; prunes partitions when the column is one."""
    return rows.filter(F.col(column) == value) if value else rows


def drop_work_columns(rows: DataFrame) -> DataFrame:
    return rows.drop("contractPeriodRange", "amendedValues", "yearsDuration", "valuePerYear")


def reset_generated(rows: DataFrame) -> DataFrame:
    """The same rows with every derived flag and value cleared."""
    kept = [F.col(c) for c in rows.columns if c not in GENERATED.names]
    cleared = [
        (F.lit(False) if f.dataType.typeName() == "boolean" else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in GENERATED
    ]
    return rows.select(*kept, *cleared)
