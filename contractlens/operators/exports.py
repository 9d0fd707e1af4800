"""The two export tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlens.operators.flags import valid_entries

TEXT_COLUMNS = ["object_code", "description", "extra_description", "comments"]

V1_NAMES = {
    "gen_vendor_clean": "vendor_clean",
    "gen_vendor_normalized": "vendor_normalized",
    "owner_acronym": "owner_acronym",
    "gen_effective_total_value": "effective_total_value",
    "gen_effective_yearly_value": "effective_yearly_value",
    "original_value": "original_value",
    "gen_effective_start_year": "effective_start_year",
    "gen_effective_end_year": "effective_end_year",
    "source_fiscal": "source_fiscal",
    "source_year": "source_year",
    "source_quarter": "source_quarter",
    "source_origin": "source_origin",
    "gen_is_most_recent_value": "is_most_recent_value",
    "gen_is_amendment": "is_amendment",
    "gen_amendment_group_id": "amendment_group_id",
    "reference_number": "reference_number",
}


def exports_v1(contracts: DataFrame) -> DataFrame:
    """Valid entries with their effective values: a filter and a projection."""
    columns = [
        F.col(old).cast("int").alias(new) if new.startswith("is_") else F.col(old).alias(new)
        for old, new in V1_NAMES.items()
        if old in contracts.columns
    ]
    text = [c for c in TEXT_COLUMNS if c in contracts.columns]
    return valid_entries(contracts).select(*columns, *text)


def exports_v2(v1: DataFrame) -> DataFrame:
    """One row per entry and effective year."""
    start, end = F.col("effective_start_year"), F.col("effective_end_year")
    known = (F.coalesce(start, F.lit(0)) != 0) & (F.coalesce(end, F.lit(0)) != 0)
    dropped = (
        "effective_start_year",
        "effective_end_year",
        "effective_total_value",
        "effective_yearly_value",
        "original_value",
        "is_most_recent_value",
    )
    kept = [c for c in v1.columns if c not in dropped]
    return v1.filter(known).select(
        *kept,
        F.col("effective_yearly_value").alias("yearly_value"),
        F.explode(F.sequence(start, end)).alias("effective_year"),
    )
