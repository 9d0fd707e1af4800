"""Files to contract rows: bulk CSV, page records, and both together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.functions import dates
from contractlens.functions.records import reference_or
from contractlens.functions.vendor import clean_vendor_name
from contractlens.operators.flags import accepted, flag_data_errors
from contractlens.operators.lookup import owner_code, renamed_owner
from contractlens.operators.pages import record_from_fields
from contractlens.operators.grouping import numbered
from contractlens.schema import CONTRACTS, ORIGIN_CSV, ORIGIN_PAGES
from contractlens.sources.files import with_file_sequence, with_row_numbers

# ids of the two origins never meet: origin times this, plus the place in the origin
ID_SPAN = 10**15


def _id(origin: int, position: Column) -> Column:
    return (F.lit(origin).cast("bigint") * ID_SPAN + position).alias("id")


def _accepted() -> Column:
    return accepted(
        F.col("vendorName"), F.col("contractValue"), F.col("originalValue"), F.col("ownerAcronym")
    )


def _error_owner() -> Column:
    return F.when(F.col("ownerAcronym") == "", F.lit("unknown")).otherwise(
        owner_code(F.col("ownerAcronym"))
    )


def csv_records(rows: DataFrame) -> DataFrame:
    """Numbered bulk rows (fields by position) -> cleaned records."""
    value = F.when(F.col("contractValue") == "", F.col("originalValue")).otherwise(
        F.col("contractValue")
    )
    source = reference_or(F.col("sourceFiscal"), F.col("csvReferenceNumber"))
    ready = (
        rows.withColumn("contractValue", value)
        .withColumn("contractPeriodEnd", F.lit(""))
        .withColumn("sourceYear", dates.fiscal_year_of(source))
        .withColumn("sourceQuarter", dates.fiscal_quarter_of(source))
        .withColumn("ownerAcronym", owner_code(F.col("ownerAcronym")))
        .withColumn("fallbackReference", F.col("csvReferenceNumber"))
        .drop("csvReferenceNumber", "sourceFiscal", "objectCode")
    )
    name = F.regexp_extract("file_path", r"([^/]*?)(?:\.[^./]*)?$", 1)
    contract_id = F.concat(
        F.col("ownerAcronym"),
        F.lit("-csv-"),
        dates.pad_left(F.col("row_number").cast("string"), 10),
    )
    return record_from_fields(ready).select(
        "*",
        F.lit(ORIGIN_CSV).alias("sourceOrigin"),
        name.alias("sourceCsvFilename"),
        contract_id.alias("gen_contract_id"),
        _id(ORIGIN_CSV, F.col("row_number")),
    )


def _error_values(owner: Column) -> dict[str, Column]:
    """What an error row holds; all other columns are missing."""
    return {
        "id": F.col("id"),
        "owner_acronym": owner,
        "contract_value": F.lit(0.0),
        "source_origin": F.lit(ORIGIN_CSV),
        "gen_is_error": F.lit(True),
        "gen_error_via": F.lit(1),
        "row_created_at": F.current_timestamp(),
    }


def csv_error_rows(rows: DataFrame) -> DataFrame:
    """The numbered bulk rows that are not accepted, as error rows of their department."""
    values = _error_values(_error_owner())
    bad = rows.filter(~_accepted()).withColumn("id", _id(ORIGIN_CSV, F.col("row_number")))
    return bad.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CONTRACTS]
    )


def _text(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(""))


def project_contract(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Record fields to the columns of the contracts table; empty text becomes missing."""
    clean = F.col("vendorClean")
    values = {
        "id": F.col("id"),
        "json_id": _text("uuid"),
        "vendor_name": F.upper(_text("vendorName")),
        "owner_acronym": _text("ownerAcronym"),
        "contract_value": F.col("contractValue"),
        "original_value": F.col("originalValue"),
        "reference_number": _text("referenceNumber"),
        "raw_contract_date": _text("contractDate"),
        "raw_delivery_date": _text("deliveryDate"),
        "raw_contract_period_start": _text("contractPeriodStart"),
        "raw_contract_period_end": _text("contractPeriodEnd"),
        "object_code": _text("objectCode"),
        "description": _text("description"),
        "extra_description": _text("extraDescription"),
        "comments": _text("comments"),
        "source_year": F.col("sourceYear"),
        "source_quarter": F.col("sourceQuarter"),
        "source_fiscal": _text("sourceFiscal"),
        "source_origin": F.coalesce(F.col("sourceOrigin"), F.lit(ORIGIN_PAGES)),
        "source_csv_filename": F.col("sourceCsvFilename"),
        "row_created_at": F.current_timestamp(),
        "gen_start_year": F.col("startYear"),
        "gen_end_year": F.col("endYear"),
        "gen_vendor_clean": clean,
        "gen_vendor_normalized": clean,
        "gen_contract_id": F.col("gen_contract_id"),
        "gen_is_error": F.lit(False),
        "gen_error_via": F.lit(None),
    }
    return records.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in CONTRACTS], *keep
    )


def csv_contracts(raw: DataFrame) -> DataFrame:
    """Scanned bulk rows -> contract rows, and error rows for those not accepted.

    The files are parsed once for the rows and once, without fields, for their numbers.
    """
    rows = with_row_numbers(raw).withColumns(
        {"accepted": _accepted(), "errorOwner": _error_owner()}
    )
    table = project_contract(csv_records(rows), keep=("accepted", "errorOwner"))
    values = _error_values(F.col("errorOwner"))
    return table.select(
        *[
            F.when(F.col("accepted"), F.col(f.name))
            .otherwise(values.get(f.name, F.lit(None)).cast(f.dataType))
            .alias(f.name)
            for f in CONTRACTS
        ]
    )


def json_records(records: DataFrame) -> DataFrame:
    """Scanned record files -> records with typed values and ids in file order."""
    with_ids = with_file_sequence(records)
    bucket = F.concat(F.rpad("ownerAcronym", 12, " "), F.substring("file_name", 1, 3))
    ordered = numbered(with_ids, [], ["ownerAcronym", "file_name"], bucket, "place")
    typed = {
        "contractValue": F.coalesce(F.col("contractValue").try_cast("double"), F.lit(0.0)),
        "originalValue": F.coalesce(F.col("originalValue").try_cast("double"), F.lit(0.0)),
        "startYear": F.coalesce(F.col("startYear").try_cast("int"), F.lit(0)),
        "endYear": F.coalesce(F.col("endYear").try_cast("int"), F.lit(0)),
        "sourceYear": F.col("sourceYear").try_cast("int"),
        "sourceQuarter": F.col("sourceQuarter").try_cast("int"),
        "sourceOrigin": F.coalesce(F.col("sourceOrigin").try_cast("int"), F.lit(ORIGIN_PAGES)),
        "vendorClean": clean_vendor_name(F.col("vendorName")),
        "id": _id(ORIGIN_PAGES, F.col("place")),
    }
    return ordered.withColumns(typed)


def json_contracts(records: DataFrame) -> DataFrame:
    return project_contract(json_records(records))


def union_sources(*tables: DataFrame) -> DataFrame:
    """Rows of all origins in one table, told apart by source_origin."""
    out = tables[0]
    for other in tables[1:]:
        out = out.unionByName(other)
    return out


def checked(rows: DataFrame) -> DataFrame:
    """After loading: departments in use, then error codes."""
    named = rows.withColumn("owner_acronym", renamed_owner(F.col("owner_acronym")))
    return flag_data_errors(named).select(*[f.name for f in CONTRACTS])
