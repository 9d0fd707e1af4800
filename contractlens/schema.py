"""Schemas of the stored tables and input files."""

from pyspark.sql import types as T

# where a row comes from
ORIGIN_PAGES, ORIGIN_CSV = 1, 2

_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "BOOLEAN": T.BooleanType(),
    "TIMESTAMP": T.TimestampType(),
}


def _struct(text: str) -> T.StructType:
    """'name TYPE, ...' without needing a running session."""
    pairs = [field.split() for field in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


CONTRACTS = _struct(
    """
    id BIGINT, json_id STRING, vendor_name STRING, owner_acronym STRING,
    contract_value DOUBLE, original_value DOUBLE, reference_number STRING,
    raw_contract_date STRING, raw_delivery_date STRING,
    raw_contract_period_start STRING, raw_contract_period_end STRING,
    object_code STRING, description STRING, extra_description STRING, comments STRING,
    source_year INT, source_quarter INT, source_fiscal STRING, source_origin INT,
    source_csv_filename STRING, row_created_at TIMESTAMP,
    gen_start_year INT, gen_end_year INT, gen_vendor_clean STRING,
    gen_vendor_normalized STRING, gen_contract_id STRING,
    gen_is_error BOOLEAN, gen_error_via INT
    """
)

GENERATED = _struct(
    """
    gen_is_duplicate BOOLEAN, gen_duplicate_via INT, gen_duplicate_source_id BIGINT,
    gen_is_amendment BOOLEAN, gen_amendment_via INT, gen_amendment_group_id BIGINT,
    gen_effective_start_year INT, gen_effective_end_year INT,
    gen_effective_total_value DOUBLE, gen_effective_yearly_value DOUBLE,
    gen_original_value DOUBLE, gen_is_most_recent_value BOOLEAN
    """
)

RECORD_JSON = _struct(
    """
    uuid STRING, vendorName STRING, referenceNumber STRING, contractDate STRING,
    description STRING, extraDescription STRING, objectCode STRING,
    contractPeriodStart STRING, contractPeriodEnd STRING, startYear STRING,
    endYear STRING, deliveryDate STRING, originalValue STRING, contractValue STRING,
    comments STRING, ownerAcronym STRING, sourceYear STRING, sourceQuarter STRING,
    sourceFiscal STRING, sourceFilename STRING, sourceURL STRING,
    sourceOrigin STRING, sourceCsvFilename STRING
    """
)

PAGE_METADATA = _struct("sourceURL STRING, sourceYear INT, sourceQuarter INT")

VENDOR_ALIASES = _struct("parent_company STRING, company_name STRING")
