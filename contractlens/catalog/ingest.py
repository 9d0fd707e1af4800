"""Reading and writing files that Spark first derives from the tables."""

from pyspark import StorageLevel
from pyspark.sql import functions as F

from contractlens import fixed_values as fixed
from contractlens.catalog.cleaning import _sql_vendor
from contractlens.catalog.inputs import derived, kept, store
from contractlens.catalog.reports import ORACLES as REPORT_ORACLES
from contractlens.catalog.reports import YEARS
from contractlens.catalog.sql_text import after
from contractlens.operators import flags, lookup, reports
from contractlens.plans import ingest, report_suite
from contractlens.session import scratch_path
from contractlens.sources import files, writers
from contractlens.sources.tables import contracts_view, table

# One bulk row per order: quotes, commas, line ends, missing parts.
BULK = """
SELECT o_orderkey AS k, 'C-' || y || '-' || cast(yy + 1 AS string) || '-Q' || q || '-' || cast(o_orderkey AS string) AS c0,
  CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'R' || cast(o_orderkey % 400 AS string) END AS c1,
  CASE o_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN c_mktsegment || ', Inc' WHEN 2 THEN '"' || c_mktsegment || '" Ltd'
    ELSE c_mktsegment || ' ' || cast(c_custkey % 7 AS string) END AS c2,
  y || '-05-06' AS c5, '1' AS c6, CASE WHEN o_orderkey % 3 = 0 THEN '514 - Rental' ELSE '1228 - ' || o_orderpriority END AS c7,
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE y || '-04-01' END AS c9,
  CASE WHEN o_orderkey % 5 = 0 THEN cast(yy + 2 AS string) || '-03-31' ELSE '' END AS c10,
  CASE o_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN '0' WHEN 2 THEN '0.00' ELSE '$' || n || '.50' END AS c11,
  CASE WHEN o_orderkey % 16 = 0 THEN '' ELSE '$' || n END AS c12,
  CASE WHEN o_orderkey % 9 = 0 THEN 'line one' || chr(10) || 'line  two' ELSE 'ok' END AS c14,
  'more, "quoted"' AS c16,
  CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE y || '-' || cast(yy + 1 AS string) || '-Q' || q END AS c40,
  CASE o_orderkey % 11 WHEN 0 THEN 'agr-aafc' WHEN 1 THEN 'pwgsc' WHEN 2 THEN '' ELSE lower(n_name) END AS c41
FROM (SELECT *, cast(year(o_orderdate) AS string) AS y, year(o_orderdate) AS yy, cast(quarter(o_orderdate) AS string) AS q,
             cast(cast(floor(o_totalprice) AS bigint) AS string) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) t"""


def _bulk_file(spark, sf):
    return kept(spark, sf, "bulk file", lambda: _write_bulk_file(spark, sf))


# Rows that one task sorts before it writes them.
SORTED_ROWS = 250_000


def _write_bulk_file(spark, sf, files_written=None, sorted_rows=SORTED_ROWS):
    """Write the derived bulk rows as CSV files in key order; returns the folder.

    The number of ranges grows with the orders, so a task's sort does not. One file is put
    together from the sorted ranges, held on disk, in their order, without another sort.
    """
    path = scratch_path(spark, "bulk")
    rows = derived(spark, sf, BULK)
    known = set(files.csv_columns())
    columns = [
        F.col(f"c{i}") if f"c{i}" in known else F.lit("").alias(f"c{i}")
        for i in range(fixed.CSV_WIDTH)
    ]
    # at least one file per core, in key order: bulk data comes as several files
    cores = spark.sparkContext.defaultParallelism
    ranges = max(cores, -(-table(spark, sf, "orders").count() // sorted_rows))
    ordered = rows.repartitionByRange(ranges, "k").sortWithinPartitions("k").select(*columns)
    if files_written != 1:
        ordered.write.option("header", True).option("escape", '"').csv(path)
        return path
    held = ordered.persist(StorageLevel.DISK_ONLY)
    held.count()
    held.coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    held.unpersist()
    return path


def scan_contract_csv(spark, sf):
    raw = files.scan_contract_csv(spark, _bulk_file(spark, sf))
    return files.with_row_numbers(raw).drop("file_path")


def scan_one_contract_csv(spark, sf):
    """The bulk rows as one file, cut into ranges."""
    path = kept(spark, sf, "one bulk file", lambda: _write_bulk_file(spark, sf, 1))
    return files.with_row_numbers(files.scan_contract_csv(spark, path)).drop("file_path")


def csv_contracts(spark, sf):
    rows = ingest.csv_contracts(files.scan_contract_csv(spark, _bulk_file(spark, sf)))
    return ingest.checked(rows).drop("row_created_at", "source_csv_filename")


def reject_incomplete_rows(spark, sf):
    raw = files.scan_contract_csv(spark, _bulk_file(spark, sf))
    return flags.reject_incomplete_rows(raw).select("csvReferenceNumber")


def error_rows(spark, sf):
    raw = files.scan_contract_csv(spark, _bulk_file(spark, sf))
    rows = ingest.csv_error_rows(files.with_row_numbers(raw))
    return rows.select("id", "owner_acronym", "contract_value", "gen_is_error", "gen_error_via")


def latest_file(spark, sf):
    """Name of the newest CSV of a folder that two jobs wrote one after the other."""
    path = scratch_path(spark, "latest")
    orders = table(spark, sf, "orders").select("o_orderkey")
    for name in ("a", "b"):
        orders.write.option("header", True).mode("overwrite").csv(f"{path}/{name}")
    found = files.latest_file(spark, f"{path}/*")
    return found.select(F.regexp_extract("path", r"/(a|b)/[^/]*\.csv$", 1).alias("folder"))


RECORDS = """
SELECT md5(cast(o_orderkey AS string)) AS name, lower(n_name) AS "ownerAcronym", lower(n_name) || '-R' || cast(o_orderkey AS string) AS uuid,
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'Acme ' || cast(o_custkey % 9 AS string) || ' Ltd' END AS "vendorName",
  'R' || cast(o_orderkey AS string) AS "referenceNumber", floor(o_totalprice) + 0.5 AS "contractValue",
  CASE WHEN o_orderkey % 3 = 0 THEN 0.0 ELSE floor(o_totalprice) END AS "originalValue",
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '' || o_orderpriority END AS description,
  year(o_orderdate) AS "sourceYear", quarter(o_orderdate) AS "sourceQuarter",
  CASE WHEN o_orderkey % 6 = 0 THEN 'false' ELSE cast(year(o_orderdate) AS string) END AS "startYear", o_orderkey AS k
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def _record_rows(spark, sf):
    rows = derived(spark, sf, RECORDS.replace('"', "`"))
    return rows.withColumn(
        "startYear", F.when(F.col("startYear") != "false", F.col("startYear")).otherwise("false")
    )


def _record_files(spark, sf):
    return kept(spark, sf, "record files", lambda: _write_record_files(spark, sf))


def _write_record_files(spark, sf):
    """Record files in owner folders. JSON lines: one object a line, named by line.

    A writing task sorts its rows by folder; the rebalance keeps its share, and so this
    sort, the same size however many records there are.
    """
    path = scratch_path(spark, "records")
    rows = _record_rows(spark, sf).drop("k")
    named = rows.withColumn("sourceFilename", F.col("name")).drop("name").withColumn("owner", F.col("ownerAcronym"))
    named.hint("rebalance", "owner").write.partitionBy("owner").json(path)
    return path


def _scanned_records(spark, sf):
    # the derived files hold many records each, so the record names its own file
    scanned = files.scan_contract_json(spark, _record_files(spark, sf), one_per_file=False)
    return scanned.withColumn("file_name", F.concat("sourceFilename", F.lit(".json")))


def scan_contract_json(spark, sf):
    return _scanned_records(spark, sf).select(
        "uuid", "vendorName", "contractValue", "sourceYear", "startYear", "file_name"
    )


def file_sequence_id(spark, sf):
    rows = files.with_file_sequence(_scanned_records(spark, sf))
    return rows.select("uuid", "file_sequence", "gen_contract_id")


def json_contracts(spark, sf):
    rows = ingest.checked(ingest.json_contracts(_scanned_records(spark, sf)))
    return rows.select(
        "id", "json_id", "vendor_name", "owner_acronym", "contract_value", "original_value",
        "reference_number", "description", "source_year", "source_quarter", "source_origin",
        "gen_start_year", "gen_vendor_clean", "gen_contract_id", "gen_is_error", "gen_error_via",
    )


def default_fields(spark, sf):
    rows = _record_rows(spark, sf).select("name", "vendorName", "description")
    return flags.default_fields(rows)


def drop_work_columns(spark, sf):
    rows = derived(
        spark, sf, "SELECT o_orderkey AS id, 1 AS `yearsDuration`, o_totalprice AS `valuePerYear` FROM orders"
    )
    return flags.drop_work_columns(rows)


def scan_vendor_aliases(spark, sf):
    """The alias list written as a file, read back and reduced to one parent per name."""
    path = scratch_path(spark, "aliases")
    source = derived(
        spark,
        sf,
        "SELECT c_mktsegment || ', ' || cast(c_custkey % 3 AS string) AS parent_company, c_name AS company_name FROM customer",
    )
    writers.write_aliases(lookup.sorted_aliases(source), path)
    read = files.scan_vendor_aliases(spark, path)
    return lookup.alias_table(read)


def union_sources(spark, sf):
    csv = ingest.csv_contracts(files.scan_contract_csv(spark, _bulk_file(spark, sf)))
    pages = ingest.json_contracts(_scanned_records(spark, sf))
    both = ingest.checked(ingest.union_sources(pages, csv))
    return both.groupBy("source_origin", "owner_acronym").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if("gen_is_error").alias("errors"),
        F.round(F.sum("contract_value"), 2).alias("total_value"),
    )


def write_contracts(spark, sf):
    """Page rows for all, bulk rows replaced, then one department loaded again."""
    path = scratch_path(spark, "contracts")
    rows = contracts_view(spark, sf)
    pages = rows.filter("source_origin = 1")
    writers.replace_owner_rows(pages, path, [])
    writers.replace_csv_rows(rows.filter("source_origin = 2"), path)
    again = pages.filter("owner_acronym = 'nation_3'").withColumn("contract_value", F.lit(1.0))
    writers.replace_owner_rows(again, path, ["nation_3"])
    writers.replace_csv_rows(rows.filter("source_origin = 2 and owner_acronym <> 'nation_4'"), path)
    return writers.read_contracts(spark, path, rows.schema).select(
        "id", "owner_acronym", "source_origin", "contract_value"
    )


def write_analysis_csv(spark, sf):
    path = scratch_path(spark, "report")
    v2 = store(spark, sf)["exports_v2"]
    report = reports.effective_overall_total_by_year(v2, YEARS)
    writers.write_report(report, path, ["sum_yearly_value"])
    return spark.read.schema("effective_year int, sum_yearly_value string").option("header", True).csv(path)


def write_partitioned_reports(spark, sf):
    """One folder per department, written by one job and read back as text."""
    path = scratch_path(spark, "by-owner")
    report = reports.entries_above_below_25k_by_owner(store(spark, sf)["contracts"], None, YEARS)
    money = ["original_sum_below_25k", "original_sum_above_25k"]
    writers.write_report(report, path, money, by="owner_acronym")
    schema = (
        "source_year int, total_original_entries bigint, entries_below_25k bigint, "
        "entries_above_25k bigint, original_sum_below_25k string, original_sum_above_25k string, "
        "owner_acronym string"
    )
    return spark.read.schema(schema).option("header", True).csv(path)


def write_json_records(spark, sf):
    path = scratch_path(spark, "json")
    rows = contracts_view(spark, sf)
    writers.write_records(rows, path)
    return spark.read.schema(rows.schema).json(path).select(
        "id", "owner_acronym", "contract_value", "source_fiscal", "vendor_name"
    )


def write_all_reports(spark, sf):
    """Every report written as CSV; the number of lines of each."""
    tables = store(spark, sf)
    path = scratch_path(spark, "reports")
    folders = report_suite.write_all_reports(tables["contracts"], tables["exports_v2"], path, YEARS)
    return report_suite.report_sizes(spark, folders)


QUERIES = {
    "write_all_reports": write_all_reports,
    "scan_contract_csv": scan_contract_csv,
    "scan_one_contract_csv": scan_one_contract_csv,
    "import_contract_csv": csv_contracts,
    "reject_incomplete_rows": reject_incomplete_rows,
    "error_rows": error_rows,
    "latest_file": latest_file,
    "scan_contract_json": scan_contract_json,
    "file_sequence_id": file_sequence_id,
    "project_contract": json_contracts,
    "default_fields": default_fields,
    "drop_work_columns": drop_work_columns,
    "scan_vendor_aliases": scan_vendor_aliases,
    "union_sources": union_sources,
    "write_contracts": write_contracts,
    "write_analysis_csv": write_analysis_csv,
    "write_partitioned_reports": write_partitioned_reports,
    "write_json_records": write_json_records,
}

_BULK_ROWS = f"""
bulk AS (SELECT *, row_number() OVER (ORDER BY k) + 1 AS rn,
  c2 NOT IN ('', '0') AND c41 NOT IN ('', '0')
   AND CASE WHEN c11 = '' THEN c12 NOT IN ('', '0') ELSE c11 <> '0' END AS good,
  CASE WHEN c41 = '' THEN 'unknown' WHEN c41 = 'agr-aafc' THEN 'agr' WHEN c41 = 'pwgsc' THEN 'pspc' ELSE c41 END AS owner
 FROM ({BULK}))"""

_MONEY = "cast(replace(nullif({}, ''), '$', '') AS double)"

_CSV_CONTRACTS = f"""
csv_rows AS (
SELECT 2000000000000000 + rn AS id, owner || '-' || CASE WHEN c1 = '' THEN c0 ELSE c1 END AS json_id,
 upper(c2) AS vendor_name, owner AS owner_acronym,
 CASE WHEN c11 NOT IN ('', '0.00') THEN {_MONEY.format('c11')} ELSE coalesce({_MONEY.format('c12')}, 0) END AS contract_value,
 coalesce({_MONEY.format('c12')}, 0) AS original_value, CASE WHEN c1 = '' THEN c0 ELSE c1 END AS reference_number,
 c5 AS raw_contract_date, nullif(c10, '') AS raw_delivery_date, nullif(c9, '') AS raw_contract_period_start,
 cast(NULL AS string) AS raw_contract_period_end, CASE WHEN c7 LIKE '514%' THEN '0514' ELSE '1228' END AS object_code,
 c7 AS description, c16 AS extra_description, CASE WHEN c14 = 'ok' THEN 'ok' ELSE 'line one line two' END AS comments,
 cast(substr(c5, 1, 4) AS int) AS source_year, cast(regexp_extract(c0, 'Q([0-9])', 1) AS int) AS source_quarter,
 substr(c5, 1, 4) || CASE WHEN (substr(c5, 1, 4)::int % 100) + 1 < 10 THEN '0' ELSE '' END
   || cast((substr(c5, 1, 4)::int % 100) + 1 AS string) || '-Q' || regexp_extract(c0, 'Q([0-9])', 1) AS source_fiscal,
 2 AS source_origin, cast(substr(c5, 1, 4) AS int) AS gen_start_year,
 cast(substr(CASE WHEN c10 <> '' THEN c10 ELSE c5 END, 1, 4) AS int) AS gen_end_year,
 {_sql_vendor('c2')} AS gen_vendor_clean, {_sql_vendor('c2')} AS gen_vendor_normalized,
 owner || '-csv-' || lpad(cast(rn AS string), 10, '0') AS gen_contract_id
FROM bulk WHERE good),
csv_all AS (
SELECT *, contract_value = 0 AS gen_is_error, cast(CASE WHEN contract_value = 0 THEN 3 END AS int) AS gen_error_via FROM csv_rows
UNION ALL BY NAME
SELECT 2000000000000000 + rn AS id, owner AS owner_acronym, 0.0::double AS contract_value, 2 AS source_origin, true AS gen_is_error, 1 AS gen_error_via
FROM bulk WHERE NOT good)"""

_JSON_ROWS = f"""
recs AS (SELECT *, row_number() OVER (PARTITION BY "ownerAcronym" ORDER BY name) AS seq,
  row_number() OVER (ORDER BY rpad("ownerAcronym", 12, ' '), name) AS place FROM ({RECORDS})),
json_rows AS (SELECT 1000000000000000 + place AS id, uuid AS json_id, upper(nullif("vendorName", '')) AS vendor_name,
 "ownerAcronym" AS owner_acronym, cast("contractValue" AS double) AS contract_value, cast("originalValue" AS double) AS original_value,
 "referenceNumber" AS reference_number, nullif(description, '') AS description, cast("sourceYear" AS int) AS source_year,
 cast("sourceQuarter" AS int) AS source_quarter, 1 AS source_origin, coalesce(try_cast("startYear" AS int), 0) AS gen_start_year,
 {_sql_vendor('"vendorName"')} AS gen_vendor_clean,
 "ownerAcronym" || '-' || lpad(cast(seq AS string), 10, '0') AS gen_contract_id,
 true AS gen_is_error, 2 AS gen_error_via FROM recs)"""

ORACLES = {
    "scan_contract_csv": f"""WITH {_BULK_ROWS} SELECT c0 AS "csvReferenceNumber", c1 AS "referenceNumber", c2 AS "vendorName", c5 AS "contractDate",
 c6 AS "objectCode", c7 AS description, c9 AS "contractPeriodStart", c10 AS "deliveryDate", c11 AS "contractValue", c12 AS "originalValue",
 c14 AS comments, c16 AS "extraDescription", c40 AS "sourceFiscal", c41 AS "ownerAcronym", rn AS row_number FROM bulk""",
    "import_contract_csv": f"WITH {_BULK_ROWS},{_CSV_CONTRACTS} SELECT * FROM csv_all",
    "reject_incomplete_rows": f'WITH {_BULK_ROWS} SELECT c0 AS "csvReferenceNumber" FROM bulk WHERE good',
    "error_rows": f"WITH {_BULK_ROWS},{_CSV_CONTRACTS} SELECT id, owner_acronym, contract_value, gen_is_error, gen_error_via FROM csv_all WHERE gen_error_via = 1",
    "latest_file": "SELECT 'b' AS folder FROM orders LIMIT 1",
    "scan_contract_json": f"""SELECT uuid, "vendorName", cast(cast("contractValue" AS decimal(18, 1)) AS string) AS "contractValue",
 cast("sourceYear" AS string) AS "sourceYear", "startYear", name || '.json' AS file_name FROM ({RECORDS})""",
    "file_sequence_id": f"""WITH {_JSON_ROWS} SELECT uuid, seq AS file_sequence, "ownerAcronym" || '-' || lpad(cast(seq AS string), 10, '0') AS gen_contract_id FROM recs""",
    "project_contract": f"WITH {_JSON_ROWS} SELECT * FROM json_rows",
    "default_fields": f"""SELECT name, nullif("vendorName", '') AS "vendorName", nullif(description, '') AS description, 1 AS "sourceOrigin" FROM ({RECORDS})""",
    "drop_work_columns": "SELECT o_orderkey AS id FROM orders",
    "scan_vendor_aliases": """SELECT upper(replace(c_name, '#', '')) AS vendor_clean,
 c_mktsegment || ' ' || cast(c_custkey % 3 AS string) AS parent FROM customer""",
    "union_sources": f"""WITH {_BULK_ROWS},{_CSV_CONTRACTS},{_JSON_ROWS}
 SELECT source_origin, owner_acronym, count(*) AS entries, count(*) FILTER (WHERE gen_is_error) AS errors, round(sum(contract_value), 2) AS total_value
 FROM (SELECT source_origin, owner_acronym, gen_is_error, contract_value FROM csv_all UNION ALL
       SELECT source_origin, owner_acronym, gen_is_error, contract_value FROM json_rows) GROUP BY 1, 2""",
    "write_analysis_csv": "SELECT effective_year, printf('%.2f', sum_yearly_value) AS sum_yearly_value FROM ("
    + REPORT_ORACLES["effective_overall_total_by_year"]
    + ")",
    "write_partitioned_reports": "SELECT * REPLACE (printf('%.2f', coalesce(original_sum_below_25k, 0)) AS original_sum_below_25k, "
    "printf('%.2f', coalesce(original_sum_above_25k, 0)) AS original_sum_above_25k) FROM ("
    + REPORT_ORACLES["entries_above_below_25k_of_all_owners"]
    + ")",
}


ORACLES["scan_one_contract_csv"] = ORACLES["scan_contract_csv"]


def _contracts_sql(select):
    return after("contracts", select)


_SPAN = f"{YEARS[0]}-to-{YEARS[1]}"
_REPORT_LINES = {
    "general/entries-by-department-by-year": "entries_by_year",
    "general/entries-by-department-by-fiscal": "entries_by_fiscal",
    "general/entries-by-year": "entries_by_year_overall",
    "general/entries-by-fiscal": "entries_by_fiscal_overall",
    "general/entries-errors-duplicates-by-year": "entries_errors_duplicates_by_year",
    "general/entries-above-and-below-25k-by-year": "entries_above_below_25k_by_year",
    "general/entries-contracts-and-amendments-by-year": "entries_by_original_and_amendment",
    f"general/effective-overall-total-by-year-{_SPAN}": "effective_overall_total_by_year",
    f"general/effective-total-by-year-{_SPAN}": "effective_total_by_year",
    f"general/largest-companies-by-effective-value-total-{_SPAN}": "SELECT vendor_normalized FROM v2 WHERE in_years GROUP BY 1 LIMIT 200",
    f"general/largest-companies-by-effective-value-by-year-{_SPAN}": "largest_companies_by_value_by_year",
    f"general/largest-companies-by-entries-total-{_SPAN}": "SELECT gen_vendor_normalized FROM enriched WHERE valid_years GROUP BY 1 LIMIT 200",
    f"general/largest-companies-by-entries-by-year-{_SPAN}": "largest_companies_by_entries_by_year",
    f"departments/entries-above-and-below-25k-by-year-{_SPAN}": "entries_above_below_25k_of_all_owners",
    f"departments/entries-in-25k-range-by-year-{_SPAN}": "entries_in_25k_range_of_all_owners",
    f"departments/largest-companies-by-effective-value-total-{_SPAN}": "SELECT DISTINCT owner_acronym, vendor_normalized FROM v2 WHERE in_years",
    f"departments/largest-companies-by-effective-value-by-year-{_SPAN}": "topk_per_owner_by_year",
    f"departments/largest-companies-by-entries-total-{_SPAN}": "SELECT DISTINCT owner_acronym, gen_vendor_normalized FROM enriched WHERE valid_years",
    f"departments/largest-companies-by-entries-by-year-{_SPAN}": "topk_per_owner_by_entries_by_year",
    f"vendors/largest-departments-by-effective-value-total-{_SPAN}": "departments_of_top_vendors_by_value",
    f"vendors/largest-departments-by-effective-value-by-year-{_SPAN}": "departments_of_top_vendors_by_value_by_year",
    f"vendors/largest-departments-by-entries-total-{_SPAN}": "departments_of_top_vendors_by_entries",
    f"vendors/largest-departments-by-entries-by-year-{_SPAN}": "departments_of_top_vendors_by_entries_by_year",
}


def _lines_sql():
    """Lines of each report, by the SQL of the report or of its keys alone."""
    between = f"BETWEEN {YEARS[0]} AND {YEARS[1]}"
    parts = []
    for report, source in _REPORT_LINES.items():
        sql = REPORT_ORACLES.get(source)
        if sql is None:
            sql = after(
                "exports",
                source.replace("in_years", f"effective_year {between}").replace(
                    "valid_years", f"NOT gen_is_duplicate AND NOT gen_is_error AND source_year {between}"
                ),
            )
        parts.append(f"SELECT '{report}' AS report, count(*) AS lines FROM ({sql})")
    return " UNION ALL ".join(parts)


ORACLES["write_all_reports"] = _lines_sql()
ORACLES["write_contracts"] = _contracts_sql(
    """SELECT id, owner_acronym, source_origin, CASE WHEN owner_acronym = 'nation_3' AND source_origin = 1 THEN 1.0 ELSE contract_value END AS contract_value
 FROM contracts WHERE source_origin = 1 OR owner_acronym <> 'nation_4'"""
)
ORACLES["write_json_records"] = _contracts_sql(
    "SELECT id, owner_acronym, contract_value, source_fiscal, vendor_name FROM contracts"
)
