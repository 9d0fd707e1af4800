"""All reports as CSV folders: general, by department, by top vendor.

Each report of the departments or vendors is one job that writes one folder per
department or vendor, instead of one query and one file for each of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contractlens import fixed_values as fixed
from contractlens.operators import reports as r
from contractlens.session import cut_lineage
from contractlens.sources.writers import with_vendor_slug, write_report

SIZES = ["original_sum_below_25k", "original_sum_above_25k"]
BANDS = ["original_sum_below_24k", "original_sum_between_24k_and_26k", "original_sum_above_26k"]


def general_reports(contracts: DataFrame, v2: DataFrame, years: r.Years) -> dict:
    """name -> (report, currency columns)."""
    span = f"{years[0]}-to-{years[1]}"
    return {
        "entries-by-department-by-year": (r.entries_by_year(contracts), []),
        "entries-by-department-by-fiscal": (r.entries_by_fiscal(contracts), []),
        "entries-by-year": (r.entries_by_year_overall(contracts), []),
        "entries-by-fiscal": (r.entries_by_fiscal_overall(contracts), []),
        "entries-errors-duplicates-by-year": (r.entries_errors_duplicates_by_year(contracts), []),
        "entries-above-and-below-25k-by-year": (r.entries_above_below_25k_by_year(contracts), SIZES),
        "entries-contracts-and-amendments-by-year": (
            r.entries_by_original_and_amendment(contracts),
            ["original_entries_sum", "most_recent_entries_sum"],
        ),
        f"effective-overall-total-by-year-{span}": (
            r.effective_overall_total_by_year(v2, years),
            ["sum_yearly_value"],
        ),
        f"effective-total-by-year-{span}": (
            r.effective_total_by_year(v2, None, years),
            ["sum_yearly_value"],
        ),
        f"largest-companies-by-effective-value-total-{span}": (
            r.largest_companies_by_value(v2, years=years),
            ["sum_effective_value"],
        ),
        f"largest-companies-by-effective-value-by-year-{span}": (
            r.largest_companies_by_value_by_year(v2, years=years),
            ["sum_yearly_value"],
        ),
        f"largest-companies-by-entries-total-{span}": (
            r.largest_companies_by_entries(contracts, years=years),
            [],
        ),
        f"largest-companies-by-entries-by-year-{span}": (
            r.largest_companies_by_entries_by_year(contracts, years=years),
            [],
        ),
    }


def department_reports(contracts: DataFrame, v2: DataFrame, years: r.Years) -> dict:
    span = f"{years[0]}-to-{years[1]}"
    return {
        f"entries-above-and-below-25k-by-year-{span}": (
            r.entries_above_below_25k_by_owner(contracts, None, years),
            SIZES,
        ),
        f"entries-in-25k-range-by-year-{span}": (
            r.entries_in_25k_range_by_owner(contracts, None, years),
            BANDS,
        ),
        f"largest-companies-by-effective-value-total-{span}": (
            r.top_companies_of_each_owner_by_value(v2, years=years),
            ["sum_effective_value"],
        ),
        f"largest-companies-by-effective-value-by-year-{span}": (
            r.top_companies_of_each_owner_by_value_by_year(v2, years=years),
            ["sum_yearly_value"],
        ),
        f"largest-companies-by-entries-total-{span}": (
            r.top_companies_of_each_owner_by_entries(contracts, years=years),
            [],
        ),
        f"largest-companies-by-entries-by-year-{span}": (
            r.top_companies_of_each_owner_by_entries_by_year(contracts, years=years),
            [],
        ),
    }


def vendor_reports(contracts: DataFrame, v2: DataFrame, years: r.Years) -> dict:
    span = f"{years[0]}-to-{years[1]}"
    by_value, by_entries = "vendor_normalized", "gen_vendor_normalized"
    reports = {
        f"largest-departments-by-effective-value-total-{span}": (
            r.departments_of_top_vendors_by_value(v2, years), by_value, ["sum_effective_value"],
        ),
        f"largest-departments-by-effective-value-by-year-{span}": (
            r.departments_of_top_vendors_by_value_by_year(v2, years), by_value, ["sum_yearly_value"],
        ),
        f"largest-departments-by-entries-total-{span}": (
            r.departments_of_top_vendors_by_entries(contracts, v2, years), by_entries, [],
        ),
        f"largest-departments-by-entries-by-year-{span}": (
            r.departments_of_top_vendors_by_entries_by_year(contracts, v2, years), by_entries, [],
        ),
    }
    return {
        name: (with_vendor_slug(report, vendor), currency)
        for name, (report, vendor, currency) in reports.items()
    }


def write_all_reports(
    contracts: DataFrame, v2: DataFrame, path: str, years: r.Years = fixed.REPORT_YEARS
) -> list[str]:
    """Write every report; returns the folders written.

    The contracts and the yearly export are read once each, into bases that hold all that
    the reports need, far narrower and shorter; the reports are made of these.
    """
    written = []
    base, values = cut_lineage(r.report_base(contracts)), cut_lineage(r.value_base(v2))
    parts = [
        ("general", general_reports(base, values, years), None),
        ("departments", department_reports(base, values, years), "owner_acronym"),
        ("vendors", vendor_reports(base, values, years), "vendor_slug"),
    ]
    for folder, reports, by in parts:
        for name, (report, currency) in reports.items():
            target = f"{path}/{folder}/{name}"
            # in each department's or vendor's folder the largest come first
            ordered = report.sortWithinPartitions(by, "rank") if by and "rank" in report.columns else report
            write_report(ordered.drop("rank"), target, currency, by)
            written.append(target)
    return written


def report_sizes(spark, folders: list[str]) -> DataFrame:
    """(report, lines): data lines found in the written folders."""
    out = None
    for folder in folders:
        lines = spark.read.option("header", True).option("recursiveFileLookup", True).csv(folder)
        counted = lines.agg(F.count(F.lit(1)).alias("lines")).select(
            F.lit("/".join(folder.split("/")[-2:])).alias("report"), "lines"
        )
        out = counted if out is None else out.unionByName(counted)
    return out
