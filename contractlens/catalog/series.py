"""Chart-ready series of the reports."""

from pyspark.sql import functions as F

from contractlens import fixed_values as fixed
from contractlens.catalog.inputs import store
from contractlens.catalog.reports import ORACLES as REPORTS
from contractlens.catalog.reports import YEARS
from contractlens.catalog.sql_text import after
from contractlens.functions import dates
from contractlens.operators import reports, series
from contractlens.operators.lookup import pairs

AXIS = (YEARS[0] - 1, YEARS[1] - 2)  # cuts points off at both ends


def gap_fill_series(spark, sf):
    """Departments by year; the axis leaves years out and has years without entries."""
    rows = reports.entries_by_year(store(spark, sf)["contracts"])
    out = series.gap_fill_series(
        rows, "owner_acronym", "source_year", "total_entries", dates.year_axis(AXIS)
    )
    return _long(out, "owner_acronym")


def gap_fill_fiscal(spark, sf):
    rows = reports.entries_by_fiscal(store(spark, sf)["contracts"])
    axis = dates.fiscal_axis((1996, 1998))
    out = series.gap_fill_series(rows, "owner_acronym", "source_fiscal", "total_entries", axis)
    return _long(out, "owner_acronym")


def unpivot_series(spark, sf):
    rows = reports.entries_by_year_overall(store(spark, sf)["contracts"])
    out = series.unpivot_series(
        rows, "source_year", ["total_contracts", "total_amendments"], dates.year_axis(AXIS)
    )
    return _long(series.with_label_text(out, "label"), "label", "label_text")


def year_axis(spark, sf):
    """Axis points next to the entries found at them."""
    axis = series.axis_table(spark, dates.year_axis(YEARS), "year")
    counts = store(spark, sf)["contracts"].groupBy("source_year").agg(F.count("id").alias("entries"))
    return axis.join(counts, F.col("year") == F.col("source_year"), "left").select(
        "position", "year", "entries"
    )


def fiscal_axis(spark, sf):
    axis = series.axis_table(spark, dates.fiscal_axis((1994, 2003)), "fiscal")
    counts = store(spark, sf)["contracts"].groupBy("source_fiscal").agg(F.count("id").alias("entries"))
    return axis.join(counts, F.col("fiscal") == F.col("source_fiscal"), "left").select(
        "position", "fiscal", "entries"
    )


def labelled_table(spark, sf):
    rows = reports.largest_companies_by_value(store(spark, sf)["exports_v2"], None, 200, YEARS)
    order = [F.desc_nulls_first("sum_effective_value"), F.asc("vendor_normalized")]
    labels = pairs(fixed.DISPLAY_LABELS)
    return series.labelled_table(rows, order, 10, ["sum_effective_value"], labels)


def single_series(spark, sf):
    rows = reports.effective_overall_total_by_year(store(spark, sf)["exports_v2"], YEARS)
    out = series.single_series(rows, "effective_year", "sum_yearly_value", dates.year_axis(YEARS))
    return _long(out, "label")


def label_positions(spark, sf):
    rows = reports.entries_by_year(store(spark, sf)["contracts"])
    return series.label_positions(rows, "owner_acronym")


def owner_dashboard(spark, sf):
    """Four series of every department in one job, with the label inside the department."""
    tables = store(spark, sf)
    axis = dates.year_axis(YEARS)
    vendors = series.gap_fill_series(
        reports.top_companies_of_each_owner_by_entries_by_year(tables["contracts"], 10, YEARS),
        "gen_vendor_normalized", "source_year", "total_entries", axis, within=["owner_acronym"],
    )
    sizes = series.unpivot_series(
        reports.entries_above_below_25k_by_owner(tables["contracts"], None, YEARS),
        "source_year", ["entries_below_25k", "entries_above_25k"], axis, within=["owner_acronym"],
    )
    value = series.gap_fill_series(
        reports.top_companies_of_each_owner_by_value_by_year(tables["exports_v2"], 10, YEARS),
        "vendor_normalized", "effective_year", "sum_yearly_value", axis, within=["owner_acronym"],
    )
    total = series.gap_fill_series(
        reports.effective_total_by_year(tables["exports_v2"], None, YEARS).withColumn(
            "label", F.col("owner_acronym")
        ),
        "label", "effective_year", "sum_yearly_value", axis, within=["owner_acronym"],
    )
    parts = [
        ("companies by entries", vendors, "gen_vendor_normalized"),
        ("entries by size", sizes, "label"),
        ("companies by value", value, "vendor_normalized"),
        ("total value", total, "label"),
    ]
    out = None
    for chart, part, label in parts:
        rows = part.select(
            "owner_acronym",
            F.lit(chart).alias("chart"),
            F.col(label).alias("label"),
            F.col("values").cast("array<double>").alias("values"),
        )
        out = rows if out is None else out.unionByName(rows)
    return _long(out, "owner_acronym", "chart", "label")


def vendor_dashboard(spark, sf):
    """Two series of every top vendor in one job."""
    tables = store(spark, sf)
    axis = dates.year_axis(YEARS)
    entries = series.gap_fill_series(
        reports.departments_of_top_vendors_by_entries_by_year(
            tables["contracts"], tables["exports_v2"], YEARS
        ),
        "owner_acronym", "source_year", "total_entries", axis, within=["gen_vendor_normalized"],
    ).select(
        F.col("gen_vendor_normalized").alias("vendor"),
        F.lit("departments by entries").alias("chart"),
        F.col("owner_acronym").alias("label"),
        F.col("values").cast("array<double>").alias("values"),
    )
    value = series.gap_fill_series(
        reports.departments_of_top_vendors_by_value_by_year(tables["exports_v2"], YEARS),
        "owner_acronym", "effective_year", "sum_yearly_value", axis, within=["vendor_normalized"],
    ).select(
        F.col("vendor_normalized").alias("vendor"),
        F.lit("departments by value").alias("chart"),
        F.col("owner_acronym").alias("label"),
        "values",
    )
    return _long(entries.unionByName(value), "vendor", "chart", "label")


def _long(rows, *keys):
    """Arrays as rows, so that both engines compare plain values."""
    return rows.select(*keys, F.posexplode("values").alias("position", "value"))


QUERIES = {
    "gap_fill_series": gap_fill_series,
    "gap_fill_fiscal_series": gap_fill_fiscal,
    "unpivot_series": unpivot_series,
    "year_axis": year_axis,
    "fiscal_axis": fiscal_axis,
    "labelled_table": labelled_table,
    "single_series": single_series,
    "dense_color_index": label_positions,
    "owner_dashboard": owner_dashboard,
    "vendor_dashboard": vendor_dashboard,
}


def _years(axis):
    return f"SELECT yr - {axis[0]} AS position, yr FROM (SELECT unnest(generate_series({axis[0]}, {axis[1]})) AS yr)"


def _fiscals(first, last):
    return (
        f"SELECT cast((yr - {first}) * 4 + q - 1 AS int) AS position, cast(yr AS string) || lpad(cast((yr + 1) % 100 AS string), 2, '0') "
        f"|| '-Q' || cast(q AS string) AS fiscal FROM (SELECT unnest(generate_series({first}, {last})) AS yr), (SELECT unnest(generate_series(1, 4)) AS q)"
    )


def _filled(report, keys, time, value, axis, kind="bigint"):
    """Every label at every year of the axis, by joins."""
    on = " AND ".join(f"r.{k} = l.{k}" for k in keys.split(", "))
    listed = ", ".join(f"l.{k}" for k in keys.split(", "))
    return (
        f"SELECT {listed}, cast(a.position AS int) AS position, coalesce(cast(r.{value} AS {kind}), 0) AS value "
        f"FROM (SELECT DISTINCT {keys} FROM ({report})) l CROSS JOIN ({_years(axis)}) a "
        f"LEFT JOIN ({report}) r ON {on} AND r.{time} = a.yr"
    )


def _renamed(filled, select):
    return f"SELECT {select}, position, cast(value AS double) AS value FROM ({filled})"


_OVERALL = REPORTS["entries_by_year_overall"]
_ALL_SIZES = REPORTS["entries_above_below_25k_of_all_owners"]
ORACLES = {
    "gap_fill_series": _filled(REPORTS["entries_by_year"], "owner_acronym", "source_year", "total_entries", AXIS),
    "gap_fill_fiscal_series": f"""SELECT l.owner_acronym, a.position, coalesce(r.total_entries, 0) AS value
 FROM (SELECT DISTINCT owner_acronym FROM ({REPORTS['entries_by_fiscal']})) l CROSS JOIN ({_fiscals(1996, 1998)}) a
 LEFT JOIN ({REPORTS['entries_by_fiscal']}) r ON r.owner_acronym = l.owner_acronym AND r.source_fiscal = a.fiscal""",
    "unpivot_series": f"""SELECT label, label_text, cast(a.position AS int) AS position, cast(coalesce(v, 0) AS double) AS value FROM
 (SELECT 'total_contracts' AS label, 'Total contracts' AS label_text UNION ALL SELECT 'total_amendments', 'Total amendments') l
 CROSS JOIN ({_years(AXIS)}) a LEFT JOIN (
  SELECT source_year, 'total_contracts' AS lab, total_contracts AS v FROM ({_OVERALL}) UNION ALL
  SELECT source_year, 'total_amendments', total_amendments FROM ({_OVERALL})) r ON r.lab = l.label AND r.source_year = a.yr""",
    "year_axis": after(
        "contracts",
        f"""SELECT cast(a.position AS int) AS position, cast(a.yr AS int) AS year, c.entries FROM ({_years(YEARS)}) a
 LEFT JOIN (SELECT source_year, count(*) AS entries FROM contracts GROUP BY 1) c ON c.source_year = a.yr""",
    ),
    "fiscal_axis": after(
        "contracts",
        f"""SELECT a.position, a.fiscal, c.entries FROM ({_fiscals(1994, 2003)}) a
 LEFT JOIN (SELECT source_fiscal, count(*) AS entries FROM contracts GROUP BY 1) c ON c.source_fiscal = a.fiscal""",
    ),
    "labelled_table": f"""SELECT vendor_normalized AS "Company name", '$ ' || format('{{:,.2f}}', sum_effective_value) AS "Total effective value (2010 to 2019)"
 FROM ({REPORTS['largest_companies_by_value']}) ORDER BY sum_effective_value DESC, vendor_normalized LIMIT 10""",
    "single_series": f"""SELECT 'Values' AS label, cast(a.position AS int) AS position, coalesce(r.sum_yearly_value, 0) AS value
 FROM ({_years(YEARS)}) a LEFT JOIN ({REPORTS['effective_overall_total_by_year']}) r ON r.effective_year = a.yr""",
    "dense_color_index": after(
        "contracts",
        "SELECT owner_acronym, cast(row_number() OVER (ORDER BY owner_acronym) - 1 AS int) AS position FROM (SELECT DISTINCT owner_acronym FROM contracts)",
    ),
    "owner_dashboard": " UNION ALL ".join(
        [
            _renamed(
                _filled(REPORTS["topk_per_owner_by_entries_by_year"], "owner_acronym, gen_vendor_normalized", "source_year", "total_entries", YEARS),
                "owner_acronym, 'companies by entries' AS chart, gen_vendor_normalized AS label",
            ),
            _renamed(
                _filled(_ALL_SIZES, "owner_acronym", "source_year", "entries_below_25k", YEARS),
                "owner_acronym, 'entries by size' AS chart, 'entries_below_25k' AS label",
            ),
            _renamed(
                _filled(_ALL_SIZES, "owner_acronym", "source_year", "entries_above_25k", YEARS),
                "owner_acronym, 'entries by size' AS chart, 'entries_above_25k' AS label",
            ),
            _renamed(
                _filled(REPORTS["topk_per_owner_by_year"], "owner_acronym, vendor_normalized", "effective_year", "sum_yearly_value", YEARS, "double"),
                "owner_acronym, 'companies by value' AS chart, vendor_normalized AS label",
            ),
            _renamed(
                _filled(REPORTS["effective_total_by_year"], "owner_acronym", "effective_year", "sum_yearly_value", YEARS, "double"),
                "owner_acronym, 'total value' AS chart, owner_acronym AS label",
            ),
        ]
    ),
    "vendor_dashboard": " UNION ALL ".join(
        [
            _renamed(
                _filled(REPORTS["departments_of_top_vendors_by_entries_by_year"], "gen_vendor_normalized, owner_acronym", "source_year", "total_entries", YEARS),
                "gen_vendor_normalized AS vendor, 'departments by entries' AS chart, owner_acronym AS label",
            ),
            _renamed(
                _filled(REPORTS["departments_of_top_vendors_by_value_by_year"], "vendor_normalized, owner_acronym", "effective_year", "sum_yearly_value", YEARS, "double"),
                "vendor_normalized AS vendor, 'departments by value' AS chart, owner_acronym AS label",
            ),
        ]
    ),
}
