"""The reports, with the years of the test data."""

from pyspark.sql import functions as F

from contractlens.catalog.inputs import store
from contractlens.catalog.sql_text import after
from contractlens.operators import reports as r

YEARS = (1996, 2002)
OWNER = "nation_3"
VENDOR = "BUILDING 3"


def _contracts(make):
    return lambda spark, sf: make(store(spark, sf)["contracts"])


def _v2(make):
    return lambda spark, sf: make(store(spark, sf)["exports_v2"])


def _both(make):
    return lambda spark, sf: make(store(spark, sf)["contracts"], store(spark, sf)["exports_v2"])


def owners_of_contracts(spark, sf):
    return r.all_owner_acronyms(store(spark, sf)["contracts"])


def topk_semi_join(spark, sf):
    contracts = store(spark, sf)["contracts"]
    top = r.largest_companies_by_entries(contracts, None, 10, YEARS)
    return r.keep_listed(contracts, top, ["gen_vendor_normalized"]).select(
        "id", "gen_vendor_normalized"
    )


def report_limit(spark, sf):
    """A sorted report cut to its first rows."""
    rows = r.entries_by_fiscal(store(spark, sf)["contracts"])
    return rows.orderBy(F.desc_nulls_first("total_entries"), "owner_acronym", "source_fiscal").limit(50)


QUERIES = {
    "entries_by_year_overall": _contracts(r.entries_by_year_overall),
    "entries_by_fiscal_overall": _contracts(r.entries_by_fiscal_overall),
    "entries_by_year": _contracts(r.entries_by_year),
    "entries_by_fiscal": _contracts(r.entries_by_fiscal),
    "effective_total_by_year": _v2(lambda t: r.effective_total_by_year(t, years=YEARS)),
    "effective_total_by_year_of_owner": _v2(
        lambda t: r.effective_total_by_year(t, OWNER, YEARS)
    ),
    "effective_overall_total_by_year": _v2(
        lambda t: r.effective_overall_total_by_year(t, YEARS)
    ),
    "entries_errors_duplicates_by_year": _contracts(r.entries_errors_duplicates_by_year),
    "entries_above_below_25k_by_year": _contracts(r.entries_above_below_25k_by_year),
    "entries_by_original_and_amendment": _contracts(r.entries_by_original_and_amendment),
    "entries_above_below_25k_by_owner": _contracts(
        lambda t: r.entries_above_below_25k_by_owner(t, OWNER, YEARS)
    ),
    "entries_above_below_25k_of_all_owners": _contracts(
        lambda t: r.entries_above_below_25k_by_owner(t, None, YEARS)
    ),
    "entries_in_25k_range_by_owner": _contracts(
        lambda t: r.entries_in_25k_range_by_owner(t, OWNER, YEARS)
    ),
    "entries_in_25k_range_of_all_owners": _contracts(
        lambda t: r.entries_in_25k_range_by_owner(t, None, YEARS)
    ),
    "largest_companies_by_value": _v2(
        lambda t: r.largest_companies_by_value(t, None, 20, YEARS)
    ),
    "largest_companies_by_value_of_owner": _v2(
        lambda t: r.largest_companies_by_value(t, OWNER, 20, YEARS)
    ),
    "largest_companies_by_value_by_year": _v2(
        lambda t: r.largest_companies_by_value_by_year(t, years=YEARS)
    ),
    "largest_companies_by_entries": _contracts(
        lambda t: r.largest_companies_by_entries(t, None, 20, YEARS)
    ),
    "largest_companies_by_entries_by_year": _contracts(
        lambda t: r.largest_companies_by_entries_by_year(t, years=YEARS)
    ),
    "largest_departments_by_value": _v2(
        lambda t: r.largest_departments_by_value(t, VENDOR, 10, YEARS)
    ),
    "largest_departments_by_value_by_year": _v2(
        lambda t: r.largest_departments_by_value_by_year(t, VENDOR, YEARS)
    ),
    "largest_departments_by_entries": _contracts(
        lambda t: r.largest_departments_by_entries(t, VENDOR, 10, YEARS)
    ),
    "largest_departments_by_entries_by_year": _contracts(
        lambda t: r.largest_departments_by_entries_by_year(t, VENDOR, YEARS)
    ),
    "all_owner_acronyms": _v2(r.all_owner_acronyms),
    "all_owner_acronyms_of_contracts": owners_of_contracts,
    "largest_vendor_names": _v2(lambda t: r.largest_vendor_names(t, 10, True, YEARS)),
    "topk_per_owner": _v2(lambda t: r.top_companies_of_each_owner_by_value(t, 10, YEARS)),
    "topk_per_owner_by_year": _v2(
        lambda t: r.top_companies_of_each_owner_by_value_by_year(t, 10, YEARS)
    ),
    "topk_per_owner_by_entries": _contracts(
        lambda t: r.top_companies_of_each_owner_by_entries(t, 10, YEARS)
    ),
    "topk_per_owner_by_entries_by_year": _contracts(
        lambda t: r.top_companies_of_each_owner_by_entries_by_year(t, 10, YEARS)
    ),
    "departments_of_top_vendors_by_value": _v2(
        lambda t: r.departments_of_top_vendors_by_value(t, YEARS)
    ),
    "departments_of_top_vendors_by_value_by_year": _v2(
        lambda t: r.departments_of_top_vendors_by_value_by_year(t, YEARS)
    ),
    "departments_of_top_vendors_by_entries": _both(
        lambda c, t: r.departments_of_top_vendors_by_entries(c, t, YEARS)
    ),
    "departments_of_top_vendors_by_entries_by_year": _both(
        lambda c, t: r.departments_of_top_vendors_by_entries_by_year(c, t, YEARS)
    ),
    "topk_semi_join": topk_semi_join,
    "report_limit": report_limit,
}

_VALID = "NOT gen_is_duplicate AND NOT gen_is_error"
_SPLIT = (
    "count(*) AS total_entries, count(*) FILTER (WHERE NOT gen_is_amendment) AS total_contracts, "
    "count(*) FILTER (WHERE gen_is_amendment) AS total_amendments"
)
_RANGE = f"BETWEEN {YEARS[0]} AND {YEARS[1]}"
_SMALL = """count(*) AS total_original_entries, count(*) FILTER (WHERE contract_value < 25000) AS entries_below_25k,
 count(*) FILTER (WHERE contract_value >= 25000) AS entries_above_25k,
 round(sum(contract_value) FILTER (WHERE contract_value < 25000), 2) AS original_sum_below_25k,
 round(sum(contract_value) FILTER (WHERE contract_value >= 25000), 2) AS original_sum_above_25k"""
_BANDS = """count(*) AS total_original_entries, count(*) FILTER (WHERE contract_value < 24000) AS entries_below_24k,
 count(*) FILTER (WHERE contract_value >= 24000 AND contract_value < 26000) AS entries_between_24k_and_26k,
 count(*) FILTER (WHERE contract_value >= 26000) AS entries_above_26k,
 round(sum(contract_value) FILTER (WHERE contract_value < 24000), 2) AS original_sum_below_24k,
 round(sum(contract_value) FILTER (WHERE contract_value >= 24000 AND contract_value < 26000), 2) AS original_sum_between_24k_and_26k,
 round(sum(contract_value) FILTER (WHERE contract_value >= 26000), 2) AS original_sum_above_26k"""
_ORIGINALS = f"FROM enriched WHERE {_VALID} AND NOT gen_is_amendment AND source_year {_RANGE}"
_IN_YEARS = f"FROM enriched WHERE {_VALID} AND source_year {_RANGE}"


def _entries_sql(keys, present):
    return after(
        "linked",
        f"SELECT {keys}, {_SPLIT} FROM linked WHERE {_VALID} AND {present} IS NOT NULL GROUP BY ALL",
    )


def _sums_sql(keys, name, where="", tail=""):
    return (
        f"SELECT {keys}, round(sum(yearly_value), 2) AS {name} FROM v2 "
        f"WHERE effective_year {_RANGE} {where} GROUP BY {keys} {tail}"
    )


def _counts_sql(keys, where="", tail=""):
    return f"SELECT {keys}, {_SPLIT} {_IN_YEARS} {where} GROUP BY {keys} {tail}"


_BY_VALUE = "ORDER BY sum_effective_value DESC NULLS FIRST, {} LIMIT {}"
_BY_COUNT = "ORDER BY total_entries DESC NULLS FIRST, {} LIMIT {}"
_TOP200 = "top200 AS (" + _sums_sql(
    "vendor_normalized", "sum_effective_value", "", _BY_VALUE.format("vendor_normalized", 200)
) + ")"


def _ranked(inner, group, measure, name, count):
    return (
        f"SELECT *, cast(row_number() OVER (PARTITION BY {group} ORDER BY {measure} DESC NULLS FIRST, {name}) AS int) AS rank "
        f"FROM ({inner}) QUALIFY rank <= {count}"
    )


_TOP_OWNER_VALUE = _ranked(
    _sums_sql("owner_acronym, vendor_normalized", "sum_effective_value"),
    "owner_acronym", "sum_effective_value", "vendor_normalized", 10,
)
_TOP_OWNER_COUNT = _ranked(
    _counts_sql("owner_acronym, gen_vendor_normalized"),
    "owner_acronym", "total_entries", "gen_vendor_normalized", 10,
)
_LISTED_VENDORS = "AND vendor_normalized IN (SELECT vendor_normalized FROM top200)"
_LISTED_GEN = "AND gen_vendor_normalized IN (SELECT vendor_normalized FROM top200)"

ORACLES = {
    "entries_by_year_overall": _entries_sql("source_year", "source_year"),
    "entries_by_fiscal_overall": _entries_sql("source_fiscal", "source_fiscal"),
    "entries_by_year": _entries_sql("owner_acronym, source_year", "source_year"),
    "entries_by_fiscal": _entries_sql("owner_acronym, source_fiscal", "source_fiscal"),
    "effective_total_by_year": after(
        "exports", _sums_sql("owner_acronym, effective_year", "sum_yearly_value")
    ),
    "effective_total_by_year_of_owner": after(
        "exports",
        _sums_sql("owner_acronym, effective_year", "sum_yearly_value", f"AND owner_acronym = '{OWNER}'"),
    ),
    "effective_overall_total_by_year": after(
        "exports", _sums_sql("effective_year", "sum_yearly_value")
    ),
    "entries_errors_duplicates_by_year": after(
        "marked",
        """SELECT owner_acronym, source_year, count(*) AS total_entries,
 count(*) FILTER (WHERE source_origin = 1) AS total_source_scraper,
 count(*) FILTER (WHERE source_origin = 2) AS total_source_csv,
 count(*) FILTER (WHERE gen_is_error) AS error_entries,
 count(*) FILTER (WHERE source_origin = 1 AND gen_is_error) AS error_source_scraper,
 count(*) FILTER (WHERE source_origin = 2 AND gen_is_error) AS error_source_csv,
 count(*) FILTER (WHERE NOT gen_is_duplicate) AS total_non_duplicate_entries,
 count(*) FILTER (WHERE gen_is_duplicate) AS total_duplicate_entries
FROM marked GROUP BY owner_acronym, source_year""",
    ),
    "entries_above_below_25k_by_year": after(
        "linked",
        f"SELECT owner_acronym, source_year, {_SMALL} FROM linked WHERE {_VALID} AND source_fiscal IS NOT NULL "
        "AND NOT gen_is_amendment GROUP BY owner_acronym, source_year",
    ),
    "entries_by_original_and_amendment": after(
        "enriched",
        f"""SELECT owner_acronym, source_year, count(*) AS total_entries,
 count(*) FILTER (WHERE NOT gen_is_amendment) AS original_contract_entries,
 count(*) FILTER (WHERE gen_is_amendment) AS amendment_entries,
 count(*) FILTER (WHERE gen_is_most_recent_value) AS most_recent_entries,
 round(sum(contract_value) FILTER (WHERE NOT gen_is_amendment), 2) AS original_entries_sum,
 round(sum(contract_value) FILTER (WHERE gen_is_most_recent_value), 2) AS most_recent_entries_sum
FROM enriched WHERE {_VALID} AND source_fiscal IS NOT NULL GROUP BY owner_acronym, source_year""",
    ),
    "entries_above_below_25k_by_owner": after(
        "enriched",
        f"SELECT source_year, {_SMALL} {_ORIGINALS} AND owner_acronym = '{OWNER}' GROUP BY source_year",
    ),
    "entries_above_below_25k_of_all_owners": after(
        "enriched",
        f"SELECT owner_acronym, source_year, {_SMALL} {_ORIGINALS} GROUP BY owner_acronym, source_year",
    ),
    "entries_in_25k_range_by_owner": after(
        "enriched",
        f"SELECT source_year, {_BANDS} {_ORIGINALS} AND owner_acronym = '{OWNER}' GROUP BY source_year",
    ),
    "entries_in_25k_range_of_all_owners": after(
        "enriched",
        f"SELECT owner_acronym, source_year, {_BANDS} {_ORIGINALS} GROUP BY owner_acronym, source_year",
    ),
    "largest_companies_by_value": after(
        "exports",
        _sums_sql("vendor_normalized", "sum_effective_value", "", _BY_VALUE.format("vendor_normalized", 20)),
    ),
    "largest_companies_by_value_of_owner": after(
        "exports",
        _sums_sql(
            "vendor_normalized", "sum_effective_value", f"AND owner_acronym = '{OWNER}'",
            _BY_VALUE.format("vendor_normalized", 20),
        ),
    ),
    "largest_companies_by_value_by_year": after(
        "exports",
        _sums_sql(
            "vendor_normalized, effective_year", "sum_yearly_value",
            "AND vendor_normalized IN (SELECT vendor_normalized FROM ("
            + _sums_sql("vendor_normalized", "sum_effective_value", "", _BY_VALUE.format("vendor_normalized", 10))
            + "))",
        ),
    ),
    "largest_companies_by_entries": after(
        "enriched",
        _counts_sql("gen_vendor_normalized", "", _BY_COUNT.format("gen_vendor_normalized", 20)),
    ),
    "largest_companies_by_entries_by_year": after(
        "enriched",
        _counts_sql(
            "gen_vendor_normalized, source_year",
            "AND gen_vendor_normalized IN (SELECT gen_vendor_normalized FROM ("
            + _counts_sql("gen_vendor_normalized", "", _BY_COUNT.format("gen_vendor_normalized", 10))
            + "))",
        ),
    ),
    "largest_departments_by_value": after(
        "exports",
        _sums_sql(
            "owner_acronym", "sum_effective_value", f"AND vendor_normalized = '{VENDOR}'",
            _BY_VALUE.format("owner_acronym", 10),
        ),
    ),
    "largest_departments_by_value_by_year": after(
        "exports",
        _sums_sql(
            "owner_acronym, effective_year", "sum_yearly_value", f"AND vendor_normalized = '{VENDOR}'"
        ),
    ),
    "largest_departments_by_entries": after(
        "enriched",
        _counts_sql(
            "owner_acronym", f"AND gen_vendor_normalized = '{VENDOR}'", _BY_COUNT.format("owner_acronym", 10)
        ),
    ),
    "largest_departments_by_entries_by_year": after(
        "enriched",
        _counts_sql("owner_acronym, source_year", f"AND gen_vendor_normalized = '{VENDOR}'"),
    ),
    "all_owner_acronyms": after("exports", "SELECT DISTINCT owner_acronym FROM v2"),
    "all_owner_acronyms_of_contracts": after(
        "contracts", "SELECT DISTINCT owner_acronym FROM contracts"
    ),
    "largest_vendor_names": after(
        "exports",
        "SELECT vendor_normalized FROM ("
        + _sums_sql("vendor_normalized", "sum_effective_value", "", _BY_VALUE.format("vendor_normalized", 10))
        + ")",
    ),
    "topk_per_owner": after("exports", _TOP_OWNER_VALUE),
    "topk_per_owner_by_year": after(
        "exports",
        _sums_sql("owner_acronym, vendor_normalized, effective_year", "sum_yearly_value")
        .join(["SELECT y.* FROM (", f") y SEMI JOIN ({_TOP_OWNER_VALUE}) t USING (owner_acronym, vendor_normalized)"]),
    ),
    "topk_per_owner_by_entries": after("enriched", _TOP_OWNER_COUNT),
    "topk_per_owner_by_entries_by_year": after(
        "enriched",
        _counts_sql("owner_acronym, gen_vendor_normalized, source_year").join(
            ["SELECT y.* FROM (", f") y SEMI JOIN ({_TOP_OWNER_COUNT}) t USING (owner_acronym, gen_vendor_normalized)"]
        ),
    ),
    "departments_of_top_vendors_by_value": after(
        "exports",
        _ranked(
            _sums_sql("vendor_normalized, owner_acronym", "sum_effective_value", _LISTED_VENDORS),
            "vendor_normalized", "sum_effective_value", "owner_acronym", 200,
        ),
        _TOP200,
    ),
    "departments_of_top_vendors_by_value_by_year": after(
        "exports",
        _sums_sql("vendor_normalized, owner_acronym, effective_year", "sum_yearly_value", _LISTED_VENDORS),
        _TOP200,
    ),
    "departments_of_top_vendors_by_entries": after(
        "exports",
        _ranked(
            _counts_sql("gen_vendor_normalized, owner_acronym", _LISTED_GEN),
            "gen_vendor_normalized", "total_entries", "owner_acronym", 200,
        ),
        _TOP200,
    ),
    "departments_of_top_vendors_by_entries_by_year": after(
        "exports",
        _counts_sql("gen_vendor_normalized, owner_acronym, source_year", _LISTED_GEN),
        _TOP200,
    ),
    "topk_semi_join": after(
        "enriched",
        "SELECT id, gen_vendor_normalized FROM enriched WHERE gen_vendor_normalized IN (SELECT gen_vendor_normalized FROM ("
        + _counts_sql("gen_vendor_normalized", "", _BY_COUNT.format("gen_vendor_normalized", 10))
        + "))",
    ),
    "report_limit": after(
        "linked",
        f"SELECT owner_acronym, source_fiscal, {_SPLIT} FROM linked WHERE {_VALID} AND source_fiscal IS NOT NULL "
        "GROUP BY owner_acronym, source_fiscal ORDER BY total_entries DESC, owner_acronym, source_fiscal LIMIT 50",
    ),
}
