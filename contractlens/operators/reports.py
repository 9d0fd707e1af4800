"""Counts, sums and top lists over contracts and the yearly export.

`owner` and `vendor` parameters are optional filters, `limit` bounds the rows of a report
(None: all of them). Contract reports take the contracts or their report base. Reports that the departments
or the top vendors each need exist once for all of them ("by_owner", "by_vendor"),
so no loop of point queries is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlens import fixed_values as fixed
from contractlens.operators.flags import equals_if_given, valid_entries, year_range

Years = tuple[int, int]


#: What the contract reports group and filter by.
BASE_KEYS = [
    "owner_acronym", "gen_vendor_normalized", "source_year", "source_fiscal", "source_origin",
    "gen_is_error", "gen_is_duplicate", "gen_is_amendment", "gen_is_most_recent_value",
]
ENTRIES, TOTAL = "_entries", "_total"


def weighted(contracts: DataFrame) -> DataFrame:
    """Contract rows with the number of entries each stands for and their total value; a
    report base has these columns already."""
    if ENTRIES in contracts.columns:
        return contracts
    one = F.col("id").isNotNull().cast("bigint")
    return contracts.withColumns({ENTRIES: one, TOTAL: F.col("contract_value")})


def report_base(contracts: DataFrame) -> DataFrame:
    """One pass over the contracts for all reports: counts and totals by every key that a
    report groups by or looks at.

    Values are kept as the bands between the limits that reports ask for; each band is
    told by one of its values. All report functions take a base in place of contracts.
    """
    value = F.col("contract_value")
    limits = sorted({fixed.BAND_LOW, fixed.SMALL_CONTRACT_LIMIT, fixed.BAND_HIGH})
    band = F.when(value.isNotNull(), sum(((value >= limit).cast("int") for limit in limits), F.lit(0)))
    return contracts.groupBy(*BASE_KEYS, band.alias("_band")).agg(
        F.count("id").alias(ENTRIES), F.sum(value).alias(TOTAL), F.min(value).alias("contract_value")
    ).drop("_band")


def value_base(v2: DataFrame) -> DataFrame:
    """The same for the yearly export."""
    return v2.groupBy("owner_acronym", "vendor_normalized", "effective_year").agg(
        F.sum("yearly_value").alias("yearly_value")
    )


def _count_if(condition: Column | None = None) -> Column:
    entries = F.col(ENTRIES) if condition is None else F.when(condition, F.col(ENTRIES))
    return F.coalesce(F.sum(entries), F.lit(0).cast("bigint"))


def _split() -> list[Column]:
    return [
        _count_if().alias("total_entries"),
        _count_if(~F.col("gen_is_amendment")).alias("total_contracts"),
        _count_if(F.col("gen_is_amendment")).alias("total_amendments"),
    ]


def _sum_if(condition: Column, name: str) -> Column:
    """Sum over the rows that meet the condition; missing when there are none."""
    return F.round(F.sum(F.when(condition, F.col(TOTAL))), 2).alias(name)


def _yearly_sum(name: str) -> Column:
    return F.round(F.sum("yearly_value"), 2).alias(name)


def _first_rows(rows: DataFrame, limit: int | None) -> DataFrame:
    """The first rows of a sorted report, or all of them."""
    return rows if limit is None else rows.limit(limit)


def _entries(contracts: DataFrame, keys: list[str], present: str, limit: int | None) -> DataFrame:
    counts = valid_entries(weighted(contracts), present).groupBy(*keys).agg(*_split())
    return _first_rows(counts.orderBy(*keys), limit)


def entries_by_year_overall(contracts: DataFrame, limit: int | None = fixed.REPORT_ROWS) -> DataFrame:
    return _entries(contracts, ["source_year"], "source_year", limit)


def entries_by_fiscal_overall(contracts: DataFrame, limit: int | None = fixed.REPORT_ROWS) -> DataFrame:
    return _entries(contracts, ["source_fiscal"], "source_fiscal", limit)


def entries_by_year(contracts: DataFrame, limit: int | None = fixed.REPORT_ROWS) -> DataFrame:
    return _entries(contracts, ["owner_acronym", "source_year"], "source_year", limit)


def entries_by_fiscal(contracts: DataFrame, limit: int | None = fixed.REPORT_ROWS) -> DataFrame:
    return _entries(contracts, ["owner_acronym", "source_fiscal"], "source_fiscal", limit)


def effective_total_by_year(
    v2: DataFrame, owner: str | None = None, years: Years = fixed.REPORT_YEARS,
    limit: int | None = fixed.YEARLY_ROWS,
) -> DataFrame:
    rows = equals_if_given(year_range(v2, "effective_year", years), "owner_acronym", owner)
    sums = rows.groupBy("owner_acronym", "effective_year").agg(_yearly_sum("sum_yearly_value"))
    return _first_rows(sums.orderBy("owner_acronym", "effective_year"), limit)


def effective_overall_total_by_year(
    v2: DataFrame, years: Years = fixed.REPORT_YEARS, limit: int | None = fixed.YEARLY_ROWS
) -> DataFrame:
    rows = year_range(v2, "effective_year", years)
    sums = rows.groupBy("effective_year").agg(_yearly_sum("sum_yearly_value"))
    return _first_rows(sums.orderBy("effective_year"), limit)


def entries_errors_duplicates_by_year(contracts: DataFrame, limit: int | None = fixed.REPORT_ROWS) -> DataFrame:
    scraper, csv = F.col("source_origin") == 1, F.col("source_origin") == 2
    error, duplicate = F.col("gen_is_error"), F.col("gen_is_duplicate")
    rows = (
        weighted(contracts).groupBy("owner_acronym", "source_year")
        .agg(
            _count_if().alias("total_entries"),
            _count_if(scraper).alias("total_source_scraper"),
            _count_if(csv).alias("total_source_csv"),
            _count_if(error).alias("error_entries"),
            _count_if(scraper & error).alias("error_source_scraper"),
            _count_if(csv & error).alias("error_source_csv"),
            _count_if(~duplicate).alias("total_non_duplicate_entries"),
            _count_if(duplicate).alias("total_duplicate_entries"),
        )
        .orderBy("owner_acronym", F.asc_nulls_last("source_year"))
    )
    return _first_rows(rows, limit)


def _small_and_large() -> list[Column]:
    small = F.col("contract_value") < fixed.SMALL_CONTRACT_LIMIT
    large = F.col("contract_value") >= fixed.SMALL_CONTRACT_LIMIT
    return [
        _count_if().alias("total_original_entries"),
        _count_if(small).alias("entries_below_25k"),
        _count_if(large).alias("entries_above_25k"),
        _sum_if(small, "original_sum_below_25k"),
        _sum_if(large, "original_sum_above_25k"),
    ]


def entries_above_below_25k_by_year(contracts: DataFrame, limit: int | None = fixed.REPORT_ROWS) -> DataFrame:
    originals = valid_entries(weighted(contracts)).filter(~F.col("gen_is_amendment"))
    rows = (
        originals.groupBy("owner_acronym", "source_year")
        .agg(*_small_and_large())
        .orderBy("owner_acronym", F.asc_nulls_last("source_year"))
    )
    return _first_rows(rows, limit)


def entries_by_original_and_amendment(contracts: DataFrame, limit: int | None = fixed.REPORT_ROWS) -> DataFrame:
    amendment, latest = F.col("gen_is_amendment"), F.col("gen_is_most_recent_value")
    rows = (
        valid_entries(weighted(contracts))
        .groupBy("owner_acronym", "source_year")
        .agg(
            _count_if().alias("total_entries"),
            _count_if(~amendment).alias("original_contract_entries"),
            _count_if(amendment).alias("amendment_entries"),
            _count_if(latest).alias("most_recent_entries"),
            _sum_if(~amendment, "original_entries_sum"),
            _sum_if(latest, "most_recent_entries_sum"),
        )
        .orderBy("owner_acronym", F.asc_nulls_last("source_year"))
    )
    return _first_rows(rows, limit)


def _originals_in_range(contracts: DataFrame, owner: str | None, years: Years) -> DataFrame:
    rows = valid_entries(weighted(contracts), "source_year").filter(~F.col("gen_is_amendment"))
    return equals_if_given(year_range(rows, "source_year", years), "owner_acronym", owner)


def entries_above_below_25k_by_owner(
    contracts: DataFrame, owner: str | None = None, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    """One department by year; without a department, all of them at once."""
    keys = ["source_year"] if owner else ["owner_acronym", "source_year"]
    rows = _originals_in_range(contracts, owner, years).groupBy(*keys).agg(*_small_and_large())
    return rows.orderBy(*keys) if owner else rows


def entries_in_25k_range_by_owner(
    contracts: DataFrame, owner: str | None = None, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    keys = ["source_year"] if owner else ["owner_acronym", "source_year"]
    value = F.col("contract_value")
    below = value < fixed.BAND_LOW
    between = (value >= fixed.BAND_LOW) & (value < fixed.BAND_HIGH)
    above = value >= fixed.BAND_HIGH
    rows = (
        _originals_in_range(contracts, owner, years)
        .groupBy(*keys)
        .agg(
            _count_if().alias("total_original_entries"),
            _count_if(below).alias("entries_below_24k"),
            _count_if(between).alias("entries_between_24k_and_26k"),
            _count_if(above).alias("entries_above_26k"),
            _sum_if(below, "original_sum_below_24k"),
            _sum_if(between, "original_sum_between_24k_and_26k"),
            _sum_if(above, "original_sum_above_26k"),
        )
    )
    return rows.orderBy(*keys) if owner else rows


# --- top lists: largest first, missing sums first, ties by name --------------


def _top(rows: DataFrame, measure: str, name: str, count: int) -> DataFrame:
    return rows.orderBy(F.desc_nulls_first(measure), F.asc_nulls_last(name)).limit(count)


def _top_in(rows: DataFrame, group: str, measure: str, name: str, count: int) -> DataFrame:
    """Top rows of every group; Spark drops rows beyond the rank before the shuffle."""
    order = Window.partitionBy(group).orderBy(F.desc_nulls_first(measure), F.asc_nulls_last(name))
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= count)


def _value_by(
    v2: DataFrame, keys: list[str], years: Years, name: str = "sum_effective_value"
) -> DataFrame:
    return year_range(v2, "effective_year", years).groupBy(*keys).agg(_yearly_sum(name))


def _entries_by(contracts: DataFrame, keys: list[str], years: Years) -> DataFrame:
    rows = year_range(valid_entries(weighted(contracts), "source_year"), "source_year", years)
    return rows.groupBy(*keys).agg(*_split())


def keep_listed(rows: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are in a top list. The list's own limit bounds the broadcast."""
    return rows.join(F.broadcast(listed.select(*keys)), keys, "left_semi")


def largest_companies_by_value(
    v2: DataFrame, owner: str | None = None, count: int = fixed.TOP_VENDORS, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    rows = equals_if_given(v2, "owner_acronym", owner)
    return _top(
        _value_by(rows, ["vendor_normalized"], years), "sum_effective_value", "vendor_normalized", count
    )


def largest_companies_by_value_by_year(
    v2: DataFrame, owner: str | None = None, count: int = fixed.TOP_VENDORS_BY_YEAR, years: Years = fixed.REPORT_YEARS,
    limit: int | None = fixed.YEARLY_ROWS,
) -> DataFrame:
    rows = equals_if_given(v2, "owner_acronym", owner)
    top = largest_companies_by_value(rows, None, count, years)
    listed = keep_listed(rows, top, ["vendor_normalized"])
    sums = _value_by(listed, ["vendor_normalized", "effective_year"], years, "sum_yearly_value")
    return _first_rows(sums.orderBy("vendor_normalized", "effective_year"), limit)


def largest_companies_by_entries(
    contracts: DataFrame, owner: str | None = None, count: int = fixed.TOP_VENDORS, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    rows = equals_if_given(contracts, "owner_acronym", owner)
    counts = _entries_by(rows, ["gen_vendor_normalized"], years)
    return _top(counts, "total_entries", "gen_vendor_normalized", count)


def largest_companies_by_entries_by_year(
    contracts: DataFrame, owner: str | None = None, count: int = fixed.TOP_VENDORS_BY_YEAR,
    years: Years = fixed.REPORT_YEARS, limit: int | None = fixed.VENDOR_ENTRY_ROWS,
) -> DataFrame:
    rows = equals_if_given(contracts, "owner_acronym", owner)
    top = largest_companies_by_entries(rows, None, count, years)
    listed = keep_listed(rows, top, ["gen_vendor_normalized"])
    counts = _entries_by(listed, ["gen_vendor_normalized", "source_year"], years)
    return _first_rows(counts.orderBy("gen_vendor_normalized", "source_year"), limit)


def largest_departments_by_value(
    v2: DataFrame, vendor: str, count: int = fixed.TOP_VENDORS, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    rows = equals_if_given(v2, "vendor_normalized", vendor)
    return _top(_value_by(rows, ["owner_acronym"], years), "sum_effective_value", "owner_acronym", count)


def largest_departments_by_value_by_year(
    v2: DataFrame, vendor: str, years: Years = fixed.REPORT_YEARS, limit: int | None = fixed.DEPARTMENT_ROWS
) -> DataFrame:
    """Every department of the vendor, so no list of departments is needed first."""
    rows = equals_if_given(v2, "vendor_normalized", vendor)
    sums = _value_by(rows, ["owner_acronym", "effective_year"], years, "sum_yearly_value")
    return _first_rows(sums.orderBy("owner_acronym", "effective_year"), limit)


def largest_departments_by_entries(
    contracts: DataFrame, vendor: str, count: int = fixed.TOP_VENDORS, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    rows = equals_if_given(contracts, "gen_vendor_normalized", vendor)
    return _top(_entries_by(rows, ["owner_acronym"], years), "total_entries", "owner_acronym", count)


def largest_departments_by_entries_by_year(
    contracts: DataFrame, vendor: str, years: Years = fixed.REPORT_YEARS, limit: int | None = fixed.DEPARTMENT_ROWS
) -> DataFrame:
    rows = equals_if_given(contracts, "gen_vendor_normalized", vendor)
    counts = _entries_by(rows, ["owner_acronym", "source_year"], years)
    return _first_rows(counts.orderBy("owner_acronym", "source_year"), limit)


def all_owner_acronyms(rows: DataFrame) -> DataFrame:
    return rows.select("owner_acronym").distinct().orderBy("owner_acronym")


def largest_vendor_names(
    v2: DataFrame, count: int = 10, by_name: bool = False, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    names = largest_companies_by_value(v2, None, min(count, fixed.TOP_VENDORS), years)
    if by_name:
        return names.select("vendor_normalized").orderBy("vendor_normalized")
    return names.select("vendor_normalized")


# --- the same reports for all departments or all top vendors at once ---------


def top_companies_of_each_owner_by_value(
    v2: DataFrame, count: int = fixed.TOP_VENDORS, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    sums = _value_by(v2, ["owner_acronym", "vendor_normalized"], years)
    return _top_in(sums, "owner_acronym", "sum_effective_value", "vendor_normalized", count)


def top_companies_of_each_owner_by_value_by_year(
    v2: DataFrame, count: int = fixed.TOP_VENDORS_BY_YEAR, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    yearly = _value_by(v2, ["owner_acronym", "vendor_normalized", "effective_year"], years, "sum_yearly_value")
    top = top_companies_of_each_owner_by_value(v2, count, years)
    return _join_listed(yearly, top, ["owner_acronym", "vendor_normalized"])


def top_companies_of_each_owner_by_entries(
    contracts: DataFrame, count: int = fixed.TOP_VENDORS, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    counts = _entries_by(contracts, ["owner_acronym", "gen_vendor_normalized"], years)
    return _top_in(counts, "owner_acronym", "total_entries", "gen_vendor_normalized", count)


def top_companies_of_each_owner_by_entries_by_year(
    contracts: DataFrame, count: int = fixed.TOP_VENDORS_BY_YEAR, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    yearly = _entries_by(contracts, ["owner_acronym", "gen_vendor_normalized", "source_year"], years)
    top = top_companies_of_each_owner_by_entries(contracts, count, years)
    return _join_listed(yearly, top, ["owner_acronym", "gen_vendor_normalized"])


def _join_listed(rows: DataFrame, top: DataFrame, keys: list[str]) -> DataFrame:
    """Semi join of two aggregates that are already partitioned alike; no broadcast."""
    return rows.join(top.select(*keys), keys, "left_semi")


def departments_of_top_vendors_by_value(
    v2: DataFrame, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    top = largest_companies_by_value(v2, years=years)
    listed = keep_listed(v2, top, ["vendor_normalized"])
    sums = _value_by(listed, ["vendor_normalized", "owner_acronym"], years)
    return _top_in(
        sums, "vendor_normalized", "sum_effective_value", "owner_acronym", fixed.TOP_VENDORS
    )


def departments_of_top_vendors_by_value_by_year(
    v2: DataFrame, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    top = largest_companies_by_value(v2, years=years)
    listed = keep_listed(v2, top, ["vendor_normalized"])
    return _value_by(listed, ["vendor_normalized", "owner_acronym", "effective_year"], years, "sum_yearly_value")


def departments_of_top_vendors_by_entries(
    contracts: DataFrame, v2: DataFrame, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    top = largest_companies_by_value(v2, years=years).withColumnRenamed(
        "vendor_normalized", "gen_vendor_normalized"
    )
    listed = keep_listed(contracts, top, ["gen_vendor_normalized"])
    counts = _entries_by(listed, ["gen_vendor_normalized", "owner_acronym"], years)
    return _top_in(
        counts, "gen_vendor_normalized", "total_entries", "owner_acronym", fixed.TOP_VENDORS
    )


def departments_of_top_vendors_by_entries_by_year(
    contracts: DataFrame, v2: DataFrame, years: Years = fixed.REPORT_YEARS
) -> DataFrame:
    top = largest_companies_by_value(v2, years=years).withColumnRenamed(
        "vendor_normalized", "gen_vendor_normalized"
    )
    listed = keep_listed(contracts, top, ["gen_vendor_normalized"])
    return _entries_by(listed, ["gen_vendor_normalized", "owner_acronym", "source_year"], years)
