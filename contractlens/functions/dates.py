"""Years, fiscal quarters and object codes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from contractlens import fixed_values as fixed


def extract_year(text: Column) -> Column:
    """First 4-digit run from 1000 to 2999; 0 is the unknown year."""
    found = F.regexp_extract(text, "([1-2][0-9]{3})", 1).try_cast("int")
    return F.coalesce(found, F.lit(0))


def extract_object_code(description: Column) -> Column:
    """First run of 3 or 4 digits, padded to 4; empty when there is none."""
    code = F.regexp_extract(description, "([0-9]{3,4})", 1)
    return F.when(code == "", "").otherwise(F.lpad(code, 4, "0"))


def pad_left(text: Column, width: int, fill: str = "0") -> Column:
    """Pad without ever cutting a longer text."""
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, fill))


def fiscal_label(year: Column, quarter: Column) -> Column:
    """2016, 3 -> '201617-Q3'; missing when the year or quarter is."""
    text = year.cast("string")
    following = (F.substring(text, 3, 2).try_cast("int") + 1).cast("string")
    label = F.concat(text, pad_left(following, 2), F.lit("-Q"), quarter.cast("string"))
    known = (F.coalesce(year, F.lit(0)) != 0) & (F.coalesce(quarter, F.lit(0)) != 0)
    return F.when(known, label)


def fiscal_year_of(text: Column) -> Column:
    return F.regexp_extract(text, r"((?:19|20)[0-9]{2})[^0-9]", 1).try_cast("int")


def fiscal_quarter_of(text: Column) -> Column:
    return F.regexp_extract(text, "Q([0-9])", 1).try_cast("int")


def start_year(period_start: Column, contract_date: Column) -> Column:
    from_period = extract_year(period_start)
    return F.when(from_period != 0, from_period).otherwise(extract_year(contract_date))


def end_year(period_end: Column, delivery_date: Column, start: Column) -> Column:
    from_period = extract_year(period_end)
    has_delivery = F.coalesce(delivery_date, F.lit("")).isin("", "0") == F.lit(False)
    return (
        F.when(from_period != 0, from_period)
        .when(has_delivery, extract_year(delivery_date))
        .otherwise(start)
    )


def years_duration(start: Column, end: Column) -> Column:
    return F.abs(end - start) + 1


def repaired_end(start: Column, end: Column, source_year: Column) -> Column:
    """An end before the start becomes the later of the start and the source year."""
    first, last = F.coalesce(start, F.lit(0)), F.coalesce(end, F.lit(0))
    return F.when(last < first, F.greatest(first, F.coalesce(source_year, first))).otherwise(last)


def year_axis(years: tuple[int, int] = fixed.REPORT_YEARS) -> Column:
    return F.sequence(F.lit(years[0]), F.lit(years[1]))


def fiscal_axis(years: tuple[int, int] = fixed.REPORT_YEARS) -> Column:
    """All quarter labels of the report range, as an array."""
    return F.flatten(
        F.transform(
            year_axis(years),
            lambda y: F.transform(
                F.sequence(F.lit(1), F.lit(4)),
                lambda q: F.concat(
                    y.cast("string"),
                    F.substring((y + 1).cast("string"), 3, 2),
                    F.lit("-Q"),
                    q.cast("string"),
                ),
            ),
        )
    )
