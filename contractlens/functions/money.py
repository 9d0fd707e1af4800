"""Money text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# A number at the start of the text, as a lenient float parser sees it.
NUMBER_PREFIX = r"^[ \t\n\r\x0B\f]*([+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)"


def lenient_double(text: Column) -> Column:
    """Numeric prefix of a text; 0 when there is none."""
    return F.coalesce(F.regexp_extract(text, NUMBER_PREFIX, 1).try_cast("double"), F.lit(0.0))


def clean_contract_value(text: Column) -> Column:
    """'$ 15,000.50' -> 15000.5 and '1 000,99$' -> 1000.99; no number -> 0."""
    packed = F.replace(text, F.lit(" "), F.lit(""))
    # a trailing dollar sign marks French money, where the last comma is the decimal mark
    dotted = F.regexp_replace(packed, r"(?:,(?=..\$$)|^,(?=.?\$$))", ".")
    return lenient_double(F.translate(dotted, "$,", ""))


def truthy(text: Column) -> Column:
    """Text that counts as present: not missing, not empty, not '0'."""
    return text.isNotNull() & ~text.isin("", "0")


def value_or_original(value: Column, original: Column) -> Column:
    """The contract value, or the original one where the value is missing or zero."""
    return F.when(F.coalesce(value, F.lit(0.0)) == 0, original).otherwise(value)


def plain_currency(value: Column) -> Column:
    """Two decimals, no separators; a missing sum shows as 0.00."""
    return F.format_string("%.2f", F.coalesce(value, F.lit(0.0)))


def table_currency(value: Column) -> Column:
    """'$ 1,234.50'."""
    return F.concat(F.lit("$ "), F.format_number(F.coalesce(value, F.lit(0.0)), 2))
