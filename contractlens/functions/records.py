"""Small rules over single fields of a contract record."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from contractlens.functions.money import truthy
from contractlens.functions.text import trim_blank

# fixed value: the wording that comments have
TOTAL_WORDING = "bringing the total contract value to "
# an amount: digits in groups of three set apart by commas, or plain digits; any one
# sign and two digits after it are its cents
GROUPED, PLAIN = r"\d{1,3}(?:,\d{3})+", r"\d+"
TOTAL_IN_COMMENT = f"{TOTAL_WORDING}[$]?(?<whole>{GROUPED}|{PLAIN})(?<cents>.\\d{{2}})?"


def reference_or(reference: Column, fallback: Column) -> Column:
    return F.when(truthy(reference), reference).otherwise(fallback)


def build_uuid(owner: Column, reference: Column) -> Column:
    return F.concat(owner, F.lit("-"), reference)


def split_period(period: Column, separator: str) -> Column:
    """struct(start, end) of 'start SEP end'; missing unless both halves exist."""
    parts = _split(period, separator)
    return F.when(
        F.size(parts) >= 2,
        F.struct(
            trim_blank(F.get(parts, F.lit(0))).alias("start"),
            trim_blank(F.get(parts, F.lit(1))).alias("end"),
        ),
    )


def _split(text: Column, separator: str) -> Column:
    """Split at a literal text."""
    return F.split(text, "\\Q" + separator + "\\E")


def total_from_comment(comment: Column) -> Column:
    """The new total stated in a comment, with cents; missing otherwise."""
    whole = F.regexp_extract(comment, TOTAL_IN_COMMENT, 1)
    cents = F.regexp_extract(comment, TOTAL_IN_COMMENT, 2)
    return F.when((whole != "") & (cents != ""), F.concat(whole, cents))


def split_amended_value(value: Column) -> Column:
    """struct(original, contract) of 'Amended contract value:$1Original contract value:$2'."""
    parts = _split(
        F.replace(value, F.lit("Amended contract value:"), F.lit("")), "Original contract value:"
    )
    amended, original = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    original = F.when(truthy(original), original)
    amended = F.when(truthy(amended), amended)
    return F.struct(
        original.alias("original"), F.coalesce(amended, original, value).alias("contract")
    )


def yes_no(text: Column) -> Column:
    """True for the usual words for yes, false for all else."""
    return F.lower(trim_blank(text)).isin("1", "true", "on", "yes")
