"""Text, HTML values, slugs and links."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from contractlens import fixed_values as fixed

NBSP = "\u00a0"
BLANKS = " \t\n\r\u0000\u000b"


def trim_blank(text: Column) -> Column:
    """Trim blanks, tabs, line ends and NUL from both ends."""
    return F.trim(text, F.lit(BLANKS))


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def transliterate(text: Column) -> Column:
    """Accented letters, ligatures and typographic marks to plain letters."""
    out = F.translate(
        text,
        fixed.ACCENTED + fixed.TYPOGRAPHIC,
        fixed.PLAIN_FOR_ACCENTED + fixed.PLAIN_FOR_TYPOGRAPHIC,
    )
    for mark, plain in fixed.LIGATURES.items():
        out = F.replace(out, F.lit(mark), F.lit(plain))
    return out


def to_ascii(text: Column) -> Column:
    """Transliterate, then drop what is still not ASCII. Plain ASCII text is left alone."""
    plain = F.regexp_replace(transliterate(text), r"[^\x00-\x7F]", "")
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(plain)


def slug(text: Column, separator: str = "-") -> Column:
    """Lower-case words joined by the separator."""
    other = "_" if separator == "-" else "-"
    ascii_text = F.when(F.octet_length(text) == F.length(text), text).otherwise(transliterate(text))
    out = F.regexp_replace(ascii_text, r"[^\x20-\x7E]", "")
    out = F.regexp_replace(out, f"[{other}]+", separator)
    out = F.regexp_replace(F.lower(out), rf"[^{separator}\p{{L}}\p{{N}}\s]+", "")
    out = F.regexp_replace(out, rf"[{separator}\s]+", separator)
    return F.trim(out, F.lit(separator))


def clean_html_value(value: Column) -> Column:
    """Decode blanks and ampersands, drop non-breaking blanks and tags, trim."""
    out = F.replace(value, F.lit("&nbsp;"), F.lit(" "))
    out = F.replace(out, F.lit("&amp;"), F.lit("&"))
    out = F.replace(out, F.lit("&AMP;"), F.lit("&"))
    out = F.translate(out, NBSP + "\u00c2", "")
    return trim_blank(F.regexp_replace(out, "<[^>]*>", ""))


def clean_label(label: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(label), "[^0-9a-z]", "")


def remove_linebreaks(text: Column) -> Column:
    """Line ends and tabs to blanks, one pass of double to single blank, trim."""
    return trim_blank(F.replace(F.translate(text, "\n\r\t", "   "), F.lit("  "), F.lit(" ")))


def unescape_unicode(text: Column) -> Column:
    r"""Turn \uXXXX into its character and leave every other backslash alone."""
    quoted = F.regexp_replace(text, r"\\(?!u[0-9a-fA-F]{4})", r"\\\\")
    quoted = F.replace(quoted, F.lit('"'), F.lit('\\"'))
    for char, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        quoted = F.replace(quoted, F.lit(char), F.lit(escape))
    return F.from_json(F.concat(F.lit('["'), quoted, F.lit('"]')), "array<string>")[0]


def clean_url(url: Column) -> Column:
    return F.replace(url, F.lit("&amp;"), F.lit("&"))


def strip_session_id(url: Column) -> Column:
    """Drop ';...' up to the query string."""
    return F.regexp_replace(url, r";([^?]*)?", "")


def page_key(url: Column) -> Column:
    return F.md5(url)


def html_id(text: Column) -> Column:
    return slug(F.replace(text, F.lit("/"), F.lit("-")))
