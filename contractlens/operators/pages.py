"""Contract pages: links, fiscal headings, label/value cells, whole records.

Rules by department are constants of the plan (CASE branches), never a collected or
broadcast table, and a record is read from its page without any shuffle.
"""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractlens import fixed_values as fixed
from contractlens.functions import dates, money, records, text
from contractlens.functions.html_select import select_many
from contractlens.functions.vendor import clean_vendor_name

HREF = r"""(?is)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""
FIELDS = [
    "vendorName",
    "referenceNumber",
    "contractDate",
    "description",
    "extraDescription",
    "contractPeriodStart",
    "contractPeriodEnd",
    "contractPeriodRange",
    "deliveryDate",
    "originalValue",
    "contractValue",
    "comments",
    "additionalComments",
    "formerPublicServant",
]


def rows_of(table: str) -> list[list[str]]:
    """Cells of a 'a | b | c' fixed table."""
    return [[cell.strip() for cell in line.split(" |")] for line in table.strip().splitlines()]


def by_owner(groups: dict[str, str]) -> dict[str, str]:
    """{value: 'owner owner'} turned round."""
    return {owner: value for value, owners in groups.items() for owner in owners.split()}


# --- links --------------------------------------------------------------------


def extract_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per page and distinct link, with the position of its first appearance."""
    links = F.array_distinct(F.regexp_extract_all(html, F.lit(HREF), 1))
    kept = [c for c in pages.columns if c != html]
    return pages.select(*kept, F.posexplode(links).alias("position", "link"))


def extract_links_under(pages: DataFrame, path: str, html: str = "html") -> DataFrame:
    """As above for the links inside the elements that a path selects."""
    inner = select_all(pages, F.lit(path), "_parts", html)
    joined = inner.withColumn(html, F.array_join("_parts", "\n")).drop("_parts")
    return extract_links(joined, html)


def resolve_link(link: Column, style: str, base: str = "", page_url: Column | None = None) -> Column:
    """Make a link whole: 'as is', 'trim', 'prefix', 'directory' or 'replace file'."""
    if style == "trim":
        return text.trim_blank(link)
    if style == "prefix":
        return F.concat(F.lit(base), link)
    if style == "directory":
        return F.concat(F.regexp_replace(page_url, "[^/]*$", ""), link)
    if style == "replace file":
        # links with a query belong to the base, others take the place of the index page
        return F.when(link.contains("?"), F.concat(F.lit(base), link)).otherwise(
            F.replace(page_url, F.lit("index-eng.html"), link)
        )
    return link


def filter_links(links: DataFrame, owner: str = "owner_acronym", link: str = "link") -> DataFrame:
    """Drop the links that a department's pages make to foreign hosts."""
    foreign = reduce(
        lambda a, b: a | b,
        [
            F.col(owner).isin(*owners.split()) & F.col(link).contains(host)
            for host, owners in fixed.FOREIGN_HOSTS.items()
        ],
    )
    return links.filter(~F.coalesce(foreign, F.lit(False)))


def expand_pagination(quarters: DataFrame, include_first: bool) -> DataFrame:
    """(url, html) of quarter pages -> the urls of all their pages, first one included if asked."""
    own = F.array(F.col("url")) if include_first else F.array().cast("array<string>")
    links = F.array_distinct(F.regexp_extract_all("html", F.lit(HREF), 1))
    kept = [c for c in quarters.columns if c not in ("html",)]
    return quarters.select(*kept, F.posexplode(F.concat(own, links)).alias("position", "page_url"))


def drop_broken_pages(pages: DataFrame, marker: str, html: str = "html") -> DataFrame:
    return pages.filter(~F.col(html).contains(marker))


# --- selection ------------------------------------------------------------------


def select_paths(pages: DataFrame, paths: dict[str, Column], html: str = "html") -> DataFrame:
    """Add, per name, the inner HTML of everything that each row's path selects.

    Runs in Arrow batches; a page is read once for all paths. Only the page and its paths
    go to Python and only the lists come back, the other columns stay where they are.
    Rows without a path get no list.
    """
    names = list(paths)
    lists = T.StructType([T.StructField(name, T.ArrayType(T.StringType())) for name in names])

    def one(page, *rules):
        if not isinstance(page, str):
            return [None] * len(rules)
        known = [r for r in rules if isinstance(r, str)]
        found = iter(select_many(page, known)) if known else iter(())
        return [next(found) if isinstance(r, str) else None for r in rules]

    def run(held: pd.Series, *rules: pd.Series) -> pd.DataFrame:
        found = [one(*cells) for cells in zip(held, *rules, strict=True)]
        return pd.DataFrame({name: [row[at] for row in found] for at, name in enumerate(names)})

    found = F.pandas_udf(run, lists)(F.col(html), *paths.values())
    columns = [F.col(f"_found.{name}").alias(name) for name in names]
    return pages.withColumn("_found", found).select(*pages.columns, *columns)


def select_all(pages: DataFrame, path: Column, name: str, html: str = "html") -> DataFrame:
    return select_paths(pages, {name: path}, html)


def content_selector(owner: Column) -> Column:
    paths = by_owner({path: owners for path, owners in fixed.CONTENT_SELECTORS.items()})
    return owner_constant(owner, paths)


def owner_constant(owner: Column, values: dict[str, str], default: Column | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    found = F.try_element_at(table, owner)
    return found if default is None else F.coalesce(found, default)


def content_subset(pages: DataFrame, path: Column, html: str = "html") -> DataFrame:
    """Replace a page by the inner HTML of the first element its path selects.

    Pages without a path stay whole; pages where nothing is found become empty.
    """
    parts = select_all(pages, path, "_parts", html)
    first = F.coalesce(F.get("_parts", F.lit(0)), F.lit(""))
    whole = F.when(F.col("_parts").isNull(), F.col(html)).otherwise(first)
    return parts.select(*[whole.alias(html) if c == html else c for c in pages.columns])


def tag_content(html: Column, tag: str) -> Column:
    """Inner HTML of the first `tag` element that is not nested, without leaving the JVM."""
    return F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)


# --- fiscal period of a quarter page -------------------------------------------------


def heading_selector(owner: Column) -> Column:
    return owner_constant(
        owner, {r[0]: r[1] for r in rows_of(fixed.FISCAL_HEADINGS) if r[1].startswith("//")}
    )


def fiscal_period(owner: Column, heading: Column, url: Column) -> Column:
    """struct(year, quarter) told by a heading (or the page's url), 0 where unknown.

    Departments that write the calendar year have quarter 4 moved back one year.
    """
    phrases: dict[str, list[tuple[str, str]]] = {}
    for style, phrase, quarter in rows_of(fixed.QUARTER_PHRASES):
        phrases.setdefault(style, []).append((phrase, quarter))
    rules: dict[tuple[str, str, str], list[str]] = {}
    for name, selector, year, quarter in rows_of(fixed.FISCAL_HEADINGS):
        rules.setdefault((selector == "page url", year, quarter), []).append(name)

    squeezed = heading
    for old, new in (("\n", " "), ("\r", " "), ("\t", " "), ("   ", " "), ("  ", " ")):
        squeezed = F.replace(squeezed, F.lit(old), F.lit(new))
    year_of, quarter_of = F.lit(""), F.lit("")
    for (from_url, year, quarter), owners in rules.items():
        source = url if from_url else heading
        mine = owner.isin(*owners)
        year_of = F.when(mine, F.regexp_extract(source, year, 1)).otherwise(year_of)
        if quarter in phrases:
            where = squeezed if quarter == "months to" else heading
            found = F.lit("")
            for phrase, number in reversed(phrases[quarter]):
                found = F.when(where.contains(phrase), number).otherwise(found)
        else:
            found = F.regexp_extract(source, quarter, 1)
        quarter_of = F.when(mine, found).otherwise(quarter_of)
    year_number = F.coalesce(year_of.try_cast("int"), F.lit(0))
    quarter_number = F.coalesce(quarter_of.try_cast("int"), F.lit(0))
    back = owner.isin(*fixed.CALENDAR_YEAR_OWNERS.split()) & (quarter_number == 4)
    return F.struct(
        F.when(back, year_number - 1).otherwise(year_number).alias("year"),
        quarter_number.alias("quarter"),
    )


def fiscal_from_heading(pages: DataFrame) -> DataFrame:
    """(…, source_year, source_quarter) of quarter pages (owner_acronym, url, html)."""
    pages = pages.withColumn(
        "html",
        F.when(
            F.col("owner_acronym") == "just",
            F.replace("html", F.lit("<h2>Important Information</h2>"), F.lit("")),
        ).otherwise(F.col("html")),
    )
    found = select_all(pages, heading_selector(F.col("owner_acronym")), "_headings")
    # the closing mark lets patterns see the end of the heading
    heading = F.coalesce(F.get("_headings", F.lit(0)), F.lit(""))
    kept = [c for c in pages.columns if c != "html"]
    period = fiscal_period(F.col("owner_acronym"), heading, F.col("url"))
    return found.select(*kept, period.alias("_p")).select(
        *kept,
        F.col("_p.year").alias("source_year"),
        F.col("_p.quarter").alias("source_quarter"),
    )


# --- label and value cells ------------------------------------------------------------


def repair_page(html: Column, owner: Column) -> Column:
    """Literal repairs before reading: lone <br> to blank, then a department's own list."""
    out = F.replace(html, F.lit("<br>"), F.lit(" "))
    by_department: dict[str, list[tuple[str, str]]] = {}
    for name, old, new in rows_of(fixed.PAGE_REPAIRS):
        by_department.setdefault(name, []).append((old, new))
    by_department["fja"] = [(words, " to ") for words in fixed.FJA_PERIOD_WORDS]
    repaired = out
    for name, changes in by_department.items():
        fixed_up = reduce(lambda c, change: F.replace(c, F.lit(change[0]), F.lit(change[1])), changes, out)
        repaired = F.when(owner == name, fixed_up).otherwise(repaired)
    return repaired


def _clean_label(label: str) -> str:
    return re.sub("[^0-9a-z]", "", label.lower())


def label_fields() -> dict[str, dict[str, str]]:
    """{department: {label: field}}, with '*' for departments without lines of their own."""
    rows = rows_of(fixed.PAGE_LABELS)
    common = {field: label for owner, label, field in rows if owner == "common"}
    extra = {field: label for owner, label, field in rows if owner == "default"}
    own: dict[str, dict[str, str]] = {"*": {}}
    own.update({owner: dict(extra) for owner in fixed.DEFAULT_LABEL_OWNERS.split()})
    for owner, label, field in rows:
        if owner not in ("common", "default"):
            own.setdefault(owner, {})[field] = label
    return {
        owner: {_clean_label(label): field for field, label in {**common, **lines}.items() if label != "-"}
        for owner, lines in own.items()
    }


def _label_table(owner: Column) -> Column:
    """The label -> field map of a row's department."""
    tables = {
        name: F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
        for name, labels in label_fields().items()
    }
    nested = F.create_map(*[x for name, m in tables.items() for x in (F.lit(name), m)])
    return F.coalesce(F.try_element_at(nested, owner), tables["*"])


def plain_text(html: Column) -> Column:
    """Text of a cell: tags dropped, the usual entities decoded."""
    out = F.regexp_replace(html, "<[^>]*>", "")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


# text that takes more than trimming to become a value: markup, entities, line ends, ...
AWKWARD = r"[<&\n\r\t]|  |[^\x00-\x7F]"


def cell_label(html: Column) -> Column:
    """A label cell as letters and digits; markup is looked for only where there may be some."""
    marked = F.contains(html, F.lit("<")) | F.contains(html, F.lit("&"))
    return F.when(marked, text.clean_label(plain_text(html))).otherwise(text.clean_label(html))


def cell_value(html: Column) -> Column:
    """A value cell as text on one line; what needs no cleaning is only trimmed."""
    whole = text.remove_linebreaks(text.clean_html_value(plain_text(html)))
    return F.when(F.rlike(html, F.lit(AWKWARD)), whole).otherwise(text.trim_blank(html))


# paths whose cells cannot hold a cell of the same kind, so a pattern finds them exactly
PLAIN_PATH = re.compile(r"//(?:table//)?(th|td|h2|p)(?:\[@([a-z]+)='([^']*)'\])?")


def cell_pattern(path: str) -> str | None:
    """A pattern for the inner HTML of a plain path, or nothing for other paths."""
    plain = PLAIN_PATH.fullmatch(path)
    if not plain:
        return None
    tag, name, value = plain.groups()
    if name is None:
        return rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"
    return rf"""(?is)<{tag}\s(?:[^>]*\s)?{name}\s*=\s*["']{re.escape(value)}["'][^>]*>(.*?)</{tag}>"""


def label_value_arrays(pages: DataFrame) -> DataFrame:
    """Add `keys` and `cells`: the label and value cells of each page, in order.

    Plain cells (th, td, h2, p, with or without one attribute) are found with patterns
    inside the JVM; departments with other layouts go through the path reader.
    """
    special = {r[0]: (r[1], r[2]) for r in rows_of(fixed.PAGE_CELLS)}
    owner = F.col("owner_acronym")
    read = {o: paths for o, paths in special.items() if not all(map(cell_pattern, paths))}
    layouts: dict[tuple[str, str], list[str]] = {}
    for name, paths in special.items():
        if name not in read:
            layouts.setdefault(paths, []).append(name)

    def found(at: int) -> Column:
        out = F.regexp_extract_all("html", F.lit(cell_pattern(("//table//th", "//table//td")[at])), 1)
        for paths, owners in layouts.items():
            own = F.regexp_extract_all("html", F.lit(cell_pattern(paths[at])), 1)
            out = F.when(owner.isin(*owners), own).otherwise(out)
        return out

    plain = pages.filter(~owner.isin(*read)).withColumns({"keys": found(0), "cells": found(1)})
    paths = {
        name: owner_constant(owner, {k: v[at] for k, v in read.items()})
        for at, name in enumerate(("keys", "cells"))
    }
    return plain.unionByName(select_paths(pages.filter(owner.isin(*read)), paths))


def extract_label_values(pages: DataFrame) -> DataFrame:
    """One column per field from (owner_acronym, html): the last cell of its label wins.

    Labels and values are matched by position. No shuffle: each page is one row and
    its cells stay in arrays.
    """
    arrays = label_value_arrays(pages)
    arrays = arrays.withColumn("_table", _label_table(F.col("owner_acronym")))
    pairs = F.transform(
        F.arrays_zip(F.col("keys").alias("key"), F.col("cells").alias("cell")),
        lambda p: F.struct(
            F.try_element_at("_table", cell_label(p["key"])).alias("field"),
            cell_value(p["cell"]).alias("value"),
        ),
    )
    kept = [c for c in pages.columns if c != "html"]
    listed = arrays.withColumn(
        "_pairs", F.filter(pairs, lambda p: p["field"].isNotNull() & p["value"].isNotNull())
    )

    def last(field: str) -> Column:
        return F.try_element_at(
            F.filter("_pairs", lambda p: p["field"] == field), F.lit(-1)
        )["value"]

    return listed.select(*kept, *[last(field).alias(field) for field in FIELDS])


def period_separator(owner: Column, period: Column) -> Column:
    """struct(start, end) of a period text by the department's separator."""
    out = records.split_period(period, " to ")
    for separator, owners in fixed.PERIOD_SEPARATORS.values():
        mine = owner.isin(*owners.split())
        out = F.when(mine, records.split_period(period, separator)).otherwise(out)
    return out


def department_fixups(rows: DataFrame) -> DataFrame:
    """Rules that only some departments need, as columns chosen by department."""
    owner = F.col("owner_acronym")
    same_field = owner.isin("feddev", "wddeo")
    amended = records.split_amended_value(F.col("contractValue"))
    total = records.total_from_comment(F.col("comments"))
    infra = (owner == "infra") & total.isNotNull()
    columns = {
        "deliveryDate": F.when(same_field, F.col("contractPeriodRange")).otherwise(
            F.col("deliveryDate")
        ),
        "originalValue": F.when(infra, F.col("contractValue"))
        .when(owner == "rcmp", F.coalesce(amended["original"], F.col("originalValue")))
        .otherwise(F.col("originalValue")),
        "contractValue": F.when(infra, total)
        .when(owner == "rcmp", amended["contract"])
        .otherwise(F.col("contractValue")),
        "formerPublicServant": F.when(
            (owner == "fja") & F.col("formerPublicServant").isNotNull(),
            records.yes_no(F.col("formerPublicServant")),
        ),
    }
    return rows.select(*[columns.get(c, F.col(c)).alias(c) for c in rows.columns])


# --- whole records -------------------------------------------------------------------


def pages_with_metadata(pages: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left join of pages and their (sourceURL, sourceYear, sourceQuarter) by page key.

    Both sides hold one row per page; the join shuffles on the md5 key, which spreads
    evenly.
    """
    keyed = pages.withColumn("page_key", text.page_key(text.strip_session_id(F.col("url"))))
    meta = metadata.select(
        text.page_key(F.col("sourceURL")).alias("_key"), "sourceURL", "sourceYear", "sourceQuarter"
    )
    return keyed.join(meta, F.col("page_key") == F.col("_key"), "left").drop("_key")


def record_from_fields(rows: DataFrame) -> DataFrame:
    """Fields of a page or bulk row -> one cleaned record (template columns of a record).

    Needs owner_acronym, page_key (or another fallback reference), the text fields and
    sourceYear/sourceQuarter.
    """
    ascii_fields = ["referenceNumber", "vendorName", "comments", "description", "extraDescription"]
    rows = rows.select(
        *[
            (text.to_ascii(F.coalesce(c, F.lit(""))) if c in ascii_fields else F.col(c)).alias(c)
            for c in rows.columns
        ]
    )
    original = money.clean_contract_value(F.col("originalValue"))
    value = money.clean_contract_value(F.col("contractValue"))
    start = dates.start_year(F.col("contractPeriodStart"), F.col("contractDate"))
    rows = (
        rows.withColumn("originalValue", original)
        .withColumn("contractValue", money.value_or_original(value, F.col("originalValue")))
        .withColumn("startYear", start)
        .withColumn(
            "endYear",
            dates.end_year(F.col("contractPeriodEnd"), F.col("deliveryDate"), F.col("startYear")),
        )
        .withColumn(
            "referenceNumber",
            records.reference_or(F.col("referenceNumber"), F.col("fallbackReference")),
        )
    )
    return (
        rows.withColumn("uuid", records.build_uuid(F.col("ownerAcronym"), F.col("referenceNumber")))
        .withColumn("objectCode", dates.extract_object_code(F.col("description")))
        .withColumn(
            "sourceFiscal",
            F.coalesce(dates.fiscal_label(F.col("sourceYear"), F.col("sourceQuarter")), F.lit("")),
        )
        .withColumn("vendorClean", clean_vendor_name(F.col("vendorName")))
        .select(
            "*",
            *[
                text.remove_linebreaks(F.col(c)).alias(f"_{c}")
                for c in ("vendorName", "referenceNumber", "description", "comments", "extraDescription")
            ],
        )
        .drop("vendorName", "referenceNumber", "description", "comments", "extraDescription")
        .withColumnsRenamed(
            {
                f"_{c}": c
                for c in ("vendorName", "referenceNumber", "description", "comments", "extraDescription")
            }
        )
        .drop("fallbackReference", "contractPeriodRange", "additionalComments")
    )


def parse_contract_pages(pages: DataFrame, metadata: DataFrame) -> DataFrame:
    """(owner_acronym, url, html) and page metadata -> records, one per page.

    One shuffle (the metadata join); reading the page is narrow work.
    """
    owner = F.col("owner_acronym")
    body_years = {
        "_bodyYear": F.when(owner == "pch", _href_value("([0-9]{4})")).try_cast("int"),
        "_bodyQuarter": F.when(owner == "pch", _href_value("Q([0-9])")).try_cast("int"),
    }
    repaired = pages.withColumns(body_years).withColumn("html", repair_page(F.col("html"), owner))
    fields = department_fixups(extract_label_values(repaired))
    halves = period_separator(owner, F.col("contractPeriodRange"))
    fields = fields.withColumn("_halves", halves)
    fields = fields.withColumn(
        "contractPeriodStart", F.coalesce("_halves.start", "contractPeriodStart")
    ).withColumn("contractPeriodEnd", F.coalesce("_halves.end", "contractPeriodEnd"))
    joined = pages_with_metadata(fields.drop("_halves"), metadata)
    ready = (
        joined.withColumn("ownerAcronym", owner)
        .withColumn("sourceYear", F.coalesce("sourceYear", "_bodyYear"))
        .withColumn("sourceQuarter", F.coalesce("sourceQuarter", "_bodyQuarter"))
        .withColumn("fallbackReference", F.col("page_key"))
        .withColumn("sourceFilename", F.concat_ws("/", "ownerAcronym", F.concat("page_key", F.lit(".html"))))
        .drop("_bodyYear", "_bodyQuarter")
    )
    return record_from_fields(ready)


def _href_value(pattern: str) -> Column:
    """Pattern in the first link of the page."""
    return F.regexp_extract(F.regexp_extract("html", HREF, 1), pattern, 1)
