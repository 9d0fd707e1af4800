"""Page operators over the pages table and over contract pages derived from orders."""

from pyspark.sql import functions as F

from contractlens.catalog.cleaning import _sql_vendor
from contractlens.catalog.inputs import derived, kept
from contractlens.operators import pages as p
from contractlens.session import cut_lineage
from contractlens.sources.tables import table

# Departments given to the 25 nations, chosen so that every page layout occurs.
OWNERS = (
    "tbs nrcan stats agr feddev hc pc rcmp infra pch dnd cannor acoa csps ps ircc ssc "
    "pspc esdc cfia cc fja ic wddeo osfi"
).split()
_OWNER_SQL = "CASE n_nationkey " + " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(OWNERS)) + " END"

# What a page says, by order.
FACTS = f"""
SELECT o_orderkey AS id, {_OWNER_SQL} AS owner, 'http://pages.example/' || cast(o_orderkey AS string)
  || CASE o_orderkey % 3 WHEN 0 THEN ';s=' || cast(o_custkey AS string) ELSE '' END || '?id=' || cast(o_orderkey AS string) AS url,
  c_mktsegment || ' & ' || cast(c_custkey % 7 AS string) || CASE o_orderkey % 2 WHEN 0 THEN ' Ltd' ELSE '' END AS vendor,
  CASE WHEN o_orderkey % 9 = 0 THEN '' ELSE 'R' || cast(o_orderkey % 400 AS string) END AS reference,
  y || '-05-06' AS contract_date, CASE WHEN o_orderkey % 2 = 0 THEN '514 Rental' ELSE '1228 - Software' END AS work,
  y || '-04-01' AS period_start, cast(yy + o_orderkey % 4 AS string) || '-03-31' AS period_end,
  cast(yy + 3 AS string) || '-12-31' AS delivery, n AS amount, cast(cast(n AS bigint) + 100 AS string) AS new_amount,
  o_orderkey % 5 = 0 AS no_period, o_orderkey % 7 AS notes, yy AS source_year, q AS source_quarter
FROM (SELECT *, cast(year(o_orderdate) AS string) AS y, cast(year(o_orderdate) AS int) AS yy, cast(quarter(o_orderdate) AS int) AS q,
             cast(cast(floor(o_totalprice) AS bigint) AS string) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) t"""

LABELS = {
    "vendor": {"*": "Vendor Name:", "stats": "Vendor:", "cc": "Vendor", "ircc": "Vender Name:"},
    "reference": {"*": "Reference Number:"},
    "date": {"*": "Contract Date:", "cfia": "Date"},
    "work": {
        "*": "Description of work:", "cc": "Description", "feddev": "Description:", "hc": "Description",
        "ic": "Description", "osfi": "Work Description:", "ssc": "Description",
        "stats": "Description of Work:",
    },
    "value": {
        "*": "Contract Value:", "cc": "Amount", "hc": "Overall Contract Value",
        "esdc": "Current Contract Value:", "pspc": "Total Amended Contract Value",
    },
    "period": {
        "*": "Contract Period:", "feddev": "Contract Period / Delivery Date:",
        "ic": "Contract period / delivery date", "wddeo": "Contract Period / Delivery Date :",
    },
    "delivery": {"*": "Delivery Date:"},
    "comments": {"*": "Comments:", "ic": "Comment"},
}
SEPARATORS = {
    "*": " to ", "cc": " To ", "cannor": " - ", "feddev": " - ", "ic": " - ", "ps": " - ",
    "dnd": "to", "esdc": "to", "hc": "to", "pspc": "to", "rcmp": "to", "fja": " to/au ",
}
# How the label and the value of one line are marked up.
ROWS = {
    "*": ("<tr><th>", "</th><td>", "</td></tr>"),
    "agr": ('<tr><th scope="row">', "</th><td>", "</td></tr>"),
    "cfia": ('<tr><th scope="row">', "</th><td>", "</td></tr>"),
    "ssc": ('<tr><th scope="row">', "</th><td>", "</td></tr>"),
    "stats": ("<tr><td>", "</td><td>", "</td></tr>"),
    "feddev": ("<tr><td>", "</td><td>", "</td></tr>"),
    "hc": ("<h2>", "</h2><p>", "</p>"),
    "pc": ("<label>", "</label><p>", "</p>"),
    "acoa": ("<div class='ACOADataFormRow'><div class='ACOADataFormLabelOneColumn'>", "</div><div class='ACOADataFormFieldOneColumn'>", "</div></div>"),
    "csps": ("<div class='row'><div class='col-xs-6'>", "</div><div class='col-xs-6'>", "</div></div>"),
    "ic": ("<div class='ic2col1 formLeftCol'>", "</div><div class='ic2col2 formRightCol'>", "</div>"),
}
AROUND = {
    "*": ("<table>", "</table>"),
    "hc": ("", ""),
    "pc": ("<form>", "</form>"),
    "acoa": ("", ""),
    "csps": ("", ""),
    "ic": ("<div class='formTable'>", "</div>"),
    "osfi": ("<table class='span-8'>", "</table>"),
}


def _pick(choices, part=None):
    """The department's text, chosen in the plan."""
    value = lambda x: F.lit(x if part is None else x[part])
    out = value(choices["*"])
    for owner, choice in choices.items():
        if owner != "*":
            out = F.when(F.col("owner") == owner, value(choice)).otherwise(out)
    return out


def _cores(spark):
    return spark.sparkContext.defaultParallelism


def contract_pages(spark, sf):
    """The derived contract pages, written once as the stored pages they stand for."""
    return kept(spark, sf, "contract pages", lambda: cut_lineage(_derived_pages(spark, sf)))


def _derived_pages(spark, sf):
    """(owner_acronym, url, html, id): every order as a contract page of its department."""
    # the orders file is one small block; pages arrive as many files, so spread the rows
    facts = derived(spark, sf, FACTS).repartition(_cores(spark), "id")
    vendor = F.replace("vendor", F.lit("&"), F.lit("&amp;"))
    amount = F.concat(F.lit("$ "), F.col("amount"), F.lit(".00"))
    # one cell holds both values here, as that department prints them
    both = F.concat(
        F.lit("Amended contract value:$"), F.col("new_amount"),
        F.lit(".00Original contract value:$"), F.col("amount"), F.lit(".00"),
    )
    value = F.when((F.col("owner") == "rcmp"), both).otherwise(amount)
    period = F.when(F.col("no_period"), "").otherwise(
        F.concat(F.col("period_start"), _pick(SEPARATORS), F.col("period_end"))
    )
    total = F.concat(
        F.lit("bringing the total contract value to $"), F.col("new_amount"), F.lit(".50.")
    )
    comments = (
        F.when((F.col("owner") == "infra") & (F.col("notes") == 1), total)
        .when(F.col("notes") == 2, "two<br>lines")
        .when(F.col("notes") == 3, "a <b>bold</b>&nbsp;note\n")
        .otherwise("none")
    )
    cells = {
        "vendor": vendor, "reference": F.col("reference"), "date": F.col("contract_date"),
        "work": F.col("work"), "value": value, "period": period, "delivery": F.col("delivery"),
        "comments": comments,
    }
    lines = [
        F.concat(_pick(ROWS, 0), _pick(LABELS[name]), _pick(ROWS, 1), cell, _pick(ROWS, 2))
        for name, cell in cells.items()
    ]
    back = F.concat(
        F.lit('<a href="lst-eng.cfm?Quarter=Q'), F.col("source_quarter").cast("string"), F.lit("-"),
        F.col("source_year").cast("string"), F.lit('">Back</a>'),
    )
    html = F.concat(_pick(AROUND, 0), *lines, _pick(AROUND, 1), back)
    return facts.select(F.col("owner").alias("owner_acronym"), "url", html.alias("html"), "id")


def page_metadata(spark, sf):
    """Metadata of all pages but those of one department, which tells it in the page."""
    facts = derived(spark, sf, FACTS).filter("owner <> 'pch'")
    return facts.select(
        F.regexp_replace("url", ";[^?]*", "").alias("sourceURL"),
        F.col("source_year").alias("sourceYear"),
        F.col("source_quarter").alias("sourceQuarter"),
    )


def extract_links(spark, sf):
    return p.extract_links(table(spark, sf, "pages").select("page_id", "html"))


def extract_links_under(spark, sf):
    """Links of the navigation list only."""
    rows = table(spark, sf, "pages").select("page_id", "html")
    return p.extract_links_under(rows, "//nav//ul/li")


def resolve_links(spark, sf):
    links = p.extract_links(table(spark, sf, "pages").select("page_id", "url", "html"))
    base = "http://base.example"
    return links.select(
        "page_id",
        "position",
        p.resolve_link(F.col("link"), "prefix", base).alias("prefixed"),
        p.resolve_link(F.col("link"), "directory", "", F.col("url")).alias("in_directory"),
        p.resolve_link(F.concat(F.lit(" "), "link"), "trim").alias("trimmed"),
        p.resolve_link(
            F.col("link"), "replace file", base, F.concat("url", F.lit("/index-eng.html"))
        ).alias("replaced"),
    )


def filter_links(spark, sf):
    """Links of five departments, some of them to foreign hosts."""
    rows = derived(
        spark,
        sf,
        "SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'cbsa' WHEN 1 THEN 'lac' WHEN 2 THEN 'tbs' ELSE 'stats' END AS owner_acronym, "
        "CASE o_custkey % 3 WHEN 0 THEN 'http://open.canada.ca/' WHEN 1 THEN 'http://collectionscanada.gc.ca/' ELSE '/a/' END "
        "|| cast(o_orderkey AS string) AS link FROM orders",
    )
    return p.filter_links(rows)


def expand_pagination(spark, sf):
    return p.expand_pagination(table(spark, sf, "pages").select("page_id", "url", "html"), True)


def detect_broken_pages(spark, sf):
    return p.drop_broken_pages(table(spark, sf, "pages"), "%%%").select("page_id")


def content_subset(spark, sf):
    rows = table(spark, sf, "pages").select("page_id", "html")
    return p.content_subset(rows, F.lit("//article"))


def content_subset_native(spark, sf):
    rows = table(spark, sf, "pages")
    return rows.select("page_id", p.tag_content(F.col("html"), "article").alias("html"))


def content_selectors(spark, sf):
    """The part of a page that each department keeps."""
    rows = contract_pages(spark, sf)
    framed = rows.withColumn(
        "html",
        F.concat(
            F.lit("<body><nav>x</nav><main class='m'><div class='center'><div id='wb-main-in'><div id='wb-main'><div role='main'><div class='score-right'>"),
            F.lit("<div id='mainContent_contdet'><div id='main'><div id='cn-centre-col-inner'><form id='aspnetForm'><form id='pageForm'>[[core]]"),
            F.lit("</form></form></div></div></div></div></div></div></div></div></main></body>"),
        ),
    )
    cut = p.content_subset(framed, p.content_selector(F.col("owner_acronym")))
    return cut.select("id", F.regexp_count("html", F.lit("</[a-z]+>")).alias("closing_tags"))


# Quarter headings of every style.
HEADINGS = {
    "acoa": ("<div class='center'><h2>", "</h2></div>", "{y}-{z}, {q}rd quarter"),
    "agr": ("<main><table><caption>", "</caption></table></main>", "{y} quarter {q}<br>"),
    "cbsa": ("<h1 id='wb-cont'>", "</h1>", "{y}-{z}, Q{q} (archived)"),
    "cfia": ("<main><h1>", "</h1></main>", "{months dash}, {y}"),
    "feddev": ("<div role='main'><h1>", "</h1></div>", "{first month} {y}"),
    "ic": ("<h1 class='printHeader'>", "</h1>", "\n {months to},   {y}"),
    "infra": ("<h1 id='wb-cont'>", "</h1>", "{y}: {plain months}"),
    "ircc": ("<h1 id='wb-cont'>", "</h1>", "{months dash}, {y}"),
    "just": ("<main><h2>Important Information</h2><h2>", "</h2></main>", "{y}-{z}, {q}<sup>th</sup> quarter"),
    "osfi": ("<div id='wb-main'><h3>", "</h3></div>", "{y} - {q}"),
    "ps": ("<p>", "</p>", ""),
    "rcmp": ("<h1 id='wb-cont'>", "</h1>", "Fiscal {y}-{z}, {q}th quarter"),
    "ssc": ("<h1 id='wb-cont'>", "</h1>", "{ordinal title} {y}"),
    "stats": ("<h1 id='wb-cont'>", "</h1>", "{ordinal sentence} of {y}"),
    "tc": ("<form id='pageForm'><p>a</p><p><strong>", "</strong></p></form>", "{y}-{z} {q}<sup>e</sup>"),
}


def quarter_pages(spark, sf):
    return kept(spark, sf, "quarter pages", lambda: cut_lineage(_derived_quarter_pages(spark, sf)))


def _derived_quarter_pages(spark, sf):
    """(owner_acronym, url, html, id) of a quarter page per order and heading style."""
    names = list(HEADINGS)
    style = "CASE o_orderkey % 15 " + " ".join(f"WHEN {i} THEN '{o}'" for i, o in enumerate(names)) + " END"
    rows = derived(
        spark,
        sf,
        f"SELECT o_orderkey AS id, {style} AS owner, cast(year(o_orderdate) AS string) AS y, "
        "cast(year(o_orderdate) + 1 AS string) AS z, cast(quarter(o_orderdate) AS string) AS q FROM orders",
    )
    phrases = {}
    for kind, phrase, quarter in p.rows_of(p.fixed.QUARTER_PHRASES):
        phrases.setdefault(kind, {})[quarter] = phrase
    html = F.lit("")
    for owner, (before, after, words) in HEADINGS.items():
        text = F.lit(words)
        for name in ("y", "z", "q"):
            text = F.replace(text, F.lit("{" + name + "}"), F.col(name))
        for kind, by_quarter in phrases.items():
            phrase = F.lit("")
            for quarter, words_of in by_quarter.items():
                phrase = F.when(F.col("q") == quarter, words_of).otherwise(phrase)
            text = F.replace(text, F.lit("{" + kind + "}"), phrase)
        html = F.when(F.col("owner") == owner, F.concat(F.lit(before), text, F.lit(after))).otherwise(html)
    url = F.concat(F.lit("http://q.example/a?y="), "y", F.lit("&q="), "q")
    return rows.select(F.col("owner").alias("owner_acronym"), url.alias("url"), html.alias("html"), "id")


def fiscal_from_heading(spark, sf):
    return p.fiscal_from_heading(quarter_pages(spark, sf)).select(
        "id", "owner_acronym", "source_year", "source_quarter"
    )


def repair_labels(spark, sf):
    rows = contract_pages(spark, sf).filter("owner_acronym in ('stats', 'ircc', 'fja')")
    fixed_up = p.repair_page(F.col("html"), F.col("owner_acronym"))
    # every label of these pages is now a <th> cell with the usual words
    return rows.select(
        "id",
        F.regexp_count(fixed_up, F.lit("<th[ >]")).alias("label_cells"),
        F.regexp_count(fixed_up, F.lit("Vend[eo]r [Nn]ame:|Vendor:")).alias("vendor_labels"),
        fixed_up.contains("Vender").alias("misspelt"),
        fixed_up.contains(" to/au ").alias("two_languages"),
        fixed_up.contains("<br>").alias("has_breaks"),
    )


def extract_label_values(spark, sf):
    rows = contract_pages(spark, sf)
    rows = rows.withColumn("html", p.repair_page(F.col("html"), F.col("owner_acronym")))
    return p.extract_label_values(rows).select(
        "id", "vendorName", "referenceNumber", "contractDate", "description", "deliveryDate", "comments"
    )


def department_fixups(spark, sf):
    rows = contract_pages(spark, sf)
    rows = rows.withColumn("html", p.repair_page(F.col("html"), F.col("owner_acronym")))
    out = p.department_fixups(p.extract_label_values(rows))
    return out.select("id", "originalValue", "contractValue", "deliveryDate")


def scan_pages_with_metadata(spark, sf):
    joined = p.pages_with_metadata(
        contract_pages(spark, sf).drop("html"), page_metadata(spark, sf)
    )
    return joined.select("id", "page_key", "sourceYear", "sourceQuarter")


def parse_contract_pages(spark, sf):
    out = p.parse_contract_pages(contract_pages(spark, sf), page_metadata(spark, sf))
    return out.select(
        "id", "uuid", "ownerAcronym", "vendorName", "vendorClean", "referenceNumber", "objectCode",
        "contractPeriodStart", "contractPeriodEnd", "startYear", "endYear", "contractValue",
        "sourceFiscal", "comments",
    )


QUERIES = {
    "extract_links": extract_links,
    "extract_links_under": extract_links_under,
    "resolve_links": resolve_links,
    "filter_links": filter_links,
    "expand_pagination": expand_pagination,
    "detect_broken_pages": detect_broken_pages,
    "content_subset": content_subset,
    "content_subset_native": content_subset_native,
    "content_selectors": content_selectors,
    "fiscal_from_heading": fiscal_from_heading,
    "repair_labels": repair_labels,
    "extract_label_values": extract_label_values,
    "department_fixups": department_fixups,
    "scan_pages_with_metadata": scan_pages_with_metadata,
    "parse_contract_pages": parse_contract_pages,
}

_HREFS = "SELECT page_id, url, unnest(l) AS link, generate_subscripts(l, 1) AS i FROM (SELECT page_id, url, regexp_extract_all({}, 'href=\"([^\"]*)\"', 1) AS l FROM pages)"


def _links(source="html"):
    return (
        "SELECT page_id, url, link, cast(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS int) AS position "
        f"FROM (SELECT page_id, url, link, min(i) AS i FROM ({_HREFS.format(source)}) GROUP BY ALL)"
    )


_NAV = "regexp_extract(html, '<nav>(.*?)</nav>', 1, 's')"
_COMMENT = """CASE WHEN owner = 'cc' THEN NULL WHEN owner = 'infra' AND notes = 1 THEN 'bringing the total contract value to $' || new_amount || '.50.'
 WHEN notes = 2 THEN 'two lines' WHEN notes = 3 THEN 'a bold note' ELSE 'none' END"""
_VALUE = """CASE WHEN owner = 'infra' AND notes = 1 THEN new_amount || '.50' WHEN owner = 'rcmp' THEN '$' || new_amount || '.00' ELSE '$ ' || amount || '.00' END"""
_KEY = "md5(regexp_replace(url, ';[^?]*', ''))"
_DELIVERY = f"""CASE WHEN owner = 'cc' THEN NULL WHEN owner IN ('feddev', 'wddeo') THEN CASE WHEN no_period THEN '' ELSE
  period_start || CASE owner WHEN 'feddev' THEN ' - ' ELSE ' to ' END || period_end END ELSE delivery END"""
_NO_PERIOD = "(no_period OR owner = 'cfia')"

ORACLES = {
    "extract_links": f"SELECT page_id, position, link FROM ({_links()})",
    "extract_links_under": f"SELECT page_id, position, link FROM ({_links(_NAV)})",
    "resolve_links": f"""SELECT page_id, position, 'http://base.example' || link AS prefixed, regexp_replace(url, '[^/]*$', '') || link AS in_directory,
 trim(link) AS trimmed, CASE WHEN contains(link, '?') THEN 'http://base.example' || link ELSE url || '/' || link END AS replaced FROM ({_links()})""",
    "filter_links": """SELECT * FROM (SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN 'cbsa' WHEN 1 THEN 'lac' WHEN 2 THEN 'tbs' ELSE 'stats' END AS owner_acronym,
 CASE o_custkey % 3 WHEN 0 THEN 'http://open.canada.ca/' WHEN 1 THEN 'http://collectionscanada.gc.ca/' ELSE '/a/' END || cast(o_orderkey AS string) AS link FROM orders)
 WHERE NOT (owner_acronym IN ('cbsa', 'stats') AND link LIKE '%open.canada.ca%') AND NOT (owner_acronym = 'lac' AND link LIKE '%collectionscanada%')""",
    "expand_pagination": f"""SELECT page_id, url, position + 1 AS position, link AS page_url FROM ({_links()}) UNION ALL
 SELECT page_id, url, 0, url FROM pages""",
    "detect_broken_pages": "SELECT page_id FROM pages WHERE position('%%%' IN html) = 0",
    "content_subset": "SELECT page_id, regexp_extract(html, '<article>(.*?)</article>', 1, 's') AS html FROM pages",
    "content_subset_native": "SELECT page_id, regexp_extract(html, '<article>(.*?)</article>', 1, 's') AS html FROM pages",
    "content_selectors": f"""SELECT id, cast(CASE WHEN owner IN ('agr', 'cfia', 'nrcan', 'pc', 'ps', 'rcmp', 'tbs', 'esdc') THEN 10
 WHEN owner IN ('acoa', 'cannor', 'hc', 'pch', 'wddeo') THEN 9 WHEN owner IN ('infra', 'pspc', 'ssc') THEN 8 WHEN owner IN ('fja', 'osfi') THEN 7
 WHEN owner IN ('feddev', 'ic', 'stats') THEN 6 WHEN owner = 'cc' THEN 5 WHEN owner = 'csps' THEN 4 WHEN owner = 'dnd' THEN 3
 WHEN owner = 'ircc' THEN 1 END AS int) AS closing_tags FROM ({FACTS})""",
    "fiscal_from_heading": """SELECT id, owner_acronym, cast(CASE WHEN owner_acronym IN ('ircc', 'ic', 'feddev') AND q = 4 THEN y - 1 ELSE y END AS int) AS source_year, cast(q AS int) AS source_quarter
 FROM (SELECT o_orderkey AS id, [{}][o_orderkey % 15 + 1] AS owner_acronym, year(o_orderdate) AS y, quarter(o_orderdate) AS q FROM orders)""".format(
        ", ".join(f"'{o}'" for o in HEADINGS)
    ),
    "repair_labels": f"""SELECT id, 8 AS label_cells, 1 AS vendor_labels, false AS misspelt, false AS two_languages, false AS has_breaks
 FROM ({FACTS}) WHERE owner IN ('stats', 'ircc', 'fja')""",
    "extract_label_values": f"""SELECT id, vendor AS "vendorName", reference AS "referenceNumber", contract_date AS "contractDate", work AS description,
 CASE WHEN owner IN ('cc', 'wddeo') THEN NULL ELSE delivery END AS "deliveryDate", {_COMMENT} AS comments FROM ({FACTS})""",
    "department_fixups": f"""SELECT id, CASE WHEN owner = 'infra' AND notes = 1 THEN '$ ' || amount || '.00' WHEN owner = 'rcmp' THEN '$' || amount || '.00' END AS "originalValue",
 {_VALUE} AS "contractValue", {_DELIVERY} AS "deliveryDate" FROM ({FACTS})""",
    "scan_pages_with_metadata": f"""SELECT id, {_KEY} AS page_key, CASE WHEN owner <> 'pch' THEN source_year END AS "sourceYear",
 CASE WHEN owner <> 'pch' THEN source_quarter END AS "sourceQuarter" FROM ({FACTS})""",
    "parse_contract_pages": f"""SELECT id, owner || '-' || ref AS uuid, owner AS "ownerAcronym", vendor AS "vendorName", {_sql_vendor('vendor')} AS "vendorClean",
 ref AS "referenceNumber", CASE WHEN work LIKE '514%' THEN '0514' ELSE '1228' END AS "objectCode",
 CASE WHEN NOT {_NO_PERIOD} THEN period_start END AS "contractPeriodStart", CASE WHEN NOT {_NO_PERIOD} THEN period_end END AS "contractPeriodEnd",
 source_year AS "startYear", cast(CASE WHEN NOT {_NO_PERIOD} THEN substr(period_end, 1, 4) WHEN owner = 'cc' THEN cast(source_year AS string)
   WHEN owner IN ('feddev', 'wddeo') THEN cast(source_year AS string) ELSE substr(delivery, 1, 4) END AS int) AS "endYear",
 cast(replace(replace({_VALUE}, '$', ''), ' ', '') AS double) AS "contractValue",
 cast(source_year AS string) || lpad(cast(CASE WHEN source_year = 1999 THEN 100 ELSE (source_year + 1) % 100 END AS string), CASE WHEN source_year = 1999 THEN 3 ELSE 2 END, '0') || '-Q' || cast(source_quarter AS string) AS "sourceFiscal",
 coalesce({_COMMENT}, '') AS comments
FROM (SELECT *, CASE WHEN reference = '' THEN {_KEY} ELSE reference END AS ref FROM ({FACTS}))""",
}
