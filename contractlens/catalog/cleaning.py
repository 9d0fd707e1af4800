"""Column functions and lookups over text derived from the tables.

Every input is a SELECT that both engines read the same way; the checks restate the
function in plain SQL.
"""

from pyspark.sql import functions as F

from contractlens import fixed_values as fixed
from contractlens.catalog.inputs import derived
from contractlens.functions import dates, money, records, text, vendor
from contractlens.operators import lookup
from contractlens.operators.lookup import pairs
from contractlens.session import scratch_path
from contractlens.sources import writers
from contractlens.sources.tables import table

MONEY = """
SELECT o_orderkey AS id, CASE o_orderkey % 12
  WHEN 0 THEN '$' || n || '.99' WHEN 1 THEN '$' || n WHEN 2 THEN '$ ' || t || ',' || r WHEN 3 THEN n || '$'
  WHEN 4 THEN n || ',99$' WHEN 5 THEN t || ',' || r || ',99$' WHEN 6 THEN '$0.' || r WHEN 7 THEN ' ' || n || ' $'
  WHEN 8 THEN '' WHEN 9 THEN 'about ' || n WHEN 10 THEN n || 'abc' ELSE '-' || n || '.5' END AS money
FROM (SELECT o_orderkey, cast(cast(floor(o_totalprice) AS bigint) AS string) AS n,
             cast(cast(floor(o_totalprice / 1000) AS bigint) AS string) AS t,
             lpad(cast(cast(floor(o_totalprice) AS bigint) % 1000 AS string), 3, '0') AS r FROM orders)"""

VENDOR_NAMES = """
SELECT o_orderkey AS id, CASE o_orderkey % 13
  WHEN 0 THEN c_mktsegment || ' ' || k || ' Ltd.' WHEN 1 THEN c_mktsegment || '/' || k || ', Inc'
  WHEN 2 THEN 'Société ' || c_mktsegment || ' & Fils Ltée' WHEN 3 THEN c_mktsegment || '-' || k || ' CO LTD'
  WHEN 4 THEN c_mktsegment || ' LTD CO ' || k WHEN 5 THEN 'The ' || c_mktsegment || ' Corporation Inc.'
  WHEN 6 THEN c_mktsegment || ' (' || k || ') GmbH' WHEN 7 THEN c_mktsegment || ' Sp. z o.o.'
  WHEN 8 THEN c_mktsegment || ' SP Z OO ' || k || ' LLC' WHEN 9 THEN 'L''' || c_mktsegment || ' S.A.'
  WHEN 10 THEN c_mktsegment || '_' || k || ' B V' WHEN 11 THEN c_mktsegment || ' CO CO ' || k
  ELSE '  ' || c_mktsegment || '   ' || k || '  ' END AS vendor_name
FROM (SELECT o_orderkey, c_mktsegment, cast(c_custkey % 7 AS string) AS k
      FROM orders JOIN customer ON o_custkey = c_custkey)"""

ALIASES = """
SELECT c_mktsegment || CASE c_custkey % 3 WHEN 0 THEN ' Ltd' WHEN 1 THEN ' Inc.' ELSE '' END AS parent_company,
       CASE WHEN c_custkey % 17 = 0 THEN '' ELSE c_name || CASE c_custkey % 2 WHEN 0 THEN ' Corp' ELSE ' LLC' END END AS company_name,
       c_custkey AS position
FROM (SELECT c_custkey, c_mktsegment, 'Unit ' || cast(c_custkey % 400 AS string) AS c_name FROM customer)"""

DATES = """
SELECT o_orderkey AS id, CASE o_orderkey % 6 WHEN 0 THEN d WHEN 1 THEN 'Signed ' || d WHEN 2 THEN '9-2-' || substr(d, 1, 4)
  WHEN 3 THEN '' WHEN 4 THEN 'no date' ELSE '12 3' || d END AS start_text,
  CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'until ' || e WHEN 2 THEN 'n/a' ELSE e END AS end_text,
  CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN e ELSE '0' END AS delivery_text, d AS date_text
FROM (SELECT o_orderkey, cast(cast(o_orderdate AS date) AS string) AS d,
             cast(year(o_orderdate) + 2 AS string) || '-03-31' AS e FROM orders)"""

DESCRIPTIONS = """
SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN cast(o_orderkey % 2000 AS string) || ' - ' || o_orderpriority
  WHEN 1 THEN o_orderpriority || ' 514- Rental' WHEN 2 THEN o_orderpriority ELSE 'code ' || cast(o_custkey AS string) END AS description
FROM orders"""

FISCALS = """
SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN cast(year(o_orderdate) AS string) || '-2017-Q' || cast(quarter(o_orderdate) AS string)
  WHEN 1 THEN '' WHEN 2 THEN 'Q3 of ' || cast(year(o_orderdate) AS string) WHEN 3 THEN NULL ELSE 'C-' || cast(o_orderkey AS string) END AS fiscal,
  'C-' || cast(year(o_orderdate) AS string) || '-' || cast(year(o_orderdate) + 1 AS string) || '-Q' || cast(quarter(o_orderdate) AS string) || '-' || cast(o_orderkey AS string) AS reference
FROM orders"""

PERIODS = """
SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN d || ' to ' || e WHEN 1 THEN d WHEN 2 THEN d || ' to ' || e || ' to ' || d
  ELSE ' to ' || e END AS period
FROM (SELECT o_orderkey, cast(cast(o_orderdate AS date) AS string) AS d, cast(year(o_orderdate) + 1 AS string) || '-03-31' AS e FROM orders)"""

COMMENTS = """
SELECT o_orderkey AS id, cast(n AS string) AS contract_value, CASE o_orderkey % 4
  WHEN 0 THEN 'An amendment, bringing the total contract value to $' || cast(n AS string) || '.15.'
  WHEN 1 THEN 'bringing the total contract value to $' || cast(n // 1000 AS string) || ',' || lpad(cast(n % 1000 AS string), 3, '0') || '.50 in all'
  WHEN 2 THEN 'bringing the total contract value to $' || cast(n AS string) ELSE o_orderpriority END AS comment
FROM (SELECT o_orderkey, o_orderpriority, cast(floor(o_totalprice) AS bigint) AS n FROM orders)"""
# integer division is written DIV by Spark
COMMENTS_SPARK = COMMENTS.replace("n // 1000", "n DIV 1000")

AMENDED = """
SELECT o_orderkey AS id, CASE o_orderkey % 4
  WHEN 0 THEN 'Amended contract value:$' || n || '.00Original contract value:$' || m || '.00'
  WHEN 1 THEN 'Original contract value:$' || m WHEN 2 THEN 'Amended contract value:$' || n ELSE '$' || n END AS value
FROM (SELECT o_orderkey, cast(cast(floor(o_totalprice) AS bigint) AS string) AS n,
             cast(cast(floor(o_totalprice / 2) AS bigint) AS string) AS m FROM orders)"""

OWNERS = """
SELECT o_orderkey AS id, CASE o_orderkey % 9 WHEN 0 THEN 'agr-aafc' WHEN 1 THEN 'statcan-statcan' WHEN 2 THEN 'pwgsc' WHEN 3 THEN 'cic-ircc'
  WHEN 4 THEN 'sc' WHEN 5 THEN 'irccpc' WHEN 6 THEN 'tbs-sct' WHEN 7 THEN 'jus' ELSE lower(o_orderstatus) || '-x-y' END AS owner
FROM orders"""

LABELS = """
SELECT o_orderkey AS id, CASE o_orderkey % 8 WHEN 0 THEN 'agr' WHEN 1 THEN 'total_entries' WHEN 2 THEN 'wd' WHEN 3 THEN 'sum_effective_value'
  WHEN 4 THEN 'ssc' WHEN 5 THEN 'neb' WHEN 6 THEN 'gen_vendor_normalized' ELSE lower(o_orderpriority) END AS code
FROM orders"""

URLS = """
SELECT page_id AS id, CASE page_id % 3 WHEN 0 THEN replace(url, '?', ';jsessionid=00' || cast(page_id AS string) || '?')
  WHEN 1 THEN url || ';jsessionid=9' ELSE url || '?a=1&amp;b=2&amp;c=3' END AS url
FROM pages"""


def _values(select, **columns):
    def run(spark, sf):
        rows = derived(spark, sf, select)
        return rows.select("id", *[make().alias(name) for name, make in columns.items()])

    return run


def vendor_aliases(spark, sf):
    return lookup.alias_table(derived(spark, sf, ALIASES))


def _named(spark, sf):
    names = "SELECT o_orderkey AS id, 'Unit ' || cast(o_orderkey % 500 AS string) || ' Inc.' AS vendor_name FROM orders"
    rows = derived(spark, sf, names)
    return rows.withColumn("gen_vendor_clean", vendor.clean_vendor_name(F.col("vendor_name")))


def normalize_vendor(spark, sf):
    return lookup.normalize_vendor(_named(spark, sf), vendor_aliases(spark, sf))


def renormalize_vendors(spark, sf):
    """Aliases applied to a stored column that holds other values."""
    rows = _named(spark, sf).withColumn("gen_vendor_normalized", F.lit("OLD NAME"))
    return lookup.renormalize_vendors(
        rows, vendor_aliases(spark, sf), "gen_vendor_clean", "gen_vendor_normalized"
    )


def renormalize_contracts(spark, sf):
    """Changed aliases applied to a stored table: only partitions with a changed name are
    written again."""
    rows = normalize_vendor(spark, sf).withColumns(
        {"source_origin": F.lit(1), "owner_acronym": F.right("gen_vendor_clean", F.lit(1))}
    )
    path, old = scratch_path(spark, "renormalized"), F.col("gen_vendor_clean").endswith("7")
    stored = rows.withColumn("gen_vendor_normalized", F.when(old, "OLD NAME").otherwise(F.col("gen_vendor_normalized")))
    writers.replace_owner_rows(stored, path, [])
    writers.renormalize_contracts(spark, path, stored.schema, vendor_aliases(spark, sf))
    return writers.read_contracts(spark, path, stored.schema).drop("source_origin", "owner_acronym")


def vendor_name_variants(spark, sf):
    return lookup.vendor_name_variants(_named(spark, sf), vendor_aliases(spark, sf))


def write_alias_csv(spark, sf):
    return lookup.sorted_aliases(derived(spark, sf, ALIASES))


def alias_entries(spark, sf):
    lists = (
        table(spark, sf, "customer")
        .groupBy("c_nationkey", (F.col("c_custkey") % 50).alias("b"))
        .agg(
            F.array_join(
                F.array_sort(F.collect_set(F.concat(F.lit("Unit "), F.col("c_custkey") % 40))), "\n"
            ).alias("names")
        )
        .withColumn("parent", F.concat(F.lit("Unit "), F.col("c_nationkey")))
    )
    return lookup.alias_entries(lists)


def drop_identity_aliases(spark, sf):
    cleaned = derived(
        spark,
        sf,
        "SELECT c_mktsegment AS parent_company, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END "
        "AS company_name, c_custkey AS id FROM customer",
    )
    return lookup.drop_identity_aliases(cleaned)


def to_ascii(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.to_ascii(F.col("text")).alias("ascii_text")
    )


def remove_linebreaks(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.remove_linebreaks(F.col("text")).alias("one_line")
    )


def unescape_unicode(spark, sf):
    escaped = F.replace(F.col("text"), F.lit("é"), F.lit("\\u00e9"))
    escaped = F.replace(escaped, F.lit("ß"), F.lit("\\u00DF"))
    return table(spark, sf, "documents").select("doc_id", text.unescape_unicode(escaped).alias("text"))


def clean_html_value(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", text.clean_html_value(F.col("html")).alias("plain_text")
    )


def clean_label(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.clean_label(F.col("text")).alias("label")
    )


def slug_of_title(spark, sf):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return table(spark, sf, "pages").select("page_id", text.slug(title).alias("slug"))


def html_id(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.html_id(F.col("url")).alias("html_id"))


def page_key(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.page_key(F.col("url")).alias("page_key"))


def fiscal_label(spark, sf):
    rows = derived(
        spark,
        sf,
        "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE year(o_orderdate) END AS y, quarter(o_orderdate) AS q FROM orders",
    )
    return rows.select("id", dates.fiscal_label(F.col("y"), F.col("q")).alias("source_fiscal"))


def parse_fiscal(spark, sf):
    rows = derived(spark, sf, FISCALS)
    source = records.reference_or(F.col("fiscal"), F.col("reference"))
    return rows.select(
        "id",
        dates.fiscal_year_of(source).alias("source_year"),
        dates.fiscal_quarter_of(source).alias("source_quarter"),
    )


def derive_years(spark, sf):
    start = dates.start_year(F.col("start_text"), F.col("date_text"))
    return (
        derived(spark, sf, DATES)
        .withColumn("start_year", start)
        .select(
            "id",
            "start_year",
            dates.end_year(F.col("end_text"), F.col("delivery_text"), F.col("start_year")).alias(
                "end_year"
            ),
        )
    )


def years_duration(spark, sf):
    rows = derive_years(spark, sf)
    return rows.select(
        "id", dates.years_duration(F.col("start_year"), F.col("end_year")).alias("years_duration")
    )


def value_per_year(spark, sf):
    rows = derived(
        spark,
        sf,
        "SELECT o_orderkey AS id, o_totalprice AS v, year(o_orderdate) AS s, year(o_orderdate) + o_orderkey % 5 - 1 AS e FROM orders",
    )
    return rows.select(
        "id", F.round(F.col("v") / dates.years_duration(F.col("s"), F.col("e")), 4).alias("value_per_year")
    )


def value_fallback(spark, sf):
    rows = derived(
        spark,
        sf,
        "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN 0.0 WHEN o_orderkey % 4 = 1 THEN NULL ELSE o_totalprice END AS v, o_totalprice * 2 AS o FROM orders",
    )
    rows = rows.select("id", F.col("v").cast("double").alias("v"), "o")
    return rows.select("id", money.value_or_original(F.col("v"), F.col("o")).alias("contract_value"))


def format_currency(spark, sf):
    price = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_totalprice"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        money.plain_currency(price).alias("plain"),
        money.table_currency(price).alias("pretty"),
    )


def build_uuid(spark, sf):
    rows = derived(
        spark,
        sf,
        "SELECT o_orderkey AS id, lower(o_orderstatus) AS owner, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN '0' "
        "WHEN 2 THEN NULL ELSE 'R' || cast(o_orderkey AS string) END AS reference, md5(cast(o_orderkey AS string)) AS hash FROM orders",
    )
    reference = records.reference_or(F.col("reference"), F.col("hash"))
    return rows.select("id", records.build_uuid(F.col("owner"), reference).alias("uuid"))


def split_period(spark, sf):
    rows = derived(spark, sf, PERIODS)
    halves = records.split_period(F.col("period"), " to ")
    return rows.select("id", halves["start"].alias("period_start"), halves["end"].alias("period_end"))


def total_from_comment(spark, sf):
    rows = derived(spark, sf, COMMENTS_SPARK)
    total = records.total_from_comment(F.col("comment"))
    return rows.select(
        "id",
        F.coalesce(total, F.col("contract_value")).alias("contract_value"),
        F.when(total.isNotNull(), F.col("contract_value")).alias("original_value"),
    )


def split_amended_value(spark, sf):
    rows = derived(spark, sf, AMENDED)
    parts = records.split_amended_value(F.col("value"))
    return rows.select(
        "id", parts["original"].alias("original_value"), parts["contract"].alias("contract_value")
    )


def json_keys(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.from_json("props", "k int")["k"].alias("k")
    )


def year_sequence(spark, sf):
    rows = derived(
        spark,
        sf,
        "SELECT o_orderkey AS id, year(o_orderdate) AS a, year(o_orderdate) + cast(o_orderkey % 4 AS int) AS b FROM orders",
    )
    return rows.select("id", F.explode(F.sequence("a", "b")).alias("year"))


def distinct_urls(spark, sf):
    """Links of each page without repeats, in order of first appearance."""
    links = F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), 1))
    return table(spark, sf, "pages").select("page_id", F.posexplode(links).alias("pos", "link"))


QUERIES = {
    "clean_contract_value": _values(
        MONEY, contract_value=lambda: money.clean_contract_value(F.col("money"))
    ),
    "clean_vendor_name": _values(
        VENDOR_NAMES, vendor_clean=lambda: vendor.clean_vendor_name(F.col("vendor_name"))
    ),
    "slug": slug_of_title,
    "html_id": html_id,
    "last_wins_map": vendor_aliases,
    "extract_year": _values(DATES, year=lambda: dates.extract_year(F.col("start_text"))),
    "extract_object_code": _values(
        DESCRIPTIONS, object_code=lambda: dates.extract_object_code(F.col("description"))
    ),
    "fiscal_label": fiscal_label,
    "parse_fiscal": parse_fiscal,
    "derive_years": derive_years,
    "value_fallback": value_fallback,
    "years_duration": years_duration,
    "value_per_year": value_per_year,
    "to_ascii": to_ascii,
    "clean_html_value": clean_html_value,
    "clean_label": clean_label,
    "remove_linebreaks": remove_linebreaks,
    "unescape_unicode": unescape_unicode,
    "page_key": page_key,
    "clean_url": _values(URLS, url=lambda: text.clean_url(F.col("url"))),
    "strip_session_id": _values(URLS, url=lambda: text.strip_session_id(F.col("url"))),
    "format_currency": format_currency,
    "build_uuid": build_uuid,
    "split_period": split_period,
    "total_from_comment": total_from_comment,
    "split_amended_value": split_amended_value,
    "json_keys": json_keys,
    "year_sequence": year_sequence,
    "distinct_urls": distinct_urls,
    "normalize_vendor": normalize_vendor,
    "renormalize_vendors": renormalize_vendors,
    "renormalize_contracts": renormalize_contracts,
    "normalize_owner": _values(OWNERS, owner_acronym=lambda: lookup.owner_code(F.col("owner"))),
    "label_lookup": _values(LABELS, label=lambda: lookup.label_text(F.col("code"))),
    "vendor_name_variants": vendor_name_variants,
    "write_alias_csv": write_alias_csv,
    "alias_entries": alias_entries,
    "drop_identity_aliases": drop_identity_aliases,
}


def _sql_ascii(column):
    return f"replace(replace(strip_accents({column}), 'ß', 'ss'), 'ẞ', 'SS')"


def _sql_vendor(column):
    out = f"regexp_replace({_sql_ascii(f'replace({column}, $$/$$, $$ / $$)')}, '[^\\x20-\\x7E]', '', 'g')"
    out = f"regexp_replace({out}, '-+', ' ', 'g')"
    out = f"regexp_replace(lower({out}), '[^ a-z0-9\\s]+', '', 'g')"
    out = f"upper(trim(regexp_replace({out}, '\\s+', ' ', 'g')))"
    for suffix in vendor.company_suffixes():
        out = f"replace(regexp_replace({out}, ' {suffix}$', ''), ' {suffix} ', ' ')"
    return f"trim({out})"


def _sql_slug(column):
    out = f"regexp_replace({_sql_ascii(column)}, '[^\\x20-\\x7E]', '', 'g')"
    out = f"regexp_replace(lower(regexp_replace({out}, '_+', '-', 'g')), '[^-a-z0-9\\s]+', '', 'g')"
    return f"trim(regexp_replace({out}, '[-\\s]+', '-', 'g'), '-')"


def _sql_case(column, values):
    lines = " ".join(f"WHEN $${k}$$ THEN $${v}$$" for k, v in values.items())
    return f"CASE {column} {lines} ELSE {column} END"


_SQL_FLOAT = r"coalesce(try_cast(regexp_extract(m, '^\s*([+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?)', 1) AS double), 0)"
_SQL_YEAR = "coalesce(try_cast(regexp_extract({}, '([1-2][0-9][0-9][0-9])', 1) AS int), 0)"
_SQL_TABLE = f"""
aliases AS (SELECT * FROM ({ALIASES}) WHERE company_name NOT IN ('', '0')),
firsts AS (SELECT parent_company, min(position) AS f FROM aliases GROUP BY 1),
ordered AS (SELECT {_sql_vendor('company_name')} AS vendor_clean, {_sql_vendor('parent_company')} AS parent,
  row_number() OVER (ORDER BY f, position) AS read FROM aliases JOIN firsts USING (parent_company)),
alias_map AS (SELECT vendor_clean, arg_max(parent, read) AS parent FROM ordered GROUP BY 1),
named AS (SELECT o_orderkey AS id, 'Unit ' || cast(o_orderkey % 500 AS string) || ' Inc.' AS vendor_name,
  'UNIT ' || cast(o_orderkey % 500 AS string) AS gen_vendor_clean FROM orders)"""

_DERIVED_YEARS = f"""SELECT id, s AS start_year, CASE WHEN e <> 0 THEN e WHEN delivery_text NOT IN ('', '0') THEN d ELSE s END AS end_year FROM (
 SELECT id, CASE WHEN p <> 0 THEN p ELSE c END AS s, e, d, delivery_text FROM (
  SELECT id, delivery_text, {_SQL_YEAR.format('start_text')} AS p, {_SQL_YEAR.format('date_text')} AS c,
   {_SQL_YEAR.format('end_text')} AS e, {_SQL_YEAR.format('delivery_text')} AS d FROM ({DATES})))"""

ORACLES = {
    "clean_contract_value": rf"""SELECT id, {_SQL_FLOAT} AS contract_value FROM (
 SELECT id, replace(replace(regexp_replace(replace(money, ' ', ''), ',(..\$)$', '.\1'), '$', ''), ',', '') AS m FROM ({MONEY}))""",
    "clean_vendor_name": f"SELECT id, {_sql_vendor('vendor_name')} AS vendor_clean FROM ({VENDOR_NAMES})",
    "slug": f"SELECT page_id, {_sql_slug('t')} AS slug FROM (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS t FROM pages)",
    "html_id": f"SELECT page_id, {_sql_slug('u')} AS html_id FROM (SELECT page_id, replace(url, '/', '-') AS u FROM pages)",
    "last_wins_map": f"WITH {_SQL_TABLE} SELECT * FROM alias_map",
    "extract_year": f"SELECT id, {_SQL_YEAR.format('start_text')} AS year FROM ({DATES})",
    "extract_object_code": f"""SELECT id, CASE WHEN c = '' THEN '' WHEN length(c) = 3 THEN '0' || c ELSE c END AS object_code
 FROM (SELECT id, regexp_extract(description, '[0-9]{{3,4}}') AS c FROM ({DESCRIPTIONS}))""",
    "fiscal_label": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 <> 0 THEN y || CASE WHEN n < 10 THEN '0' ELSE '' END || cast(n AS string) || '-Q' || cast(q AS string) END AS source_fiscal
 FROM (SELECT o_orderkey, cast(year(o_orderdate) AS string) AS y, year(o_orderdate) % 100 + 1 AS n, quarter(o_orderdate) AS q FROM orders)""",
    "parse_fiscal": f"""SELECT id, try_cast(regexp_extract(s, '((19|20)[0-9][0-9])[^0-9]', 1) AS int) AS source_year,
 try_cast(regexp_extract(s, 'Q([0-9])', 1) AS int) AS source_quarter
 FROM (SELECT id, CASE WHEN fiscal IS NULL OR fiscal IN ('', '0') THEN reference ELSE fiscal END AS s FROM ({FISCALS}))""",
    "derive_years": _DERIVED_YEARS,
    "value_fallback": "SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 < 2 THEN o_totalprice * 2 ELSE o_totalprice END AS contract_value FROM orders",
    "years_duration": f"SELECT id, abs(end_year - start_year) + 1 AS years_duration FROM ({_DERIVED_YEARS})",
    "value_per_year": "SELECT o_orderkey AS id, round(o_totalprice / (abs(o_orderkey % 5 - 1) + 1), 4) AS value_per_year FROM orders",
    "to_ascii": f"SELECT doc_id, regexp_replace({_sql_ascii('text')}, '[^\\x00-\\x7F]', '', 'g') AS ascii_text FROM documents",
    "clean_html_value": r"""SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(html, '&nbsp;', ' '), '&amp;', '&'), '&AMP;', '&'), 'Â', ''), '<[^>]*>', '', 'g'), e' \t\n\r') AS plain_text
 FROM (SELECT page_id, replace(html, chr(160), '') AS html FROM pages)""",
    "clean_label": "SELECT doc_id, regexp_replace(lower(text), '[^0-9a-z]', '', 'g') AS label FROM documents",
    "remove_linebreaks": r"SELECT doc_id, trim(replace(translate(text, e'\n\r\t', '   '), '  ', ' '), e' \t\n\r') AS one_line FROM documents",
    "unescape_unicode": "SELECT doc_id, text FROM documents",
    "page_key": "SELECT page_id, md5(url) AS page_key FROM pages",
    "clean_url": f"SELECT id, replace(url, '&amp;', '&') AS url FROM ({URLS})",
    "strip_session_id": f"SELECT id, regexp_replace(url, ';[^?]*', '', 'g') AS url FROM ({URLS})",
    "format_currency": """SELECT o_orderkey, printf('%.2f', p) AS plain, '$ ' || format('{:,.2f}', p) AS pretty
 FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 0.0::double ELSE o_totalprice END AS p FROM orders)""",
    "build_uuid": """SELECT o_orderkey AS id, lower(o_orderstatus) || '-' || CASE WHEN o_orderkey % 4 < 3 THEN md5(cast(o_orderkey AS string)) ELSE 'R' || cast(o_orderkey AS string) END AS uuid FROM orders""",
    "split_period": f"""SELECT id, CASE WHEN len(p) > 1 THEN trim(p[1]) END AS period_start, CASE WHEN len(p) > 1 THEN trim(p[2]) END AS period_end
 FROM (SELECT id, string_split(period, ' to ') AS p FROM ({PERIODS}))""",
    "total_from_comment": f"""SELECT id, coalesce(t, contract_value) AS contract_value, CASE WHEN t IS NOT NULL THEN contract_value END AS original_value FROM (
 SELECT id, contract_value, CASE WHEN m[3] <> '' AND m[1] <> '' THEN m[1] || m[3] END AS t FROM (
  SELECT id, contract_value, [regexp_extract(comment, r, 1), '', regexp_extract(comment, r, 3)] AS m FROM ({COMMENTS}),
   (SELECT 'bringing the total contract value to \\$?([0-9]{{1,3}},([0-9]{{3}},)*[0-9]{{3}}|[0-9]+)(.[0-9][0-9])?' AS r)))""",
    "split_amended_value": f"""SELECT id, o AS original_value, coalesce(a, o, value) AS contract_value FROM (
 SELECT id, value, nullif(p[1], '') AS a, nullif(p[2], '') AS o FROM (
  SELECT id, value, string_split(replace(value, 'Amended contract value:', ''), 'Original contract value:') AS p FROM ({AMENDED})))""",
    "json_keys": "SELECT event_id, cast(json_extract(props, '$.k') AS int) AS k FROM events",
    "year_sequence": """SELECT o_orderkey AS id, cast(unnest(generate_series(year(o_orderdate), year(o_orderdate) + o_orderkey % 4)) AS int) AS year FROM orders""",
    "distinct_urls": """SELECT page_id, cast(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS int) AS pos, link FROM (
 SELECT page_id, link, min(i) AS i FROM (
  SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) AS i FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)) GROUP BY 1, 2)""",
    "normalize_vendor": f"""WITH {_SQL_TABLE} SELECT n.*, coalesce(a.parent, n.gen_vendor_clean) AS gen_vendor_normalized
 FROM named n LEFT JOIN alias_map a ON a.vendor_clean = n.gen_vendor_clean""",
    "renormalize_vendors": f"""WITH {_SQL_TABLE} SELECT n.*, coalesce(a.parent, 'OLD NAME') AS gen_vendor_normalized
 FROM named n LEFT JOIN alias_map a ON a.vendor_clean = n.gen_vendor_clean""",
    "normalize_owner": f"SELECT id, {_sql_case('c', pairs(fixed.OWNER_ALIASES))} AS owner_acronym FROM (SELECT id, string_split(owner, '-')[1] AS c FROM ({OWNERS}))",
    "label_lookup": f"SELECT id, {_sql_case('code', pairs(fixed.DISPLAY_LABELS))} AS label FROM ({LABELS})",
    "vendor_name_variants": f"""WITH {_SQL_TABLE} SELECT parent, vendor_clean FROM alias_map
 UNION SELECT a.parent, n.gen_vendor_clean FROM named n JOIN alias_map a ON a.vendor_clean = n.gen_vendor_clean""",
    "write_alias_csv": f"""SELECT DISTINCT {_sql_vendor('parent_company')} AS parent_company, {_sql_vendor('company_name')} AS company_name
 FROM ({ALIASES}) WHERE company_name <> ''""",
    "alias_entries": """SELECT DISTINCT 'UNIT ' || cast(c_nationkey AS string) AS parent_company, 'UNIT ' || cast(c_custkey % 40 AS string) AS company_name
 FROM customer WHERE c_nationkey <> c_custkey % 40""",
    "drop_identity_aliases": """SELECT c_mktsegment AS parent_company, c_name AS company_name, c_custkey AS id FROM customer WHERE c_custkey % 2 <> 0 AND c_name <> c_mktsegment""",
}

# a name without an alias keeps what is stored
ORACLES["renormalize_contracts"] = f"""WITH {_SQL_TABLE} SELECT n.*,
 coalesce(a.parent, CASE WHEN n.gen_vendor_clean LIKE '%7' THEN 'OLD NAME' ELSE n.gen_vendor_clean END) AS gen_vendor_normalized
 FROM named n LEFT JOIN alias_map a ON a.vendor_clean = n.gen_vendor_clean"""
