"""Column functions on given values."""

import random

import pytest
from pyspark.sql import functions as F

from contractlens.functions import dates, html_select, money, records, text, vendor
from contractlens.functions.html_select import select
from contractlens.operators import lookup, pages


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(make(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value,want",
    [
        ("$1000.99", 1000.99),
        ("$1000", 1000),
        ("$1,000", 1000),
        ("1000$", 1000),
        ("1000,99$", 1000.99),
        ("1,000,99$", 1000.99),
        ("$0.99", 0.99),
        ("0.99$", 0.99),
        (" 10 $", 10),
        ("", 0),
        ("abc", 0),
        ("12abc", 12),
        (None, 0),
    ],
)
def test_contract_value(spark, value, want):
    assert one(spark, value, money.clean_contract_value) == want


@pytest.mark.parametrize(
    "value,want",
    [
        ("Acme Co. Ltd", "ACME"),
        ("A/B Inc.", "A B"),
        ("X PLC PLC", "X"),
        ("X LTD LTD LTD", "X LTD"),
        ("SP LTD ZOO Foo SP LTD ZOO", "SP ZOO FOO"),
        ("Ltd", "LTD"),
        ("Société Générale S.A.", "SOCIETE GENERALE"),
        ("One Ltd Ltd Two", "ONE LTD TWO"),
        ("A B V", "A"),
    ],
)
def test_vendor_name(spark, value, want):
    assert one(spark, value, vendor.clean_vendor_name) == brute_vendor(value) == want


def brute_vendor(name):
    """The suffix walk, word for word."""
    import re
    import unicodedata

    plain = "".join(c for c in unicodedata.normalize("NFD", name.replace("/", " / ")) if ord(c) < 127)
    words = re.sub(r"[^ a-z0-9]+", "", plain.replace("-", " ").lower())
    out = re.sub(" +", " ", words).strip().upper()
    for suffix in vendor.company_suffixes():
        if out.endswith(" " + suffix):
            out = out[: -len(suffix) - 1]
        out = out.replace(f" {suffix} ", " ")
    return out.strip()


def test_random_vendor_names(spark):
    import random

    rng = random.Random(5)
    parts = [*vendor.company_suffixes(), "ACME", "SP", "Z", "O", "B", "V", "ZOO"]
    names = [" ".join(rng.choice(parts) for _ in range(rng.randrange(1, 7))) for _ in range(500)]
    df = spark.createDataFrame([(n,) for n in names], "v string")
    got = df.select("v", vendor.clean_vendor_name(F.col("v"))).collect()
    for name, cleaned in got:
        assert cleaned == brute_vendor(name), name


def test_years_and_codes(spark):
    assert one(spark, "9-2-2017", dates.extract_year) == 2017
    assert one(spark, "soon", dates.extract_year) == 0
    assert one(spark, "514- Rental", dates.extract_object_code) == "0514"
    assert one(spark, "none", dates.extract_object_code) == ""
    label = lambda y: dates.fiscal_label(y, F.lit(3))
    assert one(spark, 2016, label, "int") == "201617-Q3"
    assert one(spark, 1999, label, "int") == "1999100-Q3"
    assert one(spark, 0, label, "int") is None


def test_text(spark):
    assert one(spark, "a\\u00e9 \\n \"q\"", text.unescape_unicode) == 'aé \\n "q"'
    assert one(spark, "a&nbsp;<b>b</b> &amp;c ", text.clean_html_value) == "a b&c"
    assert one(spark, "Æsir ‘x’ 漢", text.to_ascii) == "AEsir 'x' "
    assert one(spark, "/c.html;jsessionid=1:-3?id=2", text.strip_session_id) == "/c.html?id=2"
    assert one(spark, "a\n\tb   c", text.remove_linebreaks) == "a b  c"


def test_total_in_comment(spark):
    comment = "an amendment of $8,520.14, bringing the total contract value to $11,173.15."
    assert one(spark, comment, records.total_from_comment) == "11,173.15"
    assert one(spark, "bringing the total contract value to $900", records.total_from_comment) is None


def test_owner_codes(spark):
    for code, want in {"pwgsc": "pspc", "agr-aafc": "agr", "sc": "esdc", "tbs": "tbs"}.items():
        assert one(spark, code, lookup.owner_code) == want


def test_last_alias_wins(spark):
    rows = [("P", "One Ltd", 0), ("Q", "One", 1), ("P", "Two", 2), ("P", "ONE", 3), ("P", "", 4)]
    df = spark.createDataFrame(rows, "parent_company string, company_name string, position int")
    got = {r.vendor_clean: r.parent for r in lookup.alias_table(df).collect()}
    # all of P is read before Q, so Q has the last word on ONE
    assert got == {"ONE": "Q", "TWO": "P"}


def test_select_paths():
    page = (
        "<div class='a'><p>1<p>2</div><div class='a b'><ul><li>x<li>y</ul></div>"
        "<table><tr><td>k<td>v<b>w</b></td></tr></table><br><div id='n'>a<div>b</div>c</div>"
    )
    assert select(page, "//div[@class='a']/p[2]") == ["2"]
    assert select(page, "//li") == ["x", "y"]
    assert select(page, "//table//td[2]") == ["v<b>w</b>"]
    assert select(page, "//div[@id='n']") == ["a<div>b</div>c"]
    assert select(page, "//ul[not(@class)]/li") == ["x", "y"]
    assert select(page, "//h1") == []


PIECES = [
    "<p>", "</p>", "<td class='a'>", "<td>", "</td>", "<tr>", "</tr>", '<table id="x y">', "</table>", "<br>", "<li>", "</li>",
    "text", "a > b", "\n", "<div\n class='b' id='c'>", "</div >", "<div class='a' class='b'>", "</br>", "é", "&lt;",
    "<br/>", "<!-- <p> -->", "<B>", "<p class=x>", "< p", "<script>", "</script>", "<div class='a&amp;b'>", "<p x='1'y='2'>", "<",
]


def tree(node):
    return node.tag, node.attrs, node.start, node.end, [tree(child) for child in node.children]


def test_plain_pages_give_the_same_tree_by_pattern():
    rng, plain = random.Random(5), 0
    for _ in range(4000):
        page = "".join(rng.choice(PIECES[: rng.choice([21, len(PIECES)])]) for _ in range(rng.randrange(12)))
        root = html_select._plain_root(page)
        plain += root is not None
        assert root is None or tree(root) == tree(html_select._Tree(page).root), page
    assert plain > 1000


@pytest.mark.parametrize(
    "cell", ["", "a", " a\t", "a  b", "a\nb", "<b>a</b>", "a &amp; b", "&lt;b&gt;", "a b", "é Â", "\u000ba\u0000", None]
)
def test_cells_are_cleaned_alike_whether_awkward_or_not(spark, cell):
    html = F.col("html")
    whole = text.remove_linebreaks(text.clean_html_value(pages.plain_text(html)))
    rows = spark.createDataFrame([(cell,)], "html string").select(
        whole.alias("value"), pages.cell_value(html).alias("fast_value"),
        text.clean_label(pages.plain_text(html)).alias("label"), pages.cell_label(html).alias("fast_label"),
    )
    row = rows.first()
    assert row.value == row.fast_value and row.label == row.fast_label
