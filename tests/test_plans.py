"""Physical plans: what reaches the scan, what is shuffled, what is never gathered."""

import random

from pyspark.sql import functions as F

from contractlens.catalog import inputs, reports as report_queries
from contractlens.functions import dates
from contractlens.operators import duplicates, reports, series
from contractlens.operators.grouping import numbered

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    contracts = inputs.store(spark, FOLDER)["contracts"]
    plan = plan_of(reports.entries_above_below_25k_by_owner(contracts, "nation_3", (1996, 2002)))
    assert "PartitionFilters: [isnotnull(owner_acronym" in plan
    assert "vendor_name" not in plan and "PushedFilters: [" in plan


def test_top_lists_drop_rows_before_the_shuffle(spark):
    v2 = inputs.store(spark, FOLDER)["exports_v2"]
    assert "WindowGroupLimit" in plan_of(reports.top_companies_of_each_owner_by_value(v2, 10))


def test_duplicates_shuffle_small_groups_once(spark):
    rows = inputs.flagged(spark, FOLDER)
    plan = plan_of(duplicates.find_duplicates(rows))
    # the branch of lone entries and the walked branch share one kind of exchange
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("REPARTITION_BY_NUM" in line for line in exchanges)


def test_no_cross_joins(spark):
    from contractlens.catalog import series as series_queries

    for make in (series_queries.owner_dashboard, report_queries.topk_semi_join):
        plan = plan_of(make(spark, FOLDER))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_numbered_matches_a_sort(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), f"{rng.randrange(10**6):06d}") for _ in range(500)]
    rows = sorted(set(rows))
    df = spark.createDataFrame(rows, "g string, name string")
    got = numbered(df, ["g"], ["name"], F.substring("name", 1, 2)).collect()
    for group in "ab":
        names = [name for g, name in rows if g == group]
        mine = {r.name: r.seq for r in got if r.g == group}
        assert mine == {name: i + 1 for i, name in enumerate(names)}


def test_series_rules(spark):
    rows = [("x", 2010, 5, 1), ("x", 2010, 7, 2), ("x", 2030, 9, 3), ("y", 2030, 1, 4), ("y", 2011, 0, 5), (None, 2010, 3, 6)]
    df = spark.createDataFrame(rows, "label string, year int, value bigint, n int")
    axis = dates.year_axis((2010, 2012))
    out = series.gap_fill_series(df, "label", "year", "value", axis, order="n")
    got = {r.label: r["values"] for r in out.collect()}
    # the last value at a point stays, labels out of range are all zero
    assert got == {"x": [7, 0, 0], "y": [0, 0, 0], None: [0, 0, 0]}


def test_python_workers_need_no_package(tmp_path):
    """The same job from another folder, where workers cannot import the package."""
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from contractlens.session import local_session
spark = local_session(2)
from contractlens.catalog import all_queries
from contractlens.catalog.inputs import flagged
from contractlens.operators.duplicates import find_duplicates
q = all_queries()
print("links", q["extract_links_under"](spark, {FOLDER!r}).count())
rows = flagged(spark, {FOLDER!r})
print("rows", find_duplicates(rows, fold_limit=3).count())
"""
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300
    )
    assert "rows 1500" in done.stdout, done.stderr[-2000:]


def test_one_bulk_file_is_in_key_order(spark, tmp_path):
    """The file is put together from many sorted ranges."""
    from pathlib import Path

    from contractlens.catalog import ingest as bulk

    folder = "/root/testdata/sf0.001"
    orders = spark.read.parquet(f"{folder}/orders.parquet").count()
    path = bulk._write_bulk_file(spark, folder, 1, sorted_rows=max(1, orders // 20))
    found = list(Path(path.removeprefix("file:")).glob("*.csv"))
    assert len(found) == 1
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(found[0]))
    keys = [int(r.c0.rsplit("-", 1)[1]) for r in rows.collect()]
    assert len(keys) == orders and keys == sorted(keys)
