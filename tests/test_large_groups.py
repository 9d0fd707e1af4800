"""One group that holds most rows, without broadcast joins: the path of large data."""

import random

import pytest

import brute
from contractlens.catalog import inputs
from contractlens.operators import amendments, duplicates
from test_core_rules import COLUMNS, NAMES, as_dicts


@pytest.fixture
def no_broadcast(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        # splits any partition that is larger than the others
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def hot_rows(seed, count=600):
    """Two thirds share department, value and vendor; half of them have no reference."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        hot = rng.random() < 0.66
        year = rng.choice([2010, 2011])
        rows.append(
            (
                i,
                "hot" if hot else f"o{rng.randrange(5)}",
                f"{rng.choice([2010, 2011, 2012])}-Q{rng.randrange(1, 5)}",
                10.0 if hot else float(rng.randrange(1, 5)),
                rng.choice([None, None, 10.0, 2.0]),
                "V" if hot else rng.choice("AB"),
                f"d{rng.randrange(60)}",
                None if rng.random() < 0.5 else f"r{rng.randrange(80)}",
                2011,
                year,
                year + 1,
                False,
            )
        )
    return rows


@pytest.mark.parametrize("tail", [100, 0])
def test_hot_group_duplicates(spark, no_broadcast, tail):
    rows = hot_rows(1)
    df = spark.createDataFrame(rows, COLUMNS).repartition(8)
    out = duplicates.find_duplicates(df, 20, tail).filter("gen_is_duplicate")
    got = {r.id: (r.gen_duplicate_via, r.gen_duplicate_source_id) for r in out.collect()}
    assert got == brute.duplicates(as_dicts(rows))


@pytest.mark.parametrize("tail", [100, 0])
def test_hot_group_amendments(spark, no_broadcast, tail):
    rows = [(*r, False) for r in hot_rows(2)]
    df = spark.createDataFrame(rows, COLUMNS + ", gen_is_duplicate boolean").repartition(8)
    out = amendments.find_amendments(df, 20, tail).filter("gen_amendment_group_id is not null")
    got = {r.id: (r.gen_is_amendment, r.gen_amendment_group_id) for r in out.collect()}
    assert got == brute.amendments(as_dicts(rows, [*NAMES, "gen_is_duplicate"]))


def test_yearly_rows_add_up_to_the_totals(spark):
    tables = inputs.store(spark, "/root/testdata/sf0.001")
    totals = tables["exports_v1"].filter("effective_start_year is not null")
    want = totals.selectExpr("sum(effective_total_value)").first()[0]
    got = tables["exports_v2"].selectExpr("sum(yearly_value)").first()[0]
    assert got == pytest.approx(want)


def test_regular_entries_keep_their_value(spark):
    rows = inputs.store(spark, "/root/testdata/sf0.001")["contracts"]
    alone = rows.filter(
        "gen_amendment_group_id is null and not gen_is_duplicate and not gen_is_error"
    )
    off = alone.filter("gen_effective_total_value <> contract_value").count()
    assert off == 0 and alone.count() > 0


def test_members_link_to_their_contract_directly(spark):
    rows = inputs.store(spark, "/root/testdata/sf0.001")["contracts"]
    pivots = rows.filter("id = gen_amendment_group_id").selectExpr(
        "id as pid", "reference_number as pref", "contract_value as pvalue", "gen_start_year as pyear"
    )
    members = rows.filter("gen_is_amendment")
    joined = members.join(pivots, members.gen_amendment_group_id == pivots.pid)
    by_reference = "reference_number <=> pref"
    by_value = "(original_value <=> pvalue and gen_start_year <=> pyear)"
    assert joined.count() == members.count() > 0
    assert joined.filter(f"not ({by_reference} or {by_value})").count() == 0
