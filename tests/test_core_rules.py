"""Duplicates, amendments and effective values against the row-by-row rules."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from contractlens.operators import amendments, duplicates, effective, grouping

COLUMNS = (
    "id bigint, owner_acronym string, source_fiscal string, contract_value double, "
    "original_value double, gen_vendor_normalized string, raw_contract_date string, "
    "reference_number string, source_year int, gen_start_year int, gen_end_year int, "
    "gen_is_error boolean"
)
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def random_rows(seed, count=400, owners=4):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        year = rng.choice([0, 2010, 2011, 2012, 2013])
        rows.append(
            (
                i,
                f"o{rng.randrange(owners)}",
                None if rng.random() < 0.03 else f"{rng.choice([2010, 2011, 2012])}-Q{rng.randrange(1, 5)}",
                float(rng.choice([10, 20, 30])),
                rng.choice([None, 10.0, 20.0, 30.0]),
                rng.choice(["A", "B", None]),
                rng.choice(["d1", "d2", "d3", "d4", "d5", None]),
                rng.choice(["r1", "r2", "r3", "r4", "r5", "r6", "r7", "r8", None]),
                rng.choice([2010, 2011, 2012, 2013]),
                year,
                year + rng.choice([-1, 0, 1, 2, 4]),
                rng.random() < 0.03,
            )
        )
    return rows


def as_dicts(rows, names=NAMES):
    return [dict(zip(names, r, strict=True)) for r in rows]


# (fold limit, tail rows): all folded, walked as a rest, all by rounds of joins
WAYS = [(512, 0), (0, 1000), (0, 0)]


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("seed", [1, 2])
def test_duplicates(spark, seed, way):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, COLUMNS)
    got = {
        r.id: (r.gen_duplicate_via, r.gen_duplicate_source_id)
        for r in duplicates.find_duplicates(df, *way).filter("gen_is_duplicate").collect()
    }
    assert got == brute.duplicates(as_dicts(rows))


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("seed", [3, 4])
def test_amendments(spark, seed, way):
    rows = random_rows(seed, owners=12)
    rng = random.Random(seed)
    flags = [(*r, rng.random() < 0.1) for r in rows]
    df = spark.createDataFrame(flags, COLUMNS + ", gen_is_duplicate boolean")
    got = {
        r.id: (r.gen_is_amendment, r.gen_amendment_group_id)
        for r in amendments.find_amendments(df, *way)
        .filter("gen_amendment_group_id is not null")
        .collect()
    }
    assert got == brute.amendments(as_dicts(flags, [*NAMES, "gen_is_duplicate"]))


def value_links(seed, count=300):
    """Many chains through original values, few shared references."""
    rng = random.Random(seed)
    return [
        (
            i, "o", f"201{rng.randrange(0, 9)}-Q1", float(rng.randrange(1, 60)),
            rng.choice([None, float(rng.randrange(1, 60))]), f"v{rng.randrange(3)}", None,
            f"r{rng.randrange(150)}", 2012, rng.choice([2011, 2012]), 2013, False, False,
        )
        for i in range(count)
    ]


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_amendments_by_value_chains(spark, seed):
    rows = value_links(seed)
    names = [*NAMES, "gen_is_duplicate"]
    df = spark.createDataFrame(rows, COLUMNS + ", gen_is_duplicate boolean")
    want = brute.amendments(as_dicts(rows, names))
    for way in WAYS:
        got = {
            r.id: (r.gen_is_amendment, r.gen_amendment_group_id)
            for r in amendments.find_amendments(df, *way)
            .filter("gen_amendment_group_id is not null")
            .collect()
        }
        assert got == want


@pytest.mark.parametrize("seed", [8, 9])
def test_effective_values(spark, seed):
    rng = random.Random(seed)
    names = [*NAMES, "gen_is_duplicate", "gen_amendment_group_id"]
    rows = []
    for r in random_rows(seed, 500):
        r = list(r)
        if rng.random() < 0.04:
            r[9] = None
        if rng.random() < 0.04:
            r[10] = None
        rows.append((*r, rng.random() < 0.05, rng.choice([None, *range(60)])))
    df = spark.createDataFrame(
        rows, COLUMNS + ", gen_is_duplicate boolean, gen_amendment_group_id bigint"
    )
    got = {}
    out = effective.effective_values(df)
    valid = "not gen_is_duplicate and not gen_is_error and source_fiscal is not null"
    for r in out.filter(valid).collect():
        got[r.id] = tuple(r[c] for c in effective.ADDED)
    want = brute.effective(as_dicts(rows, names))
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values), key


def golden(spark, rows):
    """(start, end, source_year, value) entries of one group, in fiscal order."""
    data = [
        (i, f"{2010 + i}-Q1", float(value), None, source, start, end, False, False, 0)
        for i, (start, end, source, value) in enumerate(rows)
    ]
    df = spark.createDataFrame(
        data,
        "id bigint, source_fiscal string, contract_value double, original_value double, "
        "source_year int, gen_start_year int, gen_end_year int, gen_is_error boolean, "
        "gen_is_duplicate boolean, gen_amendment_group_id bigint",
    )
    out = effective.effective_values(df).orderBy("id").collect()
    return [tuple(r[c] for c in effective.ADDED[:4]) for r in out]


def test_hole_between_owned_years(spark):
    got = golden(
        spark, [(2010, 2014, 2010, 50000), (2010, 2012, 2011, 60000), (2010, 2014, 2014, 90000)]
    )
    assert got == [
        (2010, 2013, 40000.0, 10000.0),
        (2011, 2012, 20000.0, 10000.0),
        (2014, 2014, 30000.0, 30000.0),
    ]


def test_negative_rest(spark):
    got = golden(spark, [(2010, 2012, 2010, 90000), (2010, 2014, 2013, 30000)])
    assert got[0] == (2010, 2012, 90000.0, 30000.0)
    assert got[1] == (2013, 2014, -60000.0, -30000.0)


def test_overridden_in_the_same_year(spark):
    got = golden(
        spark, [(2010, 2012, 2010, 30000), (2010, 2012, 2011, 40000), (2010, 2012, 2011, 50000)]
    )
    assert got[1] == (None, None, 0.0, 0.0)


def test_contract_that_shrinks(spark):
    got = golden(spark, [(2010, 2014, 2010, 50000), (2010, 2011, 2011, 20000)])
    assert got[0][:2] == (2010, 2010)
    assert got[1][:2] == (2011, 2011)


def test_end_before_start_is_repaired(spark):
    got = golden(spark, [(2012, 2010, 2014, 30000)])
    assert got == [(2012, 2014, 30000.0, 10000.0)]


def test_results_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame(random_rows(11), COLUMNS)
    one = duplicates.find_duplicates(df.coalesce(1)).orderBy("id").collect()
    many = duplicates.find_duplicates(df.repartition(13, F.rand(3))).orderBy("id").collect()
    assert one == many


def test_key_structs_meet_by_hash_and_value(spark):
    keys = [("a", 0.0, None), ("a", -0.0, None), ("a", 0.0, "x"), (None, None, None), ("b", float("nan"), "x")]
    left = spark.createDataFrame(keys, "o string, v double, r string").select(F.struct("o", "v", "r").alias("left"))
    right = left.withColumnRenamed("left", "right")
    plain = left.join(right, F.col("left").eqNullSafe(F.col("right")))
    hashed = left.join(right.hint("merge"), grouping.same_key(F.col("left"), F.col("right")))
    assert sorted(map(str, hashed.collect())) == sorted(map(str, plain.collect()))
    assert hashed.count() == 7
    assert "xxhash64" in hashed._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin")[1].split("]")[0]
