"""Registered queries next to their SQL checks, on the small tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry
from contractlens.catalog import all_oracles as oracle_sql
from contractlens.catalog import all_queries as queries
from check_oracles import compare

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_a_check():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(queries()))
def test_same_rows(spark, tables, name):
    state, _, _, note = compare(spark, tables, FOLDER, name, queries()[name], oracle_sql()[name])
    assert state == "ok", note


def test_entry(spark):
    out = entry(spark)
    assert out.columns == ["effective_year", "sum_yearly_value"]
