"""The contracts table of the test data: orders told as contract entries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.session import small_side


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def contracts_view(spark: SparkSession, folder: str) -> DataFrame:
    """One contract entry per order; the SQL twin is in catalog/sql_text.py."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        small_side(nation, 10_000), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("o_orderkey")
    year, quarter = F.year("o_orderdate"), F.quarter("o_orderdate")
    vendor = F.concat_ws(" ", "c_mktsegment", (F.col("c_custkey") % 7).cast("string"))
    suffix = F.when(key % 3 == 0, " LTD").when(key % 3 == 1, ", INC.").otherwise("")
    value = (F.floor(F.col("o_totalprice") / 10000) * 5000).cast("double")
    original = (F.floor(F.col("o_totalprice") / 20000) * 5000).cast("double")
    fiscal = F.concat(
        year.cast("string"),
        F.lpad(((year + 1) % 100).cast("string"), 2, "0"),
        F.lit("-Q"),
        quarter.cast("string"),
    )
    month = F.concat_ws("-", year.cast("string"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"))
    return joined.select(
        key.alias("id"),
        F.lower("n_name").alias("owner_acronym"),
        F.concat(vendor, suffix).alias("vendor_name"),
        vendor.alias("gen_vendor_normalized"),
        value.alias("contract_value"),
        F.when(key % 5 == 0, original).alias("original_value"),
        F.concat(F.lit("R"), (key % 400).cast("string")).alias("reference_number"),
        F.when(key % 11 != 0, month).alias("raw_contract_date"),
        year.cast("int").alias("source_year"),
        quarter.cast("int").alias("source_quarter"),
        F.when(key % 97 != 0, fiscal).alias("source_fiscal"),
        (1 + key % 2).cast("int").alias("source_origin"),
        year.cast("int").alias("gen_start_year"),
        (year + key % 5 - 1).cast("int").alias("gen_end_year"),
    )
