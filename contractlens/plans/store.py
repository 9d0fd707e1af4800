"""The stored tables: contracts with flags, and the two exports.

Reports read these tables, as they are far fewer rows wide than the rules that make
them. Writes replace whole partitions, so a lost executor or a repeated run leaves
the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from contractlens.operators.exports import exports_v1, exports_v2
from contractlens.plans.metadata import update_all_metadata

TABLES = {
    "contracts": ["owner_acronym"],
    "exports_v1": ["owner_acronym"],
    "exports_v2": ["owner_acronym"],
}


def write_partitioned(rows: DataFrame, path: str, columns: list[str]) -> T.StructType:
    """Replace the partitions present in `rows`; returns the schema to read with.

    Rows are brought together by partition value first, so each task writes few
    files; the rebalance splits values that hold many rows over several tasks.
    """
    (
        rows.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )
    return T.StructType([f for f in rows.schema])


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The schema keeps codes that look like numbers as text."""
    return spark.read.schema(schema).parquet(path)


def build_store(spark: SparkSession, contracts: DataFrame, path: str) -> dict[str, DataFrame]:
    """Write the three tables under `path` and return readers of them.

    `contracts` is the loaded table with its error codes.
    """
    out = {}
    rows = update_all_metadata(contracts)
    steps = {
        "contracts": lambda: rows,
        "exports_v1": lambda: exports_v1(out["contracts"]),
        "exports_v2": lambda: exports_v2(out["exports_v1"]),
    }
    for name, make in steps.items():
        target = f"{path}/{name}"
        schema = write_partitioned(make(), target, TABLES[name])
        out[name] = read_partitioned(spark, target, schema)
    return out
