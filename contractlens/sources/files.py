"""Contract files: bulk CSV, record JSON, vendor aliases, newest file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractlens import fixed_values as fixed
from contractlens.operators.grouping import numbered
from contractlens.operators.lookup import pairs
from contractlens.schema import PAGE_METADATA, RECORD_JSON
from contractlens.session import cut_lineage, small_side
from contractlens.sources.split_csv import csv_records, parse_records

RAW_CSV = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(fixed.CSV_WIDTH)])


def csv_columns() -> dict[str, str]:
    """Raw column -> field, by position in the file."""
    return {f"c{position}": field for position, field in pairs(fixed.CSV_POSITIONS).items()}


def scan_contract_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Bulk rows by position, header skipped, with the file and the row's place in it.

    Quoted line ends need `multi_line`; the rows before a row's range are known then too.
    Files are split either way, so one large file is read by many tasks.
    """
    if multi_line:
        raw = parse_records(csv_records(spark, path), RAW_CSV).filter("block_start > 0 OR place > 0")
        position, known = F.col("place"), ["rows_before"]
    else:
        reader = spark.read.schema(RAW_CSV).option("header", True).option("enforceSchema", True)
        raw = reader.option("escape", '"').option("mode", "PERMISSIVE").csv(path).withColumns(
            {"file_path": F.col("_metadata.file_path"), "block_start": F.col("_metadata.file_block_start")}
        )
        position, known = F.monotonically_increasing_id(), []
    fields = [F.coalesce(F.col(raw_name), F.lit("")).alias(name) for raw_name, name in csv_columns().items()]
    return raw.select(*fields, "file_path", "block_start", position.alias("scan_position"), *known)


def with_row_numbers(rows: DataFrame, first: int = 2) -> DataFrame:
    """Number bulk rows through all files in path order; the header line is row 1.

    Inside one file block the scan position already counts up by one, so only a small
    table of blocks (one row per block, not per record) is ordered. Where the scan has
    counted the rows of the blocks, nothing is read for it.
    """
    kept = [c for c in rows.columns if c not in ("block_start", "scan_position", "rows_before")]
    if "rows_before" in rows.columns:
        return rows.select(*kept, (F.col("rows_before") + F.col("scan_position") + first).alias("row_number"))
    blocks = rows.groupBy("file_path", "block_start").agg(
        F.min("scan_position").alias("_low"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.orderBy("file_path", "block_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("file_path").alias("_f"),
        F.col("block_start").alias("_b"),
        "_low",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    joined = rows.join(
        small_side(cut_lineage(offsets)),
        (F.col("file_path") == F.col("_f")) & (F.col("block_start") == F.col("_b")),
    )
    number = F.col("_before") + F.col("scan_position") - F.col("_low") + first
    return joined.select(*kept, number.alias("row_number"))


def scan_contract_json(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Records under owner folders: <path>/<owner>/<name>.json, one object per file."""
    return (
        spark.read.schema(RECORD_JSON)
        .option("multiLine", one_per_file)
        .option("recursiveFileLookup", True)
        .json(path)
        .select("*", F.col("_metadata.file_name").alias("file_name"))
    )


def with_file_sequence(records: DataFrame) -> DataFrame:
    """Per owner, number the files by name; ids look like 'tbs-0000000012'.

    File names are md5 hex, so their first letters spread an owner over many tasks.
    """
    bucket = F.substring("file_name", 1, 3)
    out = numbered(records, ["ownerAcronym"], ["file_name"], bucket, "file_sequence")
    label = F.concat_ws("-", "ownerAcronym", F.lpad(F.col("file_sequence").cast("string"), 10, "0"))
    return out.withColumn("gen_contract_id", label)


def scan_page_metadata(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(PAGE_METADATA)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(path)
    )


def scan_vendor_aliases(spark: SparkSession, path: str) -> DataFrame:
    """(parent_company, company_name, position) of the alias file, in file order."""
    rows = (
        spark.read.schema("parent_company string, company_name string")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return rows.withColumn("position", F.monotonically_increasing_id())


def latest_file(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """(path, modificationTime) of the newest file. Only file listings are read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .load(folder)
        .select("path", "modificationTime")
    )
    return files.orderBy(F.desc("modificationTime"), F.desc("path")).limit(1)
