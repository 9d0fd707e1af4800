"""Shards by jump consistent hashing, with built-in functions only.

A document's shard follows from its key and the number of shards. When shards are
appended, a row either stays where it is or goes to a new shard, and only the necessary
share of rows moves; no ring table is kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contractlens.session import cut_lineage

# Fixed values of the published algorithm.
MULTIPLIER = 2862933555777941757
WORD = 2**64
#: Jumps made for every row; a row that needs more (next to none) takes the full walk.
USUAL_JUMPS = 64
#: Rows of one shard that are numbered together.
CHUNK_ROWS = 20_000
#: Copies of one row that a task spells out.
COPIES = 10_000


def number(value: int) -> Column:
    return F.lit(str(value)).cast("decimal(20,0)")


def unsigned(key: Column) -> Column:
    """A 64-bit key as a number from 0 to 2**64 - 1. A null key counts as 0."""
    wide = F.coalesce(key.cast("bigint"), F.lit(0)).cast("decimal(20,0)")
    return F.when(wide < 0, wide + number(WORD)).otherwise(wide).cast("decimal(20,0)")


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to shards - 1, of a key from 0 to 2**64 - 1 (decimal).

    Multiplication modulo 2**64 is exact in 38 decimal digits, where 64-bit integers
    would overflow.
    """
    if shards < 1:
        raise ValueError("there must be a shard")

    def jump(state: Column, _: Column) -> Column:
        product = state["key"] * number(MULTIPLIER) + F.lit(1)
        step = (product % number(WORD)).cast("decimal(20,0)")
        high = F.floor(step / number(2**33)).cast("double")
        target = (state["target"] + 1) * (F.lit(float(2**31)) / (high + 1))
        return F.when(state["target"] >= shards, state).otherwise(
            F.struct(
                state["target"].alias("shard"),
                F.least(F.floor(target), F.lit(shards)).cast("bigint").alias("target"),
                step.alias("key"),
            )
        )

    def walk(state: Column, jumps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(jumps)), state, jump)

    start = F.struct(
        F.lit(-1).cast("bigint").alias("shard"), F.lit(0).cast("bigint").alias("target"), key.alias("key")
    )
    usual = walk(start, min(shards, USUAL_JUMPS))
    if shards > USUAL_JUMPS:
        usual = F.when(usual["target"] >= shards, usual).otherwise(walk(start, shards))
    return usual["shard"].cast("int")


def assign_shards(
    docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
    chunk_rows: int = CHUNK_ROWS, copies: int = COPIES,
) -> DataFrame:
    """Shard, slot and next home of every row.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, law ("key"), shard, slot and
    grown_shard (the shard if there were one more). Slots number the rows of a shard
    without gaps from 0.

    Defined cases: a null text has size 1 and checksum 0, like an empty one; rows
    without an id are placed like id 0; repeated rows get slots of their own; further
    columns are left out; an empty table gives no rows.

    The text is read once. Equal rows are counted before they are numbered, so a row
    repeated any number of times is one entry; entries are numbered within chunks of a
    shard, and the chunks' totals give each chunk its first slot. No task sees a whole
    shard, and rows with more copies than `copies` are spelled out by many tasks.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = unsigned(F.col(id_col))
    rows = cut_lineage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            jump_hash(key, shards).alias("shard"),
            jump_hash(key, shards + 1).alias("grown_shard"),
        )
    )
    chunks = max(1, math.ceil(rows.count() / (shards * chunk_rows)))
    entries = (
        rows.groupBy("doc_id", "size", "text_crc32", "shard", "grown_shard")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn(
            "chunk",
            F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(chunks)),
        )
    )
    inside = Window.partitionBy("shard", "chunk").orderBy("doc_id", "size", "text_crc32")
    before = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = entries.withColumn("place", F.sum("copies").over(before) - F.col("copies"))
    totals = entries.groupBy("shard", "chunk").agg(F.sum("copies").alias("total"))
    order = Window.partitionBy("shard").orderBy("chunk")
    firsts = totals.select(
        "shard",
        "chunk",
        (F.sum("total").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("total")).alias("first"),
    )
    placed = numbered.join(firsts, ["shard", "chunk"]).withColumn("slot", F.col("first") + F.col("place"))
    placed = placed.select("doc_id", "size", "text_crc32", "shard", "grown_shard", "slot", "copies")
    often = placed.filter(F.col("copies") > copies)
    if not entries.filter(F.col("copies") > copies).isEmpty():
        placed = placed.filter(F.col("copies") <= copies).unionByName(_in_blocks(often, copies))
    return placed.withColumn("slot", F.explode(F.sequence("slot", F.col("slot") + F.col("copies") - 1))).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.col("slot").cast("bigint").alias("slot"),
        "grown_shard",
    )


def _in_blocks(rows: DataFrame, copies: int) -> DataFrame:
    """Rows of at most `copies` copies each, dealt out over all tasks."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    end = F.col("slot") + F.col("copies")
    starts = F.sequence("slot", end - 1, F.lit(copies).cast("bigint"))
    blocks = rows.select("*", end.alias("end"), F.explode(starts).alias("start"))
    blocks = blocks.repartition(parts, "shard", "start")
    held = F.least(F.lit(copies).cast("bigint"), F.col("end") - F.col("start"))
    return blocks.withColumn("copies", held).withColumn("slot", F.col("start")).drop("start", "end")
