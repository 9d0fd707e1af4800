"""Exact duplicates with a split at the heavy hitters, built-in functions only.

A Misra-Gries summary (Spark's approx_top_k keeps such counters: a bounded number,
lowered together when they run out) names the digests that may be frequent. An exact
count verifies them; the verified winners are few and meet their copies on the map side
by broadcast. Only the remaining digests, none of which is frequent, are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.llm.common import ASCII_LOWER, ASCII_UPPER, id_and_text, without_marked
from contractlens.session import cut_lineage

#: Digests that may be broadcast at most: the bound of the winners' table.
HEAVY = 1024
#: Counters of the summary; the count of a digest is off by a small multiple of
#: rows / COUNTERS, so whatever holds more than rows / HEAVY rows is among the first.
COUNTERS = 16_384
#: Groups below this size are left to the shuffle.
LEAST_COPIES = 64


def normalised(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


def _outcome(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY,
    counters: int = COUNTERS, least_copies: int = LEAST_COPIES,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical after lower-casing A-Z. The largest doc_id of
    a group stays.

    Defined cases: a null text counts as empty; rows that share the largest id of their
    group are all kept, as an id names one document; rows without an id never stay
    beside rows that have one (a group without any id has a null keep_id and stays);
    further columns are left out; an empty table gives no rows.

    Texts are read once, into a table of ids and digests. Heavy groups never meet in one
    task. Tail groups hold at most about rows / `heavy` rows each; they are counted
    with partial results, and the join of their rows to one row each is one that Spark
    splits where it is uneven.
    """
    plain = id_and_text(docs, id_col, text_col)
    rows = cut_lineage(
        plain.select("doc_id", text_digest(F.col("text")).alias("digest")).withColumn("short", F.xxhash64("digest"))
    )
    # at most `heavy` rows
    often = rows.agg(F.expr(f"approx_top_k(short, {heavy}, {counters})").alias("top")).select(
        F.explode("top").alias("top")
    ).select(F.col("top.item").alias("short"), F.col("top.count").alias("seen"))
    often = often.filter(F.col("seen") >= least_copies).select("short")
    winners = cut_lineage(
        rows.join(F.broadcast(often), "short", "left_semi")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter(F.col("group_size") >= least_copies)
    )
    # several digests of one short hash could exceed the bound only by collisions
    heavy_rows = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners.select("digest")), "digest", "left_anti")
    # counted with partial results; only rows of groups with several meet them again
    several = rest.groupBy(F.col("digest").alias("of")).agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    ).filter("group_size > 1")
    tail_rows = rest.join(several, F.col("digest") == F.col("of"), "left").select(
        "doc_id", "digest",
        F.when(F.col("of").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
    )
    return _outcome(heavy_rows).unionByName(_outcome(tail_rows))


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", one_each: bool = False
) -> DataFrame:
    """The documents that stay, with all their columns, decided by id and text.

    Rows that share the largest id of their group stay, and so do rows without an id; with
    `one_each` exactly one row of each group stays.
    """
    found = exact_duplicates(docs, id_col, text_col).filter("group_size > 1")
    marks = found.groupBy("doc_id", F.unhex("text_sha256").alias("digest")).agg(
        F.bool_or("kept").alias("kept"), F.count(F.lit(1)).alias("n")
    )
    gone = "NOT kept OR n > 1" if one_each else "NOT kept AND doc_id IS NOT NULL"
    digest = text_digest(F.coalesce(F.col(text_col), F.lit("")))
    return without_marked(docs, marks.filter(gone).drop("n"), digest, id_col, text_col)
