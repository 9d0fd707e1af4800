"""Logged conversations: snapshots collapse into the longest one, which is rendered.

A log that writes a conversation after every reply holds each of its prefixes. Rolling
hashes over the turns name every prefix; a conversation whose own hash is a proper
prefix of another is dropped by an anti-join. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contractlens.session import cut_lineage

TURN = "<|im_start|>{role}\n{text}<|im_end|>\n"
#: Two independent 64-bit hashes of a prefix.
HASH = ["hash_a", "hash_b"]


def _turns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )


def _turn_hash(seed: int) -> Column:
    """Of place, role and text. Hashes of different places are joined by exclusive or."""
    return F.xxhash64(F.lit(seed), F.lit("role"), "role", F.lit("text"), "text", "place")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, place (1 for the first turn) and the rolling hashes up to that turn."""
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text"
    )
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = turns.withColumn("place", F.row_number().over(order))
    placed = placed.select(
        "conv_id", "turn", "role", "place", F.xxhash64("text").alias("text_hash"),
        _turn_hash(1).alias("a"), _turn_hash(2).alias("b"),
    )
    by_place = Window.partitionBy("conv_id").orderBy("place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return placed.select(
        "conv_id",
        "place",
        F.bit_xor("a").over(by_place).alias("hash_a"),
        F.bit_xor("b").over(by_place).alias("hash_b"),
    )


def alone(turns: DataFrame) -> DataFrame:
    """The rows without a conv_id, each as the first turn of a conversation of its own."""
    first = turns.filter("conv_id IS NULL").withColumn("place", F.lit(1))
    return first.withColumn("hash_a", _turn_hash(1)).withColumn("hash_b", _turn_hash(2))


def maximal_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and rolling hashes of the conversations to retain.

    A conversation goes if its turns (role and text, in order) are the first turns of a
    longer one, or equal those of one with a smaller conv_id. n_copies counts equal ones.

    Defined cases: turns are ordered by turn, then role, then text, nulls first; a null
    role or text counts as empty; every row without a conv_id is a conversation of one
    turn; rows repeated within a conversation are turns of their own; further columns
    are left out; an empty table gives no rows.

    Only hashes and places are shuffled after the turns were ordered. Prefixes and whole
    conversations are counted before they meet, so a first turn or a conversation that
    everybody shares is one row on either side of the anti-join.
    """
    turns = _turns(rows)
    marks = cut_lineage(prefixes(turns.filter("conv_id IS NOT NULL")))
    last = marks.groupBy("conv_id").agg(F.max_by(F.struct(*HASH), "place").alias("end"), F.max("place").alias("n_turns"))
    whole = last.select("conv_id", "n_turns", "end.*")
    every = whole.unionByName(alone(turns).select("conv_id", F.col("place").alias("n_turns"), *HASH))
    distinct = every.groupBy("n_turns", *HASH).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")
    )
    # a prefix is proper where the same conversation goes on
    ends = whole.select("conv_id", F.col("n_turns").alias("place"))
    proper = marks.join(ends, ["conv_id", "place"], "left_anti").select(F.col("place").alias("n_turns"), *HASH).distinct()
    return distinct.join(proper, ["n_turns", *HASH], "left_anti").select(
        "conv_id", F.col("n_turns").cast("bigint").alias("n_turns"), "n_copies", *HASH
    )


def format_conversations(rows: DataFrame, template: str = TURN) -> DataFrame:
    """The retained conversations, rendered: conv_id, n_turns, n_copies, rendered.

    `template` has the places {role} and {text} of one turn.
    """
    kept = cut_lineage(maximal_conversations(rows))
    head, rest = template.split("{role}")
    middle, tail = rest.split("{text}")
    turns = _turns(rows)
    texts = (
        turns.join(kept.select("conv_id"), "conv_id", "left_semi")
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    )
    # array_sort puts a null turn last, the order of turns puts it first
    known = F.filter("turns", lambda t: t["turn"].isNotNull())
    unknown = F.filter("turns", lambda t: t["turn"].isNull())
    one = lambda t: F.concat(F.lit(head), t["role"], F.lit(middle), t["text"], F.lit(tail))
    rendered = F.array_join(F.transform(F.concat(unknown, known), one), "")
    texts = texts.select("conv_id", rendered.alias("rendered"))
    columns = ["conv_id", "n_turns", "n_copies", "rendered"]
    # rows without a conv_id are told apart by their hash alone
    singles = alone(turns).groupBy(*HASH).agg(F.min(F.struct("role", "text")).alias("turn"))
    unnamed = kept.filter("conv_id IS NULL").join(singles, HASH).withColumn("rendered", one(F.col("turn")))
    return kept.join(texts, "conv_id").select(*columns).unionByName(unnamed.select(*columns))
