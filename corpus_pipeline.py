"""From raw documents to training sequences, in stages.

Each stage reads what the one before kept; all but the last return the columns of
documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.llm.common import read
from contractlens.llm.exact_dedup import drop_exact_duplicates
from contractlens.llm.near_dedup import drop_near_duplicates
from contractlens.llm.packing import pack_documents
from contractlens.llm.toxicity import drop_toxic
from contractlens.session import cut_lineage

#: Words that a worker keeps in mind while it packs: fewer than packing alone would, as
#: executors are full when the last stage starts.
PACKING_WORDS = 250_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the marks, does not reject.

    Null and empty texts are decided by the classifier's bias, long ones as a whole, repeated
    rows alike; further columns pass through; an empty table stays empty.
    """
    return drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z in lower case) the one with the largest doc_id.

    Null and empty texts are one group. Of repeated rows, and of equal texts without an id,
    exactly one stays; further columns pass through; an empty table stays empty.
    """
    return drop_exact_duplicates(docs, one_each=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id.

    Texts without words are like nothing but equal rows, of which one stays; rows without an
    id go before rows that have one; further columns pass through; an empty table
    stays empty.
    """
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of training sequences.

    A null or empty text is the end id alone; a long text is cut into pieces; repeated rows
    are packed each; further columns are left out; an empty table gives no pieces.
    """
    path = public_tokenizers.path("byte_bpe_50k.json")
    pieces = pack_documents(docs, path, end_id=1, words=PACKING_WORDS)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "context",
        "step_group",
    )


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: SQL can express neither the classifier nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
