"""What the operators share: column checks, worker-wide objects, small batches."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.session import cut_lineage, small_side

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns that the operators read, under fixed names.

    Other columns, whatever their names, are left behind, so they can't clash with the
    columns an operator adds. A null text counts as empty.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


def quoted(name: str) -> str:
    """A column name as Spark reads it, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def without_marked(
    docs: DataFrame, marks: DataFrame, digest: Column, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows, with all their columns, but for those that marks (doc_id, digest, kept;
    one row for each id and digest) name: none of them stays if kept is false, and exactly
    one if it is true. Null ids match each other.

    `digest` is that of the text, of the same kind as in marks. Marks are broadcast while
    they are few (they are counted), so that no text is shuffled; only rows of which one
    stays are, after a first choice on the map side.
    """
    marks = cut_lineage(marks)
    whole = F.struct(*[F.col(quoted(name)) for name in docs.columns])
    rows = docs.select(whole.alias("row"), F.col(id_col).alias("doc_id"), digest.alias("digest"))
    named = small_side(marks.select(F.col("doc_id").alias("of"), F.col("digest").alias("of_digest"), "kept"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest"))
    others = rows.join(named, same, "left_anti").select("row.*")
    several = named.filter("kept")
    if several.isEmpty():
        return others
    chosen = (
        rows.join(several, same, "left_semi")
        .groupBy("doc_id", "digest")
        .agg(F.min_by("row", F.coalesce(F.col("row")[text_col], F.lit(""))).alias("row"))
    )
    return others.unionByName(chosen.select("row.*"))


def per_worker(owner: str, key: tuple, make: Callable[[], object]) -> object:
    """What `make` returns, made once in each Python worker and kept between tasks.

    Only one owner (an operator) has things in a worker at a time: what others left there
    is dropped first, so a job of many steps holds no more than its greediest step.
    Functions travel to the workers by value, so a module global would be made anew for
    every task.
    """
    home = sys.modules.setdefault("_kept_per_worker", types.ModuleType("_kept_per_worker"))
    if getattr(home, "owner", None) != owner:
        home.owner, home.things = owner, {}
    if key not in home.things:
        home.things[key] = make()
    return home.things[key]


def give_back() -> None:
    """Hand memory that a task has freed back to the system. A worker waits for its next
    task beside an executor that may need it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass


def slices(
    batches: Iterator[pa.RecordBatch], rows: int = 512, size: int = 8 << 20
) -> Iterator[pa.RecordBatch]:
    """Smaller batches: few rows or, when rows are long, few bytes, one row at least."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            step = min(rows, batch.num_rows - at)
            part = batch.slice(at, step)
            while step > 1 and part.get_total_buffer_size() and sum(
                c.nbytes for c in part.columns
            ) > size:
                step = max(1, step // 2)
                part = batch.slice(at, step)
            yield part
            at += step
    give_back()
