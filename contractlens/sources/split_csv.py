"""CSV files with quoted line ends, split into ranges that are read by many tasks.

A reader that starts in the middle of a file can't know whether it is inside quotes. But
what a range of lines does to that state can be told without knowing it: for each of the
two states at its start there is one state at its end. Every range is summarised like
that, the summaries, two states and two counts a range, are composed in the order of the file, and
then each range knows its start and cuts its own records. A record that crosses into
the next ranges is put together from the pieces that they report, at most two a range.

Spark's text source deals out the ranges (one line belongs to one of them), so nothing
is shuffled but the pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractlens.session import cut_lineage

QUOTE = '"'
#: Lines that are no records.
BLANK = ("", "\r")


def ends_inside(line: str, inside: bool, separator: str = ",") -> bool:
    """Whether the reader is inside quotes after a line.

    A quote opens a field only as its first sign; inside, two quotes are one sign, and
    after the closing one the rest of the field is plain.
    """
    # a pair of quotes changes no state: inside it is one sign, outside it opens and closes
    line, opens = line.replace(QUOTE + QUOTE, ""), separator + QUOTE
    at = 0
    if not inside:
        if line.startswith(QUOTE):
            at = 1
        else:
            at = line.find(opens)
            if at < 0:
                return False
            at += len(opens)
    while True:
        at = line.find(QUOTE, at)
        if at < 0:
            return True
        at = line.find(opens, at + 1)
        if at < 0:
            return False
        at += len(opens)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """line, file_path and block_start of all lines, in order within a range."""
    raw = spark.read.option("lineSep", "\n").text(path)
    return raw.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, list]]:
    """The lines of one batch, range by range: file_path, block_start, lines and, if given,
    the state at the range's start."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts, lines = batch["file_path"], batch["block_start"].to_numpy(), batch["line"]
        names = files.dictionary_encode().indices.to_numpy()
        turns = np.flatnonzero((np.diff(starts) != 0) | (np.diff(names) != 0)) + 1
        bounds = [0, *turns.tolist(), batch.num_rows]
        for first, last in pairwise(bounds):
            inside = batch["inside"][first].as_py() if "inside" in batch.schema.names else False
            yield files[first].as_py(), int(starts[first]), lines[first:last].to_pylist(), inside


def range_effects(lines: DataFrame, separator: str = ",") -> DataFrame:
    """file_path and block_start of all ranges and, for both states at the range's start, the
    state at its end and the number of records that start in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple[bool, bool, int, int]] = {}
        for file, start, rows, _ in _ranges(batches):
            one, two, n_one, n_two = held.get((file, start), (False, True, 0, 0))
            for line in rows:
                if line not in BLANK:
                    n_one += not one
                    n_two += not two
                if QUOTE in line:
                    same = one == two
                    one = ends_inside(line, one, separator)
                    two = one if same else ends_inside(line, two, separator)
            held[(file, start)] = one, two, n_one, n_two
        kinds = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
        rows = [(*of, *found) for of, found in held.items()]
        columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
        names = ["file_path", "block_start", "from_outside", "from_inside", "n_outside", "n_inside"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return lines.select("line", "file_path", "block_start").mapInArrow(
        run,
        "file_path string, block_start long, from_outside boolean, from_inside boolean, n_outside long, n_inside long",
    )


def range_states(effects: DataFrame) -> DataFrame:
    """file_path, block_start, inside (the state at the range's start), after (at its end) and
    rows_before of all ranges.

    The composition along a file: a range that ends the same way from both states forgets
    what was before it, so the state after a range is that of the last such range, swapped
    once for each swapping range since. rows_before and the place of a record in its range
    count the rows of all files in path order from 0, without the first record of each file.
    """
    order = Window.partitionBy("file_path").orderBy("block_start")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sure = F.col("from_outside") == F.col("from_inside")
    swaps = F.coalesce(F.col("from_outside") & ~F.col("from_inside"), F.lit(False)).cast("long")
    rows = effects.withColumn("swapped", F.sum(swaps).over(so_far)).withColumn(
        "settled", F.last(F.when(sure, F.struct("from_outside", "swapped")), ignorenulls=True).over(so_far)
    )
    since = F.col("swapped") - F.coalesce(F.col("settled.swapped"), F.lit(0))
    start = F.coalesce(F.col("settled.from_outside"), F.lit(False))
    rows = rows.withColumn("after", F.when(since % 2 == 1, ~start).otherwise(start))
    rows = rows.withColumn("inside", F.coalesce(F.lag("after").over(order), F.lit(False)))
    rows = rows.withColumn("n", F.when(F.col("inside"), F.col("n_inside")).otherwise(F.col("n_outside")))
    # one row for each range, as large as a block of the file system
    all_so_far = Window.orderBy("file_path", "block_start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    headed = ((F.col("block_start") == 0) & (F.col("n") > 0)).cast("long")
    before = F.sum("n").over(all_so_far) - F.col("n") - F.sum(headed).over(all_so_far)
    return rows.select("file_path", "block_start", "inside", "after", before.alias("rows_before"))


def _cut(lines: DataFrame, separator: str) -> DataFrame:
    """file_path, block_start, place and record of the records of each range; kind tells
    whole records (0) from the piece that a range starts with (1: it ends there, 2: it goes
    on) and the one that it leaves open (3). lines has `inside`, the state at the start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, place, inside, head, open_lines = None, 0, False, False, []
        out: list[tuple] = []

        def left() -> None:
            if open_lines or head:
                out.append((place, 2 if head else 3, "\n".join(open_lines)))

        def block() -> pa.RecordBatch:
            places, kinds, records = zip(*out, strict=True) if out else ([], [], [])
            file, start = here or ("", 0)
            columns = [
                pa.repeat(pa.scalar(file, pa.string()), len(out)), pa.repeat(pa.scalar(start, pa.int64()), len(out)),
                pa.array(places, pa.int64()), pa.array(kinds, pa.int32()), pa.array(records, pa.string()),
            ]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, ["file_path", "block_start", "place", "kind", "record"])

        for file, start, rows, starts_inside in _ranges(batches):
            if here != (file, start):
                if here is not None:
                    left()
                    yield block()
                here, place, inside, open_lines = (file, start), 0, starts_inside, []
                head = inside
            for line in rows:
                if QUOTE in line:
                    inside = ends_inside(line, inside, separator)
                if inside or head or open_lines:
                    open_lines.append(line)
                    if not inside:
                        out.append((place, 1 if head else 0, "\n".join(open_lines)))
                        place += not head
                        head, open_lines = False, []
                elif line not in BLANK:
                    out.append((place, 0, line))
                    place += 1
            if len(out) >= 1024:
                yield block()
        if here is not None:
            left()
        yield block()

    return lines.select("line", "inside", "file_path", "block_start").mapInArrow(
        run, "file_path string, block_start long, place long, kind int, record string"
    )


def _joined(pieces: DataFrame) -> DataFrame:
    """Whole records of the pieces: an open one, and those that start the next ranges up to
    the one where it ends. They belong to the range where they start."""
    order = Window.partitionBy("file_path").orderBy("block_start", "kind").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    opened = F.when(F.col("kind") == 3, F.struct("block_start", "place"))
    owned = pieces.withColumn("owner", F.last(opened, ignorenulls=True).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block_start", "record")))
    return owned.groupBy("file_path", "owner").agg(parts.alias("parts")).select(
        "file_path", F.col("owner.block_start").alias("block_start"), F.col("owner.place").alias("place"),
        F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"),
    )


def csv_records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """file_path, block_start (of the range where it starts), place (there), rows_before (see
    range_states) and record, the text of a whole record, of all files under the path. Empty
    lines are no records.

    All lines are read for the ranges' effects and numbers of records, and once more, without
    a shuffle. The ranges are broadcast: a row for each, and a range is as large as a block of
    the file system.
    """
    lines = _lines(spark, path)
    states = cut_lineage(range_states(range_effects(lines, separator)))
    starts = states.filter("inside").select("file_path", "block_start", "inside")
    known = lines.join(F.broadcast(starts), ["file_path", "block_start"], "left").withColumn(
        "inside", F.coalesce("inside", F.lit(False))
    )
    records = _cut(known, separator).filter("kind = 0").drop("kind")
    crossed = states.filter("inside OR after")
    if not crossed.isEmpty():
        some = known.join(F.broadcast(crossed.select("file_path", "block_start")), ["file_path", "block_start"], "left_semi")
        records = records.unionByName(_joined(cut_lineage(_cut(some, separator).filter("kind <> 0"))))
    numbers = F.broadcast(states.select("file_path", "block_start", "rows_before"))
    return records.join(numbers, ["file_path", "block_start"]).withColumn("record", F.regexp_replace("record", r"\r$", ""))


def parse_records(records: DataFrame, schema: T.StructType, separator: str = ",") -> DataFrame:
    """The records' fields by position, missing ones null, beside the other columns."""
    kept = [name for name in records.columns if name != "record"]
    options = {"sep": separator, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "mode": "PERMISSIVE"}
    fields = F.from_csv("record", schema.simpleString()[len("struct<") : -1].replace(":", " "), options)
    return records.select(fields.alias("row"), *kept).select("row.*", *kept)
