"""Token files: frequency-ranked ids in byte-aligned codes with separate control bytes.

An id is stored as its rank by frequency, so the most frequent 256 ids take one byte.
Four ranks share a control byte that holds their four lengths; the data bytes follow in
a stream of their own. Decoding looks up the lengths and offsets of four ranks at a time
in a table with 256 rows, with numpy.

A file is a Parquet file of blocks. The fields of a block: part, first (ids of the
same part before the block), doc_ids, lengths (ids per document), control, data. Parts
follow each other in ascending doc_id order, and so do the blocks of a part. The ids by
rank lie in a file beside the blocks, so a folder is read without anything else.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contractlens.llm.common import id_and_text, slices
from contractlens.llm.library_ids import text_encoder
from contractlens.session import scratch_path

#: How the ids are stored: the quick level of zstd.
SMALL = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
#: Ids in a block, unless one document has more.
BLOCK_IDS = 1 << 18

_SHIFTS = np.array([0, 2, 4, 6])
#: By control byte: the four lengths, where each starts, and the sum.
LENGTHS = ((np.arange(256)[:, None] >> _SHIFTS) & 3) + 1
STARTS = np.cumsum(LENGTHS, axis=1) - LENGTHS
TOTALS = LENGTHS.sum(axis=1)
MASKS = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    lengths = np.ones(len(values) + -len(values) % 4, np.uint8)
    for limit in (0xFF, 0xFFFF, 0xFFFFFF):
        lengths[: len(values)] += values > limit
    codes = lengths - np.uint8(1)
    control = codes[::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    lengths = lengths[: len(values)]
    ends = np.cumsum(lengths, dtype=np.int64)
    data = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    places = ends - lengths
    data[places] = values & 0xFF
    longer = np.flatnonzero(lengths > 1)
    for byte in (1, 2, 3):
        data[places[longer] + byte] = (values[longer] >> (8 * byte)) & 0xFF
        longer = longer[lengths[longer] > byte + 1]
    return control.tobytes(), data.tobytes()


def unpack(control: bytes, data: bytes, count: int) -> np.ndarray:
    """The first `count` values."""
    codes = np.frombuffer(control, np.uint8)
    totals = TOTALS[codes]
    quads = np.cumsum(totals) - totals
    places = (quads[:, None] + STARTS[codes]).ravel()[:count]
    padded = np.frombuffer(data + b"\0\0\0\0", np.uint8)
    words = np.ndarray((len(padded) - 3,), "<u4", padded, strides=(1,))
    return words[places] & MASKS[LENGTHS[codes].ravel()[:count]]


def encode_documents(
    docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens and ids (two bytes each if the vocabulary allows, else four) of every
    text; and after each task's texts a row with counts alone, how often it saw each id."""
    with open(vocabulary, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u2" if end_id < 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = text_encoder(vocabulary, content.value), np.zeros(0, np.int64)
        names = ["doc_id", "n_tokens", "ids", "counts"]
        for batch in slices(batches):
            kind = batch.schema.field("doc_id").type
            ids = [np.append(encode(text), end) for text in batch["text"].to_pylist()]
            counts = np.bincount(np.concatenate(ids), minlength=len(seen))
            counts[: len(seen)] += seen
            seen = counts
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([narrow(i) for i in ids], pa.binary()),
                    pa.nulls(len(ids), pa.binary()),
                ],
                names,
            )
        if len(seen):
            columns = [pa.nulls(1, kind), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([seen.astype("<i8").tobytes()], pa.binary())], names)

    plain = id_and_text(docs, id_col, text_col)
    return plain.mapInArrow(
        run, f"doc_id {dict(plain.dtypes)['doc_id']}, n_tokens long, ids binary, counts binary"
    )


def narrow(ids: np.ndarray) -> bytes:
    """A leading byte tells the width: 2 or 4."""
    if ids.dtype.itemsize == 2:
        return b"\2" + ids.tobytes()
    small = len(ids) == 0 or int(ids.max()) < 1 << 16
    return (b"\2" + ids.astype("<u2").tobytes()) if small else (b"\4" + ids.astype("<u4").tobytes())


def widen(stored: bytes) -> np.ndarray:
    return np.frombuffer(stored, f"<u{stored[0]}", offset=1).astype("<u4") if stored else np.zeros(0, "<u4")


def id_counts(encoded: DataFrame) -> DataFrame:
    """id and how often it occurs: one row per id that occurs. Of the encoded texts only the
    tasks' counts are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=8):
            for stored in batch["counts"].to_pylist():
                seen = np.frombuffer(stored, "<i8")
                used = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int64()), pa.array(seen[used], pa.int64())], ["id", "n"]
                )

    counts = encoded.select("counts").filter("counts IS NOT NULL")
    return counts.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id",
    text_col: str = "text", block_ids: int = BLOCK_IDS,
) -> None:
    """Write the blocks (`path`/blocks) and the ids by rank (`path`/ids).

    Every text is encoded once, into a table of its ids, and counted as it is; the counts
    give the ranks. The counts brought to the driver are bounded by the vocabulary. Then the
    ids go once through a shuffle that deals out ranges of doc_id; a task writes its
    range in order, block by block.

    Defined cases: a null text counts as empty and has the end id only; rows without an
    id come first; rows that share an id are ordered by their ids' bytes; an
    empty table gives empty files; further columns are left out.
    """
    spark = docs.sparkSession
    table = scratch_path(spark, "encoded")
    encode_documents(docs, vocabulary, end_id, id_col, text_col).write.options(**SMALL).parquet(table)
    encoded = spark.read.parquet(table)
    ids = id_counts(encoded).orderBy(F.desc("n"), "id").select("id").toArrow()["id"].to_numpy().astype("<u4")
    encoded = encoded.filter("ids IS NOT NULL").select("doc_id", "ids")
    rank = np.zeros(int(ids.max()) + 1 if len(ids) else 1, "<u4")
    rank[ids] = np.arange(len(ids), dtype="<u4")
    shared = spark.sparkContext.broadcast(rank)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, held, size = TaskContext.get().partitionId(), 0, [], 0

        def block():
            control, data = pack(shared.value[np.concatenate([i for _, i in held])])
            lengths = [len(i) for _, i in held]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([[d for d, _ in held]], pa.list_(kind)),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([control], pa.binary()),
                    pa.array([data], pa.binary()),
                ],
                ["part", "first", "doc_ids", "lengths", "control", "data"],
            )

        for batch in slices(batches):
            kind = batch.schema.field("doc_id").type
            for doc, stored in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist(), strict=True):
                found = widen(stored)
                if held and size + len(found) > block_ids:
                    yield block()
                    first, held, size = first + size, [], 0
                held.append((doc, found))
                size += len(found)
        if held:
            yield block()

    kind = dict(encoded.dtypes)["doc_id"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.when(F.lit(True), F.xxhash64("ids"))
    (
        encoded.withColumn("tie", tie)
        .repartitionByRange(parts, "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "ids")
        .select("doc_id", "ids")
        .mapInArrow(
            blocks,
            f"part int, first long, doc_ids array<{kind}>, lengths array<long>, control binary, data binary",
        )
        .write.options(**SMALL)
        .parquet(f"{path}/blocks")
    )
    _check_parts(spark, path)
    table = pa.table({"rank": pa.array(range(len(ids)), pa.int64()), "id": pa.array(ids, pa.int64())})
    spark.createDataFrame(table).coalesce(1).write.parquet(f"{path}/ids")


def _check_parts(spark: SparkSession, path: str) -> None:
    """Parts are numbered by task, which is the order of the ranges only as long as Spark
    neither merges nor reorders them; this says so if that ever changes."""
    known = lambda doc: F.struct(doc.isNotNull().alias("known"), doc.alias("doc"))
    ends = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(
        F.min(known(F.get("doc_ids", F.lit(0)))).alias("low"), F.max(known(F.element_at("doc_ids", -1))).alias("high")
    )
    # one row per part
    before = F.lag("high").over(Window.orderBy("part"))
    if not ends.withColumn("before", before).filter(F.col("before") > F.col("low")).isEmpty():
        raise RuntimeError(f"parts of {path} are not in the order of doc_id")


def read_token_files(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and ids (null
    unless kept).

    Blocks are decoded one at a time by the table of ids, which the vocabulary bounds; the
    totals of the parts, one row each, give the starts.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    ids = spark.read.parquet(f"{path}/ids").orderBy("rank").select("id").toArrow()
    table = spark.sparkContext.broadcast(ids["id"].to_numpy().astype("<u4"))
    kind = dict(blocks.dtypes)["doc_ids"][len("array<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=1):
            part, first, docs, lengths, control, data = (c.to_pylist()[0] for c in batch.columns)
            ends = np.cumsum(lengths)
            values = table.value[unpack(control, data, int(ends[-1]))]
            own = [i.tobytes() for i in np.split(values, ends[:-1])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(docs, batch.schema.field("doc_ids").type.value_type),
                    pa.array([part] * len(docs), pa.int32()),
                    pa.array(first + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(i) for i in own], pa.int64()),
                    pa.array(own if keep_ids else [None] * len(own), pa.binary()),
                ],
                ["doc_id", "part", "inside", "n_tokens", "ids_crc32", "ids"],
            )

    rows = blocks.select("part", "first", "doc_ids", "lengths", "control", "data").mapInArrow(
        run, f"doc_id {kind}, part int, inside long, n_tokens long, ids_crc32 long, ids binary"
    )
    # one row per part, so the window and the broadcast are bounded by the parts
    totals = blocks.select("part", F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    totals = totals.groupBy("part").agg(F.sum("n").alias("n"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(starts), "part").select(
        "doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "ids"
    )


def token_files(docs: DataFrame, vocabulary: str, end_id: int, keep_ids: bool = True) -> DataFrame:
    """Write the files in the shared folder, then read them back."""
    path = scratch_path(docs.sparkSession, "tokens")
    write_token_files(docs, path, vocabulary, end_id)
    return read_token_files(docs.sparkSession, path, keep_ids)
