"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing cuts a text into short phrases: neighbouring names are
compared, the lowest bit in which a name differs from its left neighbour gives it a
label, labels are labelled again until six are left, and a phrase starts at every local
maximum. A phrase's name is a hash of the names inside; phrases are the letters of the
next level, about three times as long each. Whether a phrase starts at a place depends
on a few names around it only, so equal substrings have equal phrases inside, wherever
they stand.

A fingerprint holds the names of the phrases of two levels, as one-permutation MinHash
sketches of 64 16-bit values.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.llm.common import id_and_text, slices
from contractlens.session import cut_lineage

LEVELS = 4
#: Values in a sketch, and phrases that a level must have to be the upper one.
BINS, LEAST_PHRASES = 64, 24
EMPTY = 0xFFFF
#: Ranges of ids at most; their bounds come to the driver.
MOST_RANGES = 20_000
#: Characters that are parsed together.
BATCH_CHARS = 1 << 18
#: Rows of one id from which on it has ranges of its own, and of one such range about; the
#: beginnings of texts that such ranges are cut by, sampled for each range; and more
#: parts than an id can have.
TIES, BEGINNING, SAMPLED, MOST_PARTS = 20_000, 48, 50.0, 1 << 40
#: Copies of a result that a task spells out.
COPIES = 10_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _toss(now: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Twice the place of the lowest bit in which two numbers differ, plus that bit of
    `now`."""
    differ = now ^ before
    low = differ & (~differ + differ.dtype.type(1))
    place = np.bitwise_count(low - differ.dtype.type(1))
    return 2 * place + ((now & low) != 0)


def _table(size: int) -> np.ndarray:
    """Labels of labels, by left neighbour * size + own."""
    own, left = np.arange(size * size, dtype=np.uint16) % size, np.arange(size * size, dtype=np.uint16) // size
    return np.where(own == left, 0, _toss(own, left)).astype(np.uint8)


#: 64-bit names give labels below 128; those give 14, 8 and 6 labels.
TABLES = [(size, _table(size)) for size in (128, 14, 8)]
#: Factors by place in a phrase.
FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def labels(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Labels 0 to 5; neighbours in one document have different ones."""
    left = np.empty_like(names)
    left[1:] = names[:-1]
    left[starts] = names[starts] ^ np.uint64(1)
    out = _toss(names, left).astype(np.uint8)
    for size, table in TABLES:
        index = out.astype(np.uint16)
        index[1:] += out[:-1].astype(np.uint16) * np.uint16(size)
        first = out[starts].astype(np.uint16)
        index[starts] = first + (first ^ 1) * np.uint16(size)
        out = table[index]
    return out


def next_level(names: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases, and the places where documents start among them.

    `starts` are the places of the first names of documents, none of which is empty. A
    run of one name is one letter first, named by the name and the length of the run.
    """
    fresh = np.ones(len(names), bool)
    fresh[1:] = names[1:] != names[:-1]
    fresh[starts] = True
    places = np.flatnonzero(fresh)
    if len(places) < len(names):
        lengths = np.diff(places, append=len(names))
        starts = np.searchsorted(places, starts)
        names = names[places]
        runs = lengths > 1
        names[runs] = mix(names[runs] * np.uint64(3) + lengths[runs].astype(np.uint64))
    label = labels(names, starts)
    # -1 outside of the document, so that its ends can be maxima like any other place
    left, right = np.empty(len(label), np.int8), np.empty(len(label), np.int8)
    left[1:], right[:-1] = label[:-1], label[1:]
    left[starts], right[starts[1:] - 1], right[-1] = -1, -1, -1
    begins = (label > left) & (label > right)
    begins[starts] = True
    places = np.flatnonzero(begins)
    inside = np.arange(len(names)) - np.repeat(places, np.diff(places, append=len(names)))
    total = np.add.reduceat(names * FACTORS[np.minimum(inside, 63)], places)
    return mix(total), np.searchsorted(places, starts)


def sketches(names: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A row of BINS values for every document."""
    count = len(starts)
    doc = np.repeat(np.arange(count), np.diff(starts, append=len(names)))
    hashed = mix(names + np.uint64(0x9E3779B97F4A7C15))
    out = np.full(count * BINS, EMPTY, np.uint16)
    values = ((hashed >> np.uint64(40)) % np.uint64(EMPTY)).astype(np.uint16)
    np.minimum.at(out, doc * BINS + (hashed >> np.uint64(58)).astype(np.int64), values)
    return out.reshape(count, BINS)


def fingerprints(texts: list[str]) -> list[str]:
    """"upper level.sketch.sketch of the level below"; of an empty text, "".

    The upper level is the highest with LEAST_PHRASES phrases, or else the first.
    """
    full = [i for i, text in enumerate(texts) if text]
    out = [""] * len(texts)
    if not full:
        return out
    points = [np.frombuffer(texts[i].encode("utf-32-le"), "<u4") for i in full]
    starts = np.cumsum([0, *(len(p) for p in points[:-1])])
    names = mix(np.concatenate(points).astype(np.uint64) + np.uint64(1))
    levels, upper = [sketches(names, starts)], np.ones(len(full), np.int64)
    for level in range(1, LEVELS + 1):
        names, starts = next_level(names, starts)
        levels.append(sketches(names, starts))
        phrases = np.diff(starts, append=len(names))
        upper[phrases >= LEAST_PHRASES] = level
    for row, i in enumerate(full):
        top = int(upper[row])
        parts = (base64.b64encode(levels[n][row].astype("<u2").tobytes()).decode() for n in (top, top - 1))
        out[i] = ".".join([str(top), *parts])
    return out


def _parsed(fingerprint: str) -> dict[int, np.ndarray]:
    if not fingerprint:
        return {}
    top, *parts = fingerprint.split(".")
    return {int(top) - n: np.frombuffer(base64.b64decode(p), "<u2") for n, p in enumerate(parts)}


def likeness(one: str, two: str) -> float:
    """Estimated share of common phrases, 0 to 1, at the highest level that both have.

    1 for equal fingerprints, those of empty texts too; 0 if the levels are so far apart
    that one text is many times as long as the other.
    """
    if one == two:
        return 1.0
    a, b = _parsed(one), _parsed(two)
    common = a.keys() & b.keys()
    if not common:
        return 0.0
    level = max(common)
    x, y = a[level], b[level]
    some = (x != EMPTY) | (y != EMPTY)
    return float(((x == y) & some).sum() / max(1, some.sum()))


def fingerprint_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars (code points) and fingerprint of every text. No shuffle.

    Defined cases: a null text counts as empty; the fingerprint of an empty text is
    empty; repeated rows are fingerprinted each; further columns are left out; an empty
    table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=BATCH_CHARS):
            texts = batch["text"].to_pylist()
            columns = [pa.array([len(t) for t in texts], pa.int64()), pa.array(fingerprints(texts), pa.string())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", "n_chars", "fingerprint"])

    plain = id_and_text(docs, id_col, text_col)
    return plain.mapInArrow(run, f"doc_id {dict(plain.dtypes)['doc_id']}, n_chars long, fingerprint string")


def _literal(numbers: list) -> Column:
    return F.expr(f"array({', '.join(f'{n}L' for n in numbers)})")


def _range_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many bounds are at most doc_id; 0 for a null. Looked up in two steps, each of
    the square root of the number of bounds."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda numbers: F.size(F.filter(numbers, lambda b: b <= doc_id))
    coarse = below(_literal([g[0] for g in groups]))
    nested = F.expr("array(" + ", ".join(f"array({', '.join(f'{n}L' for n in g)})" for g in groups) + ")")
    fine = (coarse - 1) * step + below(F.element_at(nested, coarse))
    return F.when(doc_id.isNull() | (coarse == 0), 0).otherwise(fine)


@dataclass
class Hot:
    """Ids that more than `ties` rows have, and whether so many rows have none."""

    ids: list[int]
    nulls: bool
    ties: int

    def __bool__(self) -> bool:
        return bool(self.ids) or self.nulls


def _most_ranges(spark: SparkSession) -> int:
    return min(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_RANGES)


def hot_ids(docs: DataFrame, id_col: str = "doc_id", ties: int = TIES) -> Hot:
    """Ids with more rows than a range should have; at most as many as there are ranges."""
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc_id"))
    ties = max(ties, ids.count() // _most_ranges(docs.sparkSession))
    found = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > ties).collect()
    known = sorted(row.doc_id for row in found if row.doc_id is not None)
    return Hot(known, len(known) < len(found), ties)


def _hot_runs(rows: DataFrame, ties: int) -> DataFrame:
    """doc_id, text, copies and part of the rows of hot ids: equal rows once, and the texts
    of an id in parts by their beginnings, in order.

    The beginnings between parts come from a sample by hash, a few for each part; they
    decide where a part ends and nothing else.
    """
    runs = cut_lineage(rows.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies")))
    start = F.substring("text", 1, BEGINNING)
    sizes = runs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    place = F.pmod(F.xxhash64("text", F.lit("part")), F.lit(1 << 30))
    share = F.least(F.lit(1.0), F.lit(SAMPLED) / F.lit(float(ties)) + F.lit(20.0) / F.col("n"))
    chosen = runs.join(F.broadcast(sizes.withColumnRenamed("doc_id", "of")), F.col("doc_id").eqNullSafe(F.col("of")))
    sample = defaultdict(list)
    for row in chosen.filter(place < share * (1 << 30)).select("doc_id", "n", start.alias("start")).collect():
        sample[(row.doc_id, row.n)].append(row.start)
    part = F.lit(0)
    for (doc, n), starts in sample.items():
        starts.sort(key=str.encode)
        count = -(-n // ties)
        bounds = sorted({starts[i * len(starts) // count] for i in range(1, count)}, key=str.encode)
        if bounds:
            below = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= start))
            part = F.when(F.col("doc_id").eqNullSafe(F.lit(doc).cast("bigint")), below).otherwise(part)
    return runs.withColumn("part", part)


def with_next(docs: DataFrame, hot: Hot, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (range, last, doc_id, text, copies) sorted by id within ranges of ids.

    A range is whole in one partition, and after its rows stands a copy of the first row
    of the next range (after the last range: of the first) with last = 1. Ids are
    integers; null ids come first, and equal ids are sorted by text. The bounds of the
    ranges and the first ids of ranges come to the driver: a few for each partition.

    A hot id, or the lack of one, has ranges of its own, cut by the texts' beginnings, in
    which equal rows stand once with their number.
    """
    spark = docs.sparkSession
    plain = id_and_text(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    ids = plain.select("doc_id")
    parts, count = int(spark.conf.get("spark.sql.shuffle.partitions")), _most_ranges(spark)
    found = ids.agg(F.percentile_approx("doc_id", [i / count for i in range(1, count)], 10 * count)).first()[0]
    # a hot id is alone between its two bounds; range 0 is for rows without an id
    bounds = sorted({*(found or []), *hot.ids, *(i + 1 for i in hot.ids)})
    place = F.when(F.col("doc_id").isNull(), 0).otherwise(1 + _range_of(F.col("doc_id"), bounds)).cast("long") * MOST_PARTS
    is_hot = F.coalesce(F.col("doc_id").isin(hot.ids), F.lit(hot.nulls)) if hot else F.lit(False)
    cold = plain.filter(~is_hot).select(place.alias("range"), "doc_id", "text", F.lit(1).cast("bigint").alias("copies"))
    heads = ids.filter(~is_hot).groupBy(place.alias("range")).agg(F.min("doc_id").alias("least")).collect()
    known = [row.least for row in heads if row.least is not None]
    first = plain.filter(~is_hot & (F.col("doc_id").isin(known) | F.col("doc_id").isNull()))
    first = first.groupBy(place.alias("range")).agg(F.min(F.struct("doc_id", "text")).alias("head"))
    ranges = [row.range for row in heads]
    if hot:
        runs = cut_lineage(_hot_runs(plain.filter(is_hot), hot.ties).withColumn("range", place + F.col("part")))
        more = runs.groupBy("range").agg(F.min(F.struct("doc_id", "text")).alias("head"))
        ranges += [row.range for row in more.select("range").collect()]
        first = first.unionByName(more)
        cold = cold.unionByName(runs.select("range", "doc_id", "text", "copies"))
    own = cold.withColumn("last", F.lit(0))
    columns = ["range", "last", "doc_id", "text", "copies"]
    if not ranges:
        return own.select(*columns)
    ranges.sort()
    follows = spark.createDataFrame([(ranges[i - 1], r) for i, r in enumerate(ranges)], "after bigint, of bigint")
    copied = first.join(F.broadcast(follows), F.col("range") == F.col("of")).select(
        F.col("after").alias("range"), F.lit(1).alias("last"), "head.doc_id", "head.text", F.lit(1).cast("bigint").alias("copies")
    )
    return own.select(*columns).unionByName(copied).repartition(parts, "range").sortWithinPartitions(*columns[:-1])


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by the first characters of the next one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def compare_with_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ties: int = TIES
) -> DataFrame:
    """Fingerprints of every text and of its edit, and how alike they are.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited
    (to the edit) and near_next (to the next document's text, by ascending id).

    Defined cases: as for fingerprint_texts; rows without an id come first; rows that share
    an id are ordered by text; the last row is followed by the first, a single one by
    itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "times"]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64(), pa.int64()]

        def done(rows: list[tuple]) -> pa.RecordBatch:
            """rows: range, last, doc_id, text, copies; the last one is there as a next one
            only. All copies of a row but one are followed by another copy."""
            texts = [r[3] for r in rows]
            pairs = []
            for i in range(len(rows) - 1):
                if not rows[i][1]:
                    pairs.append((i, i + 1, 1))
                    if rows[i][4] > 1:
                        pairs.append((i, i, rows[i][4] - 1))
            edits = [edited(texts[i], texts[j]) for i, j, _ in pairs]
            prints = fingerprints(texts + edits)
            out = []
            for at, (i, j, times) in enumerate(pairs):
                own, other = prints[i], prints[len(texts) + at]
                digest = hashlib.sha256(edits[at].encode()).hexdigest()
                near = likeness(own, other), likeness(own, prints[j])
                out.append((rows[i][2], len(texts[i]), digest, own, other, *near, times))
            columns = list(zip(*out, strict=True)) or [[] for _ in names]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

        held, chars = [], 0
        for batch in slices(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                chars += len(row[3])
                if chars > BATCH_CHARS and len(held) > 1:
                    yield done(held)
                    held, chars = held[-1:], len(row[3])
        if held:
            yield done(held)

    hot = hot_ids(docs, id_col, ties)
    found = with_next(docs, hot, id_col, text_col).mapInArrow(
        run,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, times long",
    )
    if not hot:
        return found.drop("times")
    # blocks of copies go to many tasks, which spell them out
    found = found.withColumn("start", F.explode(F.expr(f"sequence(0L, times - 1, {COPIES}L)")))
    found = found.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "edited_sha256", "start")
    found = found.withColumn("times", F.least(F.col("times") - F.col("start"), F.lit(COPIES)))
    return found.withColumn("copy", F.explode(F.expr("sequence(1L, times)"))).drop("start", "times", "copy")
