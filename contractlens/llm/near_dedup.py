"""Near duplicates: MinHash bands propose, odd sketches sift, full sets confirm.

Documents with the same set of word shingles are one class, so copies meet nowhere
below. A class has MinHash samples, cut into bands whose hashes are bucket keys, and an
odd sketch: a bitmap in which every sample flips one bit. The exclusive or of two odd
sketches holds the samples in which two sets differ, and its population count tells
high similarities apart precisely.

Pairs within a bucket are never spelled out. First every class of a bucket meets one
pivot. Pairs that pass the sketch are confirmed on the full sets and joined into
components. Only classes of different components that still share a bucket are left.
For them the shingles that occur in more than one component are counted: two classes
of different components have no other in common, which bounds their similarity and
rules out nearly all pairs of a family of texts with edits of their own. The rest meet
in blocks, with bound and sketch inside that join, so what fails is never a row. No
candidate is capped or dropped.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.llm.bpe import Memo
from contractlens.llm.common import id_and_text, per_worker, slices, without_marked
from contractlens.llm.components import connected_components
from contractlens.session import cut_lineage, small_side

#: A pair of similarity 0.8 shares none of the bands with probability 3e-6.
BANDS, ROWS = 32, 5
#: Bits of the odd sketch.
SKETCH = 512
#: Classes of one bucket that meet all of another block of it.
BLOCK = 256
#: Parts of all shingles in which common ones are counted.
PARTS = 64
#: Word hashes that a worker keeps in mind, in each of two generations.
WORDS = 100_000
#: Classes whose texts are looked up by broadcast; more go through a shuffle.
BROADCAST_CLASSES = 200_000

_RANDOM = np.random.default_rng(20240229)
_FACTORS = _RANDOM.integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_SALTS = _RANDOM.integers(0, 2**63, BANDS * ROWS, np.uint64)
_BAND_FACTORS = _RANDOM.integers(0, 2**63, (BANDS, ROWS), np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_FACTORS = _RANDOM.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little")


def shingles(text: str, words: int) -> np.ndarray:
    """The sorted distinct shingles of a text, as 64-bit hashes.

    A-Z in lower case; words end at ASCII white space. With fewer words than a shingle
    has, the whole sequence is one; without words there is none.
    """
    found = text.encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) < words:
        return np.array([_hash(b"\0short\0" + b" ".join(found))], np.uint64)
    memo = per_worker("near_dedup", ("words",), lambda: Memo(_hash, WORDS))
    each = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
    total = np.zeros(len(found) - words + 1, np.uint64)
    for i in range(words):
        total += each[i : len(found) - words + 1 + i] * _WORD_FACTORS[i]
    return np.unique(mix(total))


def minhashes(items: np.ndarray) -> np.ndarray:
    best = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(items), 4096):
        part = items[None, at : at + 4096] * _FACTORS[:, None] + _SALTS[:, None]
        np.minimum(best, part.min(axis=1), out=best)
    return best


def band_keys(samples: np.ndarray) -> np.ndarray:
    mixed = mix(samples).reshape(BANDS, ROWS) * _BAND_FACTORS
    return mix(mixed.sum(axis=1) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, as 64-bit words: each (sample, value) flips a bit."""
    places = mix(samples + _SALTS) % np.uint64(SKETCH)
    odd = np.bincount(places.astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def sketch_distance(a: Column, b: Column) -> Column:
    """Population count of the exclusive or of two sketches."""
    bits = F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + n)


def estimated_similarity(distance: float) -> float:
    """The similarity that a distance of two odd sketches stands for."""
    inside = max(1 - 2 * distance / SKETCH, 1e-9)
    return max(0.0, 1 + SKETCH / (4 * BANDS * ROWS) * math.log(inside))


def distance_limit(threshold: float) -> int:
    """A distance that pairs of at least this similarity don't exceed, but for chances of
    about one in 10**9: six standard deviations in the samples, two in the folding."""
    n = BANDS * ROWS
    differ = n * (1 - threshold) + 6 * math.sqrt(n * threshold * (1 - threshold))
    expected = SKETCH / 2 * (1 - (1 - 2 / SKETCH) ** (2 * differ))
    return math.ceil(expected + 2 * math.sqrt(expected))


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, text_key (hash of the text), digest (of the text), n_shingles, class (digest of the set; null if
    empty), bands and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, classes, bands, sketches = [], [], [], []
            texts = batch["text"].to_pylist()
            digests = [hashlib.sha256(text.encode()).digest() for text in texts]
            for text in texts:
                items = shingles(text, words)
                sizes.append(len(items))
                if not len(items):
                    classes.append(None), bands.append(None), sketches.append(None)
                    continue
                samples = minhashes(items)
                classes.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                bands.append(band_keys(samples))
                sketches.append(odd_sketch(samples))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_key"],
                    pa.array(digests, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                ["doc_id", "text_key", "digest", "n_shingles", "class", "bands", "sketch"],
            )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        run,
        f"doc_id {kind}, text_key long, digest binary, n_shingles long, class binary, bands array<long>, sketch array<long>",
    )


def close_sizes(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes can be that similar."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def class_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """class and text of the document of each wanted class (class, sample: doc_id and
    text_key; rows with one id may have several texts)."""
    ids = wanted.select("class", F.col("sample.doc_id").alias("of"), F.col("sample.text_key").alias("key"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("key"))
    return docs.join(small_side(ids, BROADCAST_CLASSES), same).select("class", "text")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Of the pairs (a, b) of classes, those whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, np.ndarray] = {}

        def items(name: bytes, text: str) -> np.ndarray:
            if name not in known:
                if len(known) >= 64:
                    known.clear()
                known[name] = shingles(text, words)
            return known[name]

        for batch in slices(batches, rows=256):
            out = []
            for a, b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                one, two = items(a, text_a), items(b, text_b)
                common = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * common >= percent * (len(one) + len(two) - common):
                    out.append((a, b))
            names = ["a", "b"]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], pa.binary()) for i in range(2)], names
            )

    first = texts.select(F.col("class").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("class").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.select("a", "b").join(first, "a").join(second, "b")
    return rows.select("a", "b", "text_a", "text_b").mapInArrow(run, "a binary, b binary")


def _sifted(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and sketches allow."""
    side = classes.select("class", "n_shingles", "sketch")
    one = side.toDF("a", "size_a", "sketch_a")
    two = side.toDF("b", "size_b", "sketch_b")
    near = sketch_distance(F.col("sketch_a"), F.col("sketch_b")) <= distance_limit(percent / 100)
    sizes = close_sizes(F.col("size_a"), F.col("size_b"), percent)
    return pairs.join(one, "a").join(two, "b").filter(sizes & near).select("a", "b")


def _common_shingles(texts: DataFrame, components: DataFrame, words: int) -> DataFrame:
    """class, n_common: how many of its shingles other components have as well, and parts:
    the same by PARTS parts of all shingles.

    components: class, component. Shingles are counted before they meet, so one that all
    texts have is one row on one side of the join.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, rows=256):
            sets = [shingles(text, words) for text in batch["text"].to_pylist()]
            lengths = [len(s) for s in sets]
            if not sum(lengths):
                continue
            every = np.concatenate(sets).view(np.int64)
            rows = np.repeat(np.arange(len(sets)), lengths)
            columns = [batch[name].take(pa.array(rows)) for name in ("short", "component")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(every)], ["short", "component", "shingle"])

    # 64-bit names: a clash of classes or shingles makes a bound too high only, one of
    # components matters only if just these two are linked
    short = components.select(
        "class", F.xxhash64("class").alias("short"), F.xxhash64("component").alias("component")
    )
    each = texts.join(short, "class").select("short", "component", "text")
    each = cut_lineage(each.mapInArrow(run, "short long, component long, shingle long"))
    spread = each.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    spread = cut_lineage(spread.filter("low <> high").select("shingle"))
    part = F.pmod(F.col("shingle"), F.lit(PARTS)).cast("int")
    counts = each.join(spread, "shingle", "left_semi").groupBy("short", part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # at most PARTS entries each
    found = counts.groupBy("short").agg(
        F.sum("n").alias("n_common"), F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("by_part")
    )
    zero = F.lit(0).cast("bigint")
    parts = F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.coalesce(F.try_element_at("by_part", p), zero))
    return short.join(found, "short").select("class", "n_common", parts.alias("parts"))


def _across(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that share a bucket but no component, sifted inside the join.

    members: key, class, component, n_shingles, n_common, parts, sketch. A bucket's classes
    are dealt into blocks, every two blocks meet in a cell of their own, and cells go to
    tasks. Two classes have at most the smaller count in common, in all and part by part.
    """
    sizes = members.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    open_keys = cut_lineage(sizes.filter("low <> high").select("key", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    rows = members.join(open_keys, "key").withColumn(
        "block", F.pmod(F.xxhash64("class", "key"), F.col("blocks"))
    )
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    held = ["class", "component", "n_shingles", "n_common", "parts", "sketch"]
    one = rows.select("key", F.col("block").alias("i"), other.alias("j"), *[F.col(c).alias(f"{c}_a") for c in held])
    two = rows.select("key", F.col("block").alias("j"), other.alias("i"), *[F.col(c).alias(f"{c}_b") for c in held])
    near = sketch_distance(F.col("sketch_a"), F.col("sketch_b")) <= distance_limit(percent / 100)

    def possible(most: Column) -> Column:
        return most * 100 >= (F.col("n_shingles_a") + F.col("n_shingles_b") - most) * percent

    bound = possible(F.least("n_common_a", "n_common_b"))
    smaller = F.zip_with("parts_a", "parts_b", lambda x, y: F.least(x, y))
    by_part = possible(F.aggregate(smaller, F.lit(0).cast("bigint"), lambda total, n: total + n))
    on = (
        (one["key"] == two["key"]) & (one["i"] == two["i"]) & (one["j"] == two["j"])
        & (F.col("class_a") < F.col("class_b")) & (F.col("component_a") != F.col("component_b"))
        & close_sizes(F.col("n_shingles_a"), F.col("n_shingles_b"), percent) & bound & near & by_part
    )
    return one.join(two, on).select(F.col("class_a").alias("a"), F.col("class_b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked if 100 * shingles in common >= percent * shingles in either.
    component_id is the smallest doc_id reachable over links, the document's own
    included; it is kept if it is the smallest.

    Defined cases: documents without words (a null text counts as empty) have an empty
    set and are linked with nothing; repeated rows share one class, and rows that share the
    smallest id are all kept, as an id names one document; rows without an id never
    stay beside rows that have one; further columns are left out; an empty table
    gives no rows.
    """
    found = _grouped(id_and_text(docs, id_col, text_col), words, percent)
    own = F.coalesce("component_id", "doc_id")
    return found.select(
        "doc_id", "n_shingles", own.alias("component_id"),
        F.coalesce(F.col("doc_id") == own, own.isNull()).alias("kept"),
    )


def _grouped(plain: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, digest of the text, n_shingles, component_id (null if none is found) and
    group, the class that names the component (null without words), of every row."""
    rows = cut_lineage(signatures(plain, words))
    members = rows.filter("class IS NOT NULL")
    classes = cut_lineage(
        members.groupBy("class").agg(
            F.first("n_shingles").alias("n_shingles"), F.min("doc_id").alias("doc_id"),
            F.min(F.struct("doc_id", "text_key")).alias("sample"),
            F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
            F.count(F.lit(1)).alias("copies"),
        )
    )
    placed = classes.select("class", F.explode("bands").alias("key"))
    # a pivot of its own for each bucket, so that large groups have many
    buckets = cut_lineage(
        placed.groupBy("key")
        .agg(F.count(F.lit(1)).alias("n"), F.min_by("class", F.xxhash64("class", "key")).alias("pivot"))
        .filter("n > 1")
        .select("key", "pivot")
    )
    shared = cut_lineage(placed.join(buckets, "key"))
    wanted = classes.select("class", "sample").join(shared.select("class").distinct(), "class")
    texts = cut_lineage(class_texts(plain, cut_lineage(wanted)).dropDuplicates(["class"]))

    stars = shared.filter("class <> pivot").select(
        F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")
    ).distinct()
    links = cut_lineage(confirmed(cut_lineage(_sifted(stars, classes, percent)), texts, words, percent))
    first = cut_lineage(connected_components(links))

    known = shared.select("key", "class").join(first, F.col("class") == F.col("node"), "left").select(
        "key", "class", F.coalesce("root", "class").alias("component")
    )
    known = cut_lineage(known)
    described = classes.select("class", "n_shingles", "sketch")
    several = known.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = cut_lineage(several.filter("low <> high").select("key"))
    rest = cut_lineage(known.join(several, "key", "left_semi"))
    common = cut_lineage(_common_shingles(texts, rest.select("class", "component").distinct(), words))
    # without enough common shingles a class has no partner left
    able = described.join(common, "class").filter(F.col("n_common") * 100 >= F.col("n_shingles") * percent)
    rest = cut_lineage(rest.join(able, "class"))
    more = cut_lineage(confirmed(cut_lineage(_across(rest, percent)), texts, words, percent))
    roots = connected_components(links.unionByName(more))

    named = classes.select("class", "doc_id", "copies").join(roots, F.col("class") == F.col("node"), "left")
    named = named.filter("copies > 1 OR root IS NOT NULL").select(
        "class", "doc_id", F.coalesce("root", "class").alias("root")
    )
    named = cut_lineage(named)
    least = cut_lineage(named.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    groups = cut_lineage(named.select("class", "root").join(least, "root").select("class", "root", "component_id"))
    return rows.select("doc_id", "digest", "n_shingles", "class").join(groups, "class", "left").select(
        "doc_id", "digest", "n_shingles", "component_id", F.coalesce("root", "class").alias("group")
    )


def drop_near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that stay, with all their columns: exactly one row of each group, that
    with the smallest id (then the smallest digest of the text; rows without an id come
    last). Documents without words are groups by id and text.

    Decided by id and text: a row that goes takes no other text of its id along.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.unhex(F.sha2(text.cast("binary"), 256))
    found = cut_lineage(_grouped(id_and_text(docs, id_col, text_col), words, percent))
    keys = found.groupBy("group", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "digest")
    # one row for each group with several rows, found with a choice on the map side
    firsts = found.filter("group IS NOT NULL").groupBy("group").agg(
        F.min(rank).alias("first"), F.count(F.lit(1)).alias("size")
    ).filter("size > 1").drop("size").withColumnRenamed("group", "of")
    marks = keys.join(firsts, F.col("group") == F.col("of"), "left").select(
        "doc_id", "digest", "n", (F.col("first").isNull() | rank.eqNullSafe(F.col("first"))).alias("kept")
    )
    return without_marked(docs, marks.filter("NOT kept OR n > 1").drop("n"), digest, id_col, text_col)
