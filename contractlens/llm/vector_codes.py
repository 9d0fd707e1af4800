"""Codes for vectors: parts of integer vectors by their nearest codebook entry, exactly.

Squared distances are |x|^2 - 2 x.c + |c|^2. The dot products are matrix products in
float64, which numpy gives to BLAS, and still exact: integers are broken into limbs so
short that every product of two limb rows stays below 2^53; the products are put
together in 64-bit integers, whose overflow wraps and cancels as long as the distance
itself fits. The first smallest distance is the code, so ties go to the lower index.

Spark deals out the vectors. A round of training is one pass over them: a task adds up
its parts by position and entry, and these sums, whose number the codebooks bound, meet
in one small aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contractlens.llm.common import quoted, slices
from contractlens.session import cut_lineage, small_side

#: Components become floor(SCALE * x).
SCALE = 4096
#: Bits that float64 holds exactly.
EXACT_BITS = 53
#: Magnitudes below this have squared distances of a whole vector within 64 bits.
MOST_MAGNITUDE = 1 << 26
#: Vectors that are coded together in a task.
ROWS = 4096


def limb_width(length: int) -> int:
    """Bits of a limb, so that a sum of `length` products of limbs is below 2^53."""
    return (EXACT_BITS - max(1, length).bit_length()) // 2


def limbs(values: np.ndarray, width: int, most: int) -> list[np.ndarray]:
    """Integers of magnitude up to `most` as float64 limbs, the lowest first; the highest
    has the sign, the others are 0 to 2^width - 1."""
    out, rest = [], values.astype(np.int64)
    while most >= 1 << width:
        out.append((rest & ((1 << width) - 1)).astype(np.float64))
        rest, most = rest >> width, (most >> width) + 1
    return [*out, rest.astype(np.float64)]


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All dot products of rows of a with rows of b, as 64-bit integers modulo 2^64."""
    width = limb_width(a.shape[1])
    most = lambda x: int(max(-int(x.min()), int(x.max()), 0)) if x.size else 0
    total = np.zeros((len(a), len(b)), np.int64)
    for i, one in enumerate(limbs(a, width, most(a))):
        for j, two in enumerate(limbs(b, width, most(b))):
            total += (one @ two.T).astype(np.int64) << (width * (i + j))
    return total


def nearest(part: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every row the index of the first nearest entry, and its squared distance."""
    own = (part * part).sum(axis=1)
    distances = own[:, None] - 2 * exact_products(part, entries) + (entries * entries).sum(axis=1)
    codes = distances.argmin(axis=1)
    return codes, distances[np.arange(len(part)), codes]


def assign(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (a column for each part) and summed squared distances of integer vectors;
    books: part, entry, position."""
    count, _, size = books.shape
    parts = vectors.reshape(len(vectors), count, size)
    found = [nearest(parts[:, p], books[p]) for p in range(count)]
    return np.stack([c for c, _ in found], axis=1), sum(d for _, d in found)


def usable(vector: Column) -> Column:
    """Not null, and all components finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, whole (floor(SCALE * x) of every component) of the usable vectors."""
    vector = F.col(quoted(vector_col))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    return vectors.filter(usable(vector.cast("array<double>"))).select(
        F.col(quoted(id_col)).alias("vec_id"), F.col(quoted(label_col)).alias("label"), whole.alias("whole")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1)


def _round(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: an entry becomes the floor of the mean of the parts
    that it is nearest to; an entry that no part is nearest to stays."""
    count, entries, size = books.shape
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        number = np.zeros((count, entries), np.int64)
        total = np.zeros((count, entries, size), np.int64)
        for batch in slices(batches, ROWS, 64 << 20):
            vectors = _matrix(batch["whole"])
            codes, _ = assign(vectors, held)
            parts = vectors.reshape(len(vectors), count, size)
            for p in range(count):
                number[p] += np.bincount(codes[:, p], minlength=entries)
                np.add.at(total[p], codes[:, p], parts[:, p])
        p, e = np.nonzero(number)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(number[p, e], pa.int64()),
                pa.array(list(total[p, e]), pa.list_(pa.int64())),
            ],
            ["part", "entry", "n", "total"],
        )

    sums = rows.select("whole").mapInArrow(run, "part int, entry int, n long, total array<long>")
    each = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size)]
    found = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *each)
    out = books.copy()
    for row in found.collect():  # at most parts times entries
        out[row.part, row.entry] = [int(row[f"s{i}"]) // row.n for i in range(size)]
    return out


def train_codebooks(rows: DataFrame, parts: int, entries: int, rounds: int) -> np.ndarray:
    """Codebooks (part, entry, position) of integer vectors of one length.

    They start as the parts of the rows with the smallest vec_ids, of which `entries` come
    to the driver; the rounds bring sums for each part and entry.
    """
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "whole").limit(entries).collect()
    start = np.array([row.whole for row in first], np.int64)
    books = start.reshape(len(start), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = _round(rows, books)
    return books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code, error."""
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, ROWS, 64 << 20):
            codes, errors = assign(_matrix(batch["whole"]), shared.value)
            text = [bytes(code).hex() for code in codes.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], batch["label"], pa.array(text, pa.string()), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    kinds = dict(rows.dtypes)
    return rows.select("vec_id", "label", "whole").mapInArrow(
        run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    )


def encode_vectors(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, id_col: str = "vec_id",
    vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 and label of the usable vectors.

    Components become floor(4096 * x); a vector is cut into `parts` equal consecutive
    parts, each coded by the nearest of at most `entries` (256 at most) entries of its
    position's codebook. code has two hexadecimal digits for each part, error is the sum of
    the squared distances, label_error its sum over rows with the same label, and
    codebooks_sha256 names the codebooks.

    Defined cases: a vector that is null or holds a null, a NaN or an infinite component
    is dropped; vectors of another length than the most frequent one (of equally frequent
    ones the greatest), and vectors without components, are returned without code and
    error; rows without an id come last when the codebooks start, and rows of one id in
    the order of their components; repeated rows are coded each; with fewer rows than
    entries the codebooks are smaller; null labels are one label; further columns are
    left out; an empty table gives no rows. A ValueError says, before anything is coded,
    that the length is no multiple of `parts`, or that a component is 16,384 or more, as
    squared distances would leave 64 bits.

    The integers are written once. Every round is one pass without a shuffle of vectors;
    what the driver sees is bounded by the codebooks. Labels meet after partial sums.
    """
    if not 1 <= entries <= 256:
        raise ValueError("two hexadecimal digits name 1 to 256 entries")
    rows = cut_lineage(integer_vectors(vectors, id_col, vector_col, label_col))
    magnitude = F.aggregate("whole", F.lit(0).cast("bigint"), lambda m, x: F.greatest(m, F.abs(x)))
    lengths = rows.groupBy(F.size("whole").alias("length")).agg(
        F.count(F.lit(1)).alias("n"), F.max(magnitude).alias("magnitude")
    )
    found = lengths.filter("length > 0").orderBy(F.desc("n"), F.desc("length")).first()
    none = F.lit(None)
    bare = lambda some: some.select(
        "vec_id", "label", none.cast("string").alias("code"), none.cast("bigint").alias("error")
    )
    if found is None:
        coded, digest = bare(rows), none.cast("string")
    else:
        if found.length % parts:
            raise ValueError(f"{found.length} components are not {parts} equal parts")
        if found.magnitude >= MOST_MAGNITUDE:
            raise ValueError("a component of 16,384 or more: squared distances would leave 64 bits")
        alike = F.size("whole") == found.length
        books = train_codebooks(rows.filter(alike), parts, entries, rounds)
        coded = cut_lineage(_coded(rows.filter(alike), books).unionByName(bare(rows.filter(~alike))))
        digest = F.lit(codebooks_digest(books))
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    sums = small_side(cut_lineage(sums))
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"), "label"
    )


def codes_sql(table: str = "embeddings", parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """The same rows in SQL: the rounds written out one after the other."""
    steps = [
        f"""whole AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    list_transform(embedding, lambda x: cast(floor(x::double * {SCALE}) AS bigint)) AS v
  FROM {table} WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (
  SELECT r, part, v[cast(part * len(v) // {parts} + 1 AS bigint):cast((part + 1) * len(v) // {parts} AS bigint)] AS v
  FROM whole, range({parts}) AS p(part))""",
        f"book0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v FROM parts WHERE r <= {entries})",
    ]
    for n in range(rounds + 1):
        steps.append(f"""found{n} AS MATERIALIZED (
  SELECT p.r, p.part, any_value(p.v) AS v, min({{'d': list_sum(list_transform(list_zip(p.v, b.v),
    lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint, 'entry': b.entry}}) AS best
  FROM parts p JOIN book{n} b ON p.part = b.part GROUP BY p.r, p.part)""")
        if n < rounds:
            steps.append(f"""means{n} AS MATERIALIZED (
  SELECT part, entry, list(m ORDER BY place) AS v FROM (
    SELECT part, entry, place, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::bigint AS m
    FROM (SELECT part, best.entry AS entry, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM found{n})
    GROUP BY part, entry, place) GROUP BY part, entry)""")
            steps.append(f"""book{n + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{n} b
  LEFT JOIN means{n} m ON b.part = m.part AND b.entry = m.entry)""")
    steps.append(f"""coded AS MATERIALIZED (
  SELECT r, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.d)::bigint AS error
  FROM found{rounds} GROUP BY r)""")
    steps.append(f"""digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds})""")
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::bigint AS label_error, codebooks_sha256, label
FROM coded JOIN whole USING (r), digest"""
