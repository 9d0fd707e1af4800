"""Which keys are stored already, without reading all of them.

Stored keys lie in buckets by the first letters of the key, beside Bloom filters of
about ten bits a key. A batch first meets the filters of its own buckets: what they
rule out is surely new. Only buckets with a key that they can't rule out are read, so
a batch of new keys reads next to none and a batch of few keys reads few.

    <path>/_keys/batch=<n>/bucket=<b>/     keys
    <path>/_filters/batch=<n>/bucket=<b>/  filters, each of a bounded number of keys

A batch's folders are written as a whole, so a repeated batch leaves the same ones.
Keys are hexadecimal digests of 32 letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contractlens.session import cut_lineage
from contractlens.sources.snapshots import Files

KEYS, FILTERS = "_keys", "_filters"
#: Letters of a key that name its bucket: 256 buckets.
PREFIX = 2
#: Bits of a filter for each key, probes of a key, and keys of one filter.
BITS, PROBES, MOST_KEYS = 10, 7, 1 << 20


def _halves(keys: list[str]) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(keys)), ">u8").astype(np.uint64).reshape(-1, 2)


def _places(halves: np.ndarray, size: int) -> np.ndarray:
    """The bits of each key: its digest's halves are two independent hashes."""
    steps = np.arange(PROBES, dtype=np.uint64)
    return (halves[:, :1] + steps * (halves[:, 1:] | np.uint64(1))) % np.uint64(size)


def bloom_filter(keys: list[str]) -> bytes:
    bits = np.zeros(-(-len(keys) * BITS // 8) * 8, np.uint8)
    bits[_places(_halves(keys), len(bits)).ravel()] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(held: bytes, halves: np.ndarray) -> np.ndarray:
    """Of each key whether the filter can't rule it out."""
    bits = np.frombuffer(held, np.uint8)
    places = _places(halves, 8 * len(bits))
    return ((bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def bucket(key: str = "key"):
    return F.substring(key, 1, PREFIX)


def _parts(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def filters_of(keys: DataFrame) -> DataFrame:
    """bucket and bits of the filters of keys (bucket, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []

        def one() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.array([bloom_filter(held)], pa.binary())], ["bucket", "bits"]
            )

        for batch in batches:
            for of, key in zip(batch["bucket"].to_pylist(), batch["key"].to_pylist(), strict=True):
                if held and (of != name or len(held) >= MOST_KEYS):
                    yield one()
                    held = []
                name = of
                held.append(key)
        if held:
            yield one()

    rows = keys.select("bucket", "key").repartition(_parts(keys), "bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "bucket string, bits binary")


def _stored(spark: SparkSession, path: str, kind: str, schema: str, buckets: list[str], but: int) -> DataFrame | None:
    """Rows of these buckets that other batches stored; None without any."""
    files = Files(spark, path)
    folders = [
        f"{path}/{kind}/{batch}/bucket={name}"
        for batch in files.names(kind) if batch.startswith("batch=") and batch != f"batch={but}"
        for name in sorted(set(buckets).intersection(n.removeprefix("bucket=") for n in files.names(f"{kind}/{batch}")))
    ]
    if not folders:
        return None
    return spark.read.schema(f"{schema}, batch bigint, bucket string").option("basePath", f"{path}/{kind}").parquet(*folders)


def suspected(keys: DataFrame, filters: DataFrame) -> DataFrame:
    """bucket and key of the keys (bucket, key) that the filters (bucket, bits) can't rule out.

    A task holds the filters of one bucket; keys pass by.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, []
        for batch in batches:
            of, key, bits = (batch[c].to_pylist() for c in ("bucket", "key", "bits"))
            out, first = [], 0
            while first < len(of):
                if of[first] != name:
                    name, held = of[first], []
                if bits[first] is not None:
                    held.append(bits[first])
                    first += 1
                    continue
                last = first
                while last < len(of) and of[last] == name:
                    last += 1
                halves, maybe = _halves(key[first:last]), np.zeros(last - first, bool)
                for one in held:
                    maybe |= may_hold(one, halves)
                out += [(name, key[first + i]) for i in np.flatnonzero(maybe)]
                first = last
            columns = [pa.array([row[i] for row in out], pa.string()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "key"])

    none = F.lit(None)
    both = filters.select("bucket", none.cast("string").alias("key"), "bits").unionByName(
        keys.select("bucket", "key", none.cast("binary").alias("bits"))
    )
    # filters have no key, so they come before the keys of their bucket
    rows = both.repartition(_parts(keys), "bucket").sortWithinPartitions("bucket", "key")
    return rows.mapInArrow(run, "bucket string, key string")


def known_keys(keys: DataFrame, path: str, batch_id: int) -> DataFrame | None:
    """Of a batch's keys (column key) those that earlier batches stored, or None if none can be.

    At most as many names of buckets as there are buckets come to the driver.
    """
    spark = keys.sparkSession
    named = keys.select(bucket().alias("bucket"), "key")
    names = lambda rows: [row[0] for row in rows.select("bucket").distinct().collect()]
    filters = _stored(spark, path, FILTERS, "bits binary", names(named), batch_id)
    if filters is None:
        return None
    maybe = cut_lineage(suspected(named, filters))
    stored = _stored(spark, path, KEYS, "key string", names(maybe), batch_id)
    if stored is None:
        return None
    return maybe.join(stored.select("bucket", "key"), ["bucket", "key"], "left_semi").select("key")


def store_keys(keys: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch's new keys (column key) and their filters."""
    named = keys.select(bucket().alias("bucket"), "key")
    rows = cut_lineage(named.repartition(_parts(keys), "bucket"))
    writer = rows.repartition(_parts(keys), "bucket").write.mode("overwrite").partitionBy("bucket")
    writer.parquet(f"{path}/{KEYS}/batch={batch_id}")
    filters_of(rows).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{FILTERS}/batch={batch_id}")
