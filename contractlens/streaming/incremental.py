"""New pages and departments without doing finished work again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contractlens.functions.text import page_key, strip_session_id
from contractlens.plans.metadata import update_all_metadata
from contractlens.plans.store import write_partitioned
from contractlens.session import cut_lineage
from contractlens.streaming.key_index import known_keys, store_keys

STORED_KEY = "page_key"


def _path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def store_new_pages(batch: DataFrame, batch_id: int, path: str) -> None:
    """Append the pages of one batch whose key is not stored yet.

    Every batch has folders of its own that are written as a whole, so a repeated batch
    leaves the same files. Keys of earlier batches are found through the key index, which
    reads only the buckets of stored keys that the batch may hit; no streaming state grows
    with the pages. Pages without a url have no key and are stored by every batch.
    """
    keyed = batch.withColumn(STORED_KEY, page_key(strip_session_id(F.col("url"))))
    keys = cut_lineage(keyed.select(F.col(STORED_KEY).alias("key")).filter("key IS NOT NULL").distinct())
    # among copies inside the batch the one with the smallest page_id stays
    fresh = keyed.groupBy(STORED_KEY).agg(
        F.min_by(F.struct(*batch.columns), "page_id").alias("page")
    ).select(STORED_KEY, "page.*")
    known = known_keys(keys, path, batch_id)
    if known is not None:
        known = cut_lineage(known)
        fresh = fresh.join(known, F.col(STORED_KEY) == F.col("key"), "left_anti")
        keys = keys.join(known, "key", "left_anti")
    fresh.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    store_keys(keys, path, batch_id)


def incremental_ingest(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    name_pattern: str = "*.parquet",
) -> DataFrame:
    """Load the page files that arrived since the last run, then stop.

    Returns the stored pages. Delete the checkpoint folder to read all files again.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", name_pattern)
        .parquet(source)
    )
    query = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: store_new_pages(batch, batch_id, path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    stored = T.StructType(
        [T.StructField(STORED_KEY, T.StringType()), *schema.fields, T.StructField("batch", T.LongType())]
    )
    return spark.read.schema(stored).parquet(path)


def resumable_metadata(
    spark: SparkSession,
    contracts: DataFrame,
    path: str,
    reset: bool = False,
    derive: Callable[[DataFrame], DataFrame] = update_all_metadata,
) -> DataFrame:
    """Derive the flags of the departments that are not marked complete.

    All open departments run as one job. Their partitions are replaced first and the
    markers written after, so a run that fails in between simply repeats them.
    Returns (owner_acronym, run) markers of all completed departments.
    """
    marks, rows = f"{path}/completed", f"{path}/contracts"
    done = None
    if not reset and _path_exists(spark, marks):
        done = spark.read.schema("owner_acronym string, run bigint").parquet(marks)
    pending = contracts
    if done is not None:
        # one row per department: far below any broadcast bound
        pending = contracts.join(done.select("owner_acronym"), "owner_acronym", "left_anti")
    pending = pending.select(*contracts.columns)
    if not pending.isEmpty():
        schema = write_partitioned(derive(pending), rows, ["owner_acronym"])
        run = (
            done.agg(F.coalesce(F.max("run"), F.lit(0)) + 1).first()[0] if done is not None else 1
        )
        finished = pending.select("owner_acronym").distinct().withColumn("run", F.lit(run).cast("bigint"))
        mode = "append" if done is not None else "overwrite"
        finished.write.mode(mode).parquet(marks)
        del schema
    return spark.read.schema("owner_acronym string, run bigint").parquet(marks)
