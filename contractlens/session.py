"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int = 8, name: str = "contractlens") -> SparkSession:
    """A single-machine session for tests and the bench. Clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only on a local master."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(
        CHECKPOINT_KEY
    )
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            f"set {CHECKPOINT_KEY} to a folder that all executors share; "
            "a machine-local folder would not survive a lost executor"
        )
    folder = tempfile.mkdtemp(prefix="contractlens-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one written table."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/contractlens/{app}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows as a table in the shared folder and read them from there.

    The files outlive the executors that made them, later steps read only the columns
    they need, and their known size lets Spark choose joins.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """Hint for a join side that grows with the input: it meets the other side by shuffle.

    Spark judges a side by the compressed size of its files, so one that it takes for small
    may be many times larger when it is gathered at the driver.
    """
    return df.hint("merge")


def small_side(df: DataFrame, max_rows: int = 200_000) -> DataFrame:
    """Broadcast hint for a side that was counted and is small; else unchanged.

    The count stops at the bound, so a large side costs a partial scan and then
    takes the shuffled join.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
