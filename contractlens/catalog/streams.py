"""Restartable loading over the tables."""

from pyspark.sql import functions as F

from contractlens.catalog.inputs import flagged
from contractlens.catalog.sql_text import after
from contractlens.session import scratch_path
from contractlens.sources.tables import table
from contractlens.streaming.incremental import incremental_ingest, resumable_metadata


def incremental_pages(spark, sf):
    """Two loads: the second brings new pages, copies, and copies with a session id."""
    pages = table(spark, sf, "pages")
    source, path, marks = (scratch_path(spark, n) for n in ("pages", "stored", "stream"))
    pages.filter("page_id % 3 <> 0").write.parquet(f"{source}/first")
    incremental_ingest(spark, f"{source}/*", pages.schema, path, marks)
    copies = pages.filter("page_id % 2 = 0").withColumn(
        "url", F.when(F.col("page_id") % 4 == 0, F.regexp_replace("url", r"\?", ";session=1?")).otherwise(F.col("url"))
    )
    copies.write.parquet(f"{source}/second")
    stored = incremental_ingest(spark, f"{source}/*", pages.schema, path, marks)
    return stored.select("page_key")


def resumed_metadata(spark, sf):
    """Half of the departments first, then all: the second run does the other half."""
    rows = flagged(spark, sf)
    path = scratch_path(spark, "resumed")
    early = rows.filter("owner_acronym < 'nation_2'")
    resumable_metadata(spark, early, path)
    return resumable_metadata(spark, rows, path)


QUERIES = {"incremental_ingest": incremental_pages, "resumable_metadata": resumed_metadata}

ORACLES = {
    "incremental_ingest": "SELECT DISTINCT md5(regexp_replace(url, ';[^?]*', '', 'g')) AS page_key FROM pages WHERE page_id % 3 <> 0 OR page_id % 2 = 0",
    "resumable_metadata": after(
        "contracts",
        "SELECT DISTINCT owner_acronym, cast(CASE WHEN owner_acronym < 'nation_2' THEN 1 ELSE 2 END AS bigint) AS run FROM contracts",
    ),
}
