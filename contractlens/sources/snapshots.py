"""Partitioned tables that change as a whole: versions, and a manifest that is written last.

    <path>/load=<id>/<column>=<value>/...   what one load wrote, never changed afterwards
    <path>/_manifests/<number>.json         which partition folders make up a version

A load writes its own folder first; nothing refers to it until the next manifest is
there. So a load that fails leaves the old version as it was, readers never see half of
a load, and a version that is being read stays until `drop_unused` removes it. A
manifest's number is taken by creating its file, which only one writer can; the other
one reads the new version and tries again.

A manifest names one folder for each partition value. That is a list of departments,
not of files, so it is small and comes to the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFESTS = "_manifests"
#: Writers of one table that may come between, before a load gives up.
TRIES = 20


class Files:
    """The file system of a path: local, distributed or an object store."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark.sparkContext._jvm, path.rstrip("/")
        self.system = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, inside: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{inside}" if inside else self.root)

    def names(self, inside: str) -> list[str]:
        """Names in a folder, none if it isn't there."""
        if not self.system.exists(self._path(inside)):
            return []
        return sorted(status.getPath().getName() for status in self.system.listStatus(self._path(inside)))

    def read(self, inside: str) -> str:
        stream = self.system.open(self._path(inside))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, inside: str, text: str) -> bool:
        """Write a file that must not be there yet; False if it is."""
        try:
            stream = self.system.create(self._path(inside), False)
        except Exception as error:  # the JVM's kinds differ by file system
            if self.system.exists(self._path(inside)):
                return False
            raise error
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        return True

    def delete(self, inside: str) -> None:
        self.system.delete(self._path(inside), True)


def _manifests(files: Files) -> list[int]:
    return [int(name[:-5]) for name in files.names(MANIFESTS) if name.endswith(".json") and name[:-5].isdigit()]


def _read_manifest(files: Files, number: int) -> list[str] | None:
    """Partition folders; None if the manifest was not finished."""
    try:
        return json.loads(files.read(f"{MANIFESTS}/{number:012d}.json"))["folders"]
    except ValueError:
        return None


def current(files: Files) -> tuple[int, list[str]]:
    """Number of the newest manifest, and the folders of the newest finished one."""
    numbers = _manifests(files)
    for number in reversed(numbers):
        folders = _read_manifest(files, number)
        if folders is not None:
            return numbers[-1], folders
    return (numbers[-1] if numbers else 0), []


def folder_name(spark: SparkSession, column: str, value: str | int | None) -> str:
    """How Spark names the folder of a partition value."""
    if value is None:
        return f"{column}=__HIVE_DEFAULT_PARTITION__"
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{column}={escape(str(value))}"


def _partition_folders(files: Files, inside: str, depth: int) -> list[str]:
    found = [inside]
    for _ in range(depth):
        found = [f"{folder}/{name}" for folder in found for name in files.names(folder) if "=" in name]
    return found


def replace(
    rows: DataFrame, path: str, columns: list[str], gone: Callable[[tuple[str, ...], set[tuple[str, ...]]], bool]
) -> None:
    """Write rows as a new version without the earlier partitions that `gone` names.

    `gone` sees an earlier partition's folder names, one for each of `columns`, and those
    of all partitions that the new rows have. Earlier partitions that stay and new rows of
    the same partition are both read.
    """
    spark = rows.sparkSession
    files, load = Files(spark, path), f"load={uuid.uuid4().hex}"
    rows.hint("rebalance", *columns).write.partitionBy(*columns).parquet(f"{path}/{load}")
    added = _partition_folders(files, load, len(columns))
    parts = lambda folder: tuple(folder.split("/")[1:])
    new = set(map(parts, added))
    for _ in range(TRIES):
        newest, folders = current(files)
        kept = [folder for folder in folders if not gone(parts(folder), new)]
        version = json.dumps({"folders": kept + added})
        if files.create(f"{MANIFESTS}/{newest + 1:012d}.json", version):
            return
    files.delete(load)
    raise RuntimeError(f"{TRIES} other loads of {path} came between")


def read(
    spark: SparkSession, path: str, schema: T.StructType, only: Callable[[tuple[str, ...]], bool] | None = None
) -> DataFrame:
    """The newest version, as one scan; filters on partition columns prune its folders.

    `only` sees a partition's folder names and says whether to read it.
    """
    files = Files(spark, path)
    _, folders = current(files)
    if only is not None:
        folders = [folder for folder in folders if only(tuple(folder.split("/")[1:]))]
    if not folders:
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{folder}" for folder in folders])
    return found.select(*[field.name for field in schema])


def drop_unused(spark: SparkSession, path: str) -> list[str]:
    """Remove loads and manifests that the newest version doesn't need; returns the loads.

    Not while a load or a reader of an earlier version runs.
    """
    files = Files(spark, path)
    newest, folders = current(files)
    used = {folder.split("/")[0] for folder in folders}
    unused = [name for name in files.names("") if name.startswith("load=") and name not in used]
    for name in unused:
        files.delete(name)
    for number in _manifests(files):
        if number < newest and _read_manifest(files, newest) is not None:
            files.delete(f"{MANIFESTS}/{number:012d}.json")
    return unused
