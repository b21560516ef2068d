"""JSON files, one document each: scan, listing and raw load (R-01 to R-03)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import batched
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.sources import tables

FILES_AT_ONCE = 10_000  # files opened by name in one scan
_LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
TASKS_PER_CORE = 4


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders and named files are listed in a few tasks a core; Spark's own choice is a task for each, up to 10,000.

    The driver gets some 3 KB from each task and 0.3 KB for each file, so a task with one file costs ten times its answer.
    """
    before = spark.conf.get(_LISTING_TASKS)
    spark.conf.set(_LISTING_TASKS, str(min(int(before), TASKS_PER_CORE * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING_TASKS, before)


def scan_documents(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """``filename`` and the whole text of each file as ``value``."""
    with few_listing_tasks(spark):
        files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=glob)
    return files.select(F.col("_metadata.file_path").alias("filename"), "value")


def list_files(spark: SparkSession, path: str | list[str], glob: str = "*") -> DataFrame:
    """``filename`` and ``path`` of every file under a folder; contents are not read."""
    with few_listing_tasks(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)
    return files.select(F.col("_metadata.file_path").alias("filename"), "path")


def unloaded_files(listing: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """Files in the listing that the raw table does not have (R-03, R-56)."""
    names = listing.dropDuplicates(["filename"])
    return names if loaded is None else names.join(loaded.select("filename").distinct(), "filename", "left_anti")


def literal_path(path: str) -> str:
    """A path that means itself where patterns are allowed."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def folder_of(path: str) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def raw_load(
    spark: SparkSession, landing: str, raw_path: str, glob: str = "*", at_once: int = FILES_AT_ONCE, since: str | None = None
) -> None:
    """Append new files to ``raw(filename, raw_data)`` (R-02), each load in one commit.

    Folders of which nothing is loaded yet are scanned whole, so a first load or a backfill is one job whatever
    its number of files.  In other folders the new files, and no others, are opened by name, ``at_once`` in each
    scan.  ``since`` closes the folders right under the landing whose name sorts before it: they are not listed.
    """
    loaded = tables.read(spark, raw_path)
    if loaded is None:
        tables.append_named(spark.createDataFrame([], "filename string, raw_data string"), raw_path, "filename")
    listing = list_files(spark, open_folders(spark, landing, since), glob)
    if loaded is None:
        new = listing.withColumn("loaded", F.lit(False))
    else:
        known = loaded.select("filename").distinct().withColumn("loaded", F.lit(True))
        new = listing.dropDuplicates(["filename"]).join(known, "filename", "left")
    is_loaded = F.coalesce("loaded", F.lit(False))
    folders = new.groupBy(folder_of("path").alias("folder")).agg(F.max(is_loaded).alias("begun"), F.min(is_loaded).alias("done"))
    steps = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    holding = folders.where("begun").select(F.explode(above).alias("folder")).distinct()  # folders with loaded files in or below them
    found = folders.where("NOT done").join(holding.withColumn("holds", F.lit(True)), "folder", "left")
    found = found.select("folder", F.col("holds").isNull().alias("whole")).collect()  # a row for each folder with new files
    whole = _topmost([r.folder for r in found if r.whole])
    parts = [scan_documents(spark, [literal_path(f) for f in whole], glob)] if whole else []
    if not all(r.whole for r in found):
        inside = [F.col("path").startswith(f"{f}/") for f in whole]
        rest = new.where(F.col("loaded").isNull() | ~F.col("loaded")).where(~reduce(or_, inside, F.lit(False)))
        for rows in batched(rest.select("path").toLocalIterator(), at_once):
            parts.append(scan_documents(spark, [literal_path(row.path) for row in rows]))
    if parts:
        tables.append_named(reduce(DataFrame.union, parts).withColumnRenamed("value", "raw_data"), raw_path, "filename")


def _topmost(folders: list[str]) -> list[str]:
    """Folders that no other one holds: a scan takes all below it."""
    found: list[str] = []
    for folder in sorted(folders, key=lambda f: f + "/"):
        if not (found and folder.startswith(f"{found[-1]}/")):
            found.append(folder)
    return found


def open_folders(spark: SparkSession, landing: str, since: str | None) -> str | list[str]:
    """The landing, or what lies right under it and does not sort before ``since``."""
    if since is None:
        return landing
    fs, root = tables.filesystem(spark, landing)
    names = sorted(status.getPath().getName() for status in fs.listStatus(root))
    return [literal_path(f"{landing}/{name}") for name in names if name >= since]
