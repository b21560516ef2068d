"""Helpers of the operators: tables in the shared folder, row keys, clash-free column names."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.sources.tables import filesystem


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (`spark.checkpoint.dir`).

    Where the session names none (tests in one process) a local temporary folder serves.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="gaugeworks-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Removes the shuffle files of a query when it ends, not when the driver happens to collect garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that Spark hands to a Python function at once.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def saved(frame: DataFrame, name: str, tidy: bool = False, batch_rows: int | None = None) -> DataFrame:
    """`frame` written to the shared folder and read back: computed once, safe from lost executors.

    With `tidy` the shuffle files of the write go when it ends. With `batch_rows` Python functions get at most so many
    rows at once: a batch is held in the executor's JVM and in the worker, as Arrow and as Python objects.
    """
    spark, path = frame.sparkSession, shared_folder(frame.sparkSession, name)
    wanted = {_CLEANUP: "true"} if tidy else {}
    if batch_rows and not 0 < int(spark.conf.get(_BATCH)) <= batch_rows:
        wanted[_BATCH] = str(batch_rows)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(frame.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Deletes tables made by `saved` after their last reader has been written itself."""
    for frame in frames:
        spark = frame.sparkSession
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            fs, path = filesystem(spark, folder)
            fs.delete(path, True)


def fresh(columns: Iterable[str], name: str) -> str:
    """`name`, with underscores put before it until no column (in any case) is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def row_key(text: Column) -> Column:
    """Tells apart rows that share a doc_id: 64-bit hash of the text, 0 for null."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.xxhash64(text))


#: Tasks over which the rows of one key are dealt in a join with a table of unique keys.
SALTS = 64


def spread_join(rows: DataFrame, lookup: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """`rows` joined with `lookup`, which has one row for each `key`; rows of one key meet it in SALTS tasks, dealt by `by`.

    A row of `lookup` is copied once for each of the places where its key occurs, so at most SALTS times.
    """
    salt = fresh([*rows.columns, *lookup.columns], "salt")
    dealt = rows.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(SALTS)))
    copies = dealt.select(key, salt).distinct().join(lookup, key)
    return dealt.join(copies, [key, salt], how).drop(salt)
