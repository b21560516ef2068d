"""Targets on parquet: append-only tables, replaced tables and bucketed tables (R-07, R-08).

A target is a plain parquet folder until it is first replaced or bucketed.  From then on a log in it names the
folders that make up the table.  Each change writes new folders beside the old ones and then puts down the
next log entry by one rename, so a job that dies at any point leaves the table as it was, and readers see
the old state or the new one.  One writer at a time; a second one fails at its rename.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOG, BUCKET = "_log", "__bucket"
KEPT = 2  # states whose folders stay for readers under way
BUCKET_ROWS = 100_000


def filesystem(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm_path


def _entries(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the log entries, oldest first."""
    fs, log = filesystem(spark, f"{path}/{LOG}")
    if not fs.exists(log):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(log)]
    return sorted(int(name) for name in names if name.isdigit())


def _entry(spark: SparkSession, path: str, number: int) -> dict:
    fs, name = filesystem(spark, f"{path}/{LOG}/{number:012d}")
    stream = fs.open(name)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def state(spark: SparkSession, path: str) -> dict | None:
    """The newest log entry: ``folders`` (a list of dicts with ``path``) and what else the writer noted; None for a plain table."""
    numbers = _entries(spark, path)
    return _entry(spark, path, numbers[-1]) if numbers else None


def commit(spark: SparkSession, path: str, new: dict, after: dict | None) -> None:
    """Make ``new`` the state of the table, if ``after`` is still the one before it; then drop what no kept state names."""
    numbers = _entries(spark, path)
    number = numbers[-1] + 1 if numbers else 0
    if new.get("number", number) != number or (after or {"number": -1})["number"] != number - 1:
        raise RuntimeError(f"{path} was changed by another writer")
    fs, written = filesystem(spark, f"{path}/{LOG}/.{uuid.uuid4().hex}")
    stream = fs.create(written, False)
    stream.write(bytearray(json.dumps({**new, "number": number}).encode()))
    stream.close()
    _, name = filesystem(spark, f"{path}/{LOG}/{number:012d}")
    if fs.exists(name) or not fs.rename(written, name):
        raise RuntimeError(f"{path} was changed by another writer")
    _drop_unnamed(spark, path)


def _drop_unnamed(spark: SparkSession, path: str) -> None:
    """Delete the folders that none of the newest states names, older entries, and a plain table's files."""
    numbers = _entries(spark, path)
    named = {f["path"].split("/")[0] for n in numbers[-KEPT:] for f in _entry(spark, path, n)["folders"]}
    fs, root = filesystem(spark, path)
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name != LOG and name not in named and (name.startswith("_data-") or len(numbers) >= KEPT):
            fs.delete(status.getPath(), True)
    for n in numbers[:-KEPT]:
        fs.delete(filesystem(spark, f"{path}/{LOG}/{n:012d}")[1], False)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the target has data, with or without a marker.

    A folder that a stream's own sink wrote is refused: its log hides files that others append.
    """
    fs, root = filesystem(spark, path)
    if not fs.exists(root):
        return False
    if _entries(spark, path):
        return True
    if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(root, "_spark_metadata")):
        raise ValueError(f"{path} belongs to a stream's file sink; append to a table of another path")
    files = fs.listFiles(root, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        if name.endswith(".parquet") and "/_temporary/" not in name and "/_data-" not in name:
            return True
    return False


def read(spark: SparkSession, path: str) -> DataFrame | None:
    """The existing target, or None on the first run (Q-17)."""
    now = state(spark, path)
    if now is not None:
        return _folders(spark, path, now["folders"])
    return spark.read.parquet(path) if exists(spark, path) else None


def _folders(spark: SparkSession, path: str, folders: Iterable[dict]) -> DataFrame | None:
    paths = [f"{path}/{f['path']}" for f in folders]
    return spark.read.parquet(*paths) if paths else None


def append(df: DataFrame, path: str) -> None:
    """Add rows: to the files of a plain table, or as a folder that a logged table names once it is complete."""
    now = state(df.sparkSession, path)
    if now is None:
        df.write.mode("append").parquet(path)
    else:
        commit(df.sparkSession, path, {**now, "folders": [*now["folders"], _written(df, path)], "number": now["number"] + 1}, now)


def _written(df: DataFrame, path: str) -> dict:
    folder = f"_data-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    return {"path": folder}


def append_named(df: DataFrame, path: str, name: str, streams: dict[str, int] | None = None) -> None:
    """Add rows to a logged table (one is begun if there is no table) with the range of the column ``name`` in the log.

    ``streams`` notes, in the same commit, the last batch taken from each stream; smaller numbers never come back.
    """
    spark = df.sparkSession
    now = state(spark, path)
    before = now or {"folders": _plain(spark, path, name)}
    folder = _written(df, path)
    low, high = spark.read.parquet(f"{path}/{folder['path']}").agg(F.min(name), F.max(name)).first()
    folders = [*before["folders"], *([{**folder, "low": low, "high": high}] if low is not None or not before["folders"] else [])]
    commit(spark, path, {**before, "folders": folders, "streams": {**before.get("streams", {}), **(streams or {})}, "number": before.get("number", -1) + 1}, now)


def _plain(spark: SparkSession, path: str, name: str) -> list[dict]:
    """A plain table's rows as the first folder of a logged one."""
    if not exists(spark, path):
        return []
    folder = _written(spark.read.parquet(path), path)
    low, high = spark.read.parquet(f"{path}/{folder['path']}").agg(F.min(name), F.max(name)).first()
    return [{**folder, "low": low, "high": high}]


def read_between(spark: SparkSession, path: str, name: str, low: str, high: str) -> DataFrame | None:
    """Rows of a table with ``name`` from low to high; folders of a logged table that hold none are not opened."""
    now = state(spark, path)
    if now is None:
        found = read(spark, path)
    else:
        found = _folders(spark, path, [f for f in now["folders"] if f.get("low") is None or (f["low"] <= high and f["high"] >= low)])
    return None if found is None else found.where(F.col(name).between(low, high))


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a target.  The new state is complete before one rename makes it the table; ``df`` may read the old one."""
    now = state(df.sparkSession, path)
    commit(df.sparkSession, path, {"folders": [_written(df, path)], "number": (now or {"number": -1})["number"] + 1}, now)


def replace_keys(new: DataFrame, path: str, key: str, buckets: int | None = None) -> None:
    """Delete the rows whose key ``new`` has and insert ``new``, rewriting only the buckets that its keys fall in.

    Rows are dealt to buckets by the hash of the key; the number is fixed by the first run, by default one for
    each BUCKET_ROWS rows of it and from 4 to 4,096.  NULL keys replace nothing.
    """
    spark = new.sparkSession
    now = state(spark, path)
    before = now or {"folders": [_written(spark.read.parquet(path), path)] if exists(spark, path) else []}
    folder = f"_data-{uuid.uuid4().hex}"
    new.write.parquet(f"{path}/{folder}-new")  # computed once
    rows = spark.read.schema(new.schema).parquet(f"{path}/{folder}-new")
    if "buckets" not in before:
        before = {**before, "buckets": buckets or min(4096, max(4, rows.count() // BUCKET_ROWS))}
    bucket = F.pmod(F.xxhash64(key), F.lit(before["buckets"])).cast("int")
    touched = {r[0] for r in rows.select(bucket).distinct().collect()}  # the number of buckets at most
    old = _folders(spark, path, [f for f in before["folders"] if f.get("bucket") is None or f["bucket"] in touched])
    if old is not None:
        keys = rows.select(F.col(key).alias("__new")).where("__new IS NOT NULL").distinct()
        rows = old.join(keys, F.col(key) == F.col("__new"), "left_anti").unionByName(rows)
    _dealt(rows, bucket, f"{path}/{folder}")
    kept = [f for f in before["folders"] if f.get("bucket") is not None and f["bucket"] not in touched]
    folders = [*kept, *_bucket_folders(spark, path, folder)] or [_written(rows, path)]
    commit(spark, path, {**before, "folders": folders, "number": before.get("number", -1) + 1}, now)


def _dealt(rows: DataFrame, bucket: Column, path: str) -> None:
    rows.withColumn(BUCKET, bucket).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)


def _bucket_folders(spark: SparkSession, path: str, folder: str) -> list[dict]:
    fs, root = filesystem(spark, f"{path}/{folder}")
    names = sorted(s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())
    return [{"path": f"{folder}/{name}", "bucket": int(name.split("=")[1])} for name in names if name.startswith(f"{BUCKET}=")]


def as_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
