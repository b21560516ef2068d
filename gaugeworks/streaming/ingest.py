"""Periodic snapshots as a file stream (R-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.sources import tables
from gaugeworks.sources.documents import few_listing_tasks

ANY_AGE = "36500d"  # else files much older than the newest one seen are passed over


def ingest_available(
    spark: SparkSession,
    landing: str,
    raw_path: str,
    checkpoint: str,
    max_files_per_trigger: int = 10_000,
) -> None:
    """Append every document that arrived since the last call, then stop.

    The checkpoint remembers which files were taken, whatever their age.  The raw table, the one that
    ``raw_load`` writes too, notes the last batch of each stream in the commit that adds its rows, so a batch
    repeated after a failure is known before anything is read and neither loses nor doubles a document.  Names
    that another load took are left out; only those between a batch's first and last name are looked at.
    """
    with few_listing_tasks(spark):  # the stream lists in its own thread, by the session's setting, until it ends
        documents = (
            spark.readStream.format("text")
            .option("wholetext", True)
            .option("recursiveFileLookup", True)
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .option("maxFileAge", ANY_AGE)
            .load(landing)
            .select(F.col("_metadata.file_path").alias("filename"), F.col("value").alias("raw_data"))
        )
        query = (
            documents.writeStream.foreachBatch(lambda batch, number: take(batch, number, raw_path, checkpoint))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


def take(batch: DataFrame, number: int, raw_path: str, stream: str) -> None:
    """Add a batch to the raw table, once."""
    spark = batch.sparkSession
    state = tables.state(spark, raw_path)
    if state is not None and state.get("streams", {}).get(stream, -1) >= number:
        return
    low, high = batch.agg(F.min("filename"), F.max("filename")).first()  # reads names alone
    loaded = None if low is None else tables.read_between(spark, raw_path, "filename", low, high)
    new = batch if loaded is None else batch.join(loaded.select("filename").distinct(), "filename", "left_anti")
    tables.append_named(new, raw_path, "filename", {stream: number})
