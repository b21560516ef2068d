"""Where the queries that write put their files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """A new path in the shared folder the cluster names; a local one only where none is named."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return f"{shared}/gaugeworks-{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="gaugeworks-")


def land_documents(events: DataFrame, landing: str) -> None:
    """Write one file per 1000 event ids, each a single JSON document; ids are unique, so files are small."""
    record = F.struct(F.col("event_id").cast("string").alias("StationId"), F.col("value").alias("Reading"))
    stations = F.struct(F.collect_list(record).alias("Station"))
    documents = events.groupBy(F.expr("event_id div 1000").alias("batch")).agg(
        F.to_json(F.struct(stations.alias("records"))).alias("value")
    )
    writers = events.sparkSession.sparkContext.defaultParallelism
    documents.repartition(writers, "batch").write.mode("append").partitionBy("batch").text(landing)


def batch_of(filename: str) -> F.Column:
    return F.regexp_extract(filename, r"batch=(\d+)", 1).cast("bigint")
