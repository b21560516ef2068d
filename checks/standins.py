"""Given tables dressed as station data, in Spark and, under the same names, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import classify_station, na_tag_to_null, negative_to_null
from gaugeworks.operators.dedup import keep_first


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows in even shares, four a core: a small file has few or uneven splits, while each row becomes a document of a kilobyte."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


STATION_ID = """concat(CASE user_id % 4 WHEN 0 THEN '46' WHEN 1 THEN 'C0' WHEN 2 THEN 'C1' ELSE '88' END,
       lpad(CAST(user_id AS {text}), 4, '0'))"""

# Readings as they arrive, with negatives and missing tags; the same expressions in both engines.
RAW_READINGS = {
    "air_temperature": "value - 20",
    "air_pressure": "900 + value",
    "relative_humidity": "CASE WHEN event_id % 3 = 0 THEN -99 ELSE value / 5 END",
    "wind_speed": "value / 10",
    "wind_direction": "CAST(event_id % 36 AS DOUBLE) * 10",
    "wind_direction_gust": "CASE WHEN event_id % 7 = 0 THEN -99 ELSE CAST(event_id % 36 AS DOUBLE) * 10 END",
    "peak_gust_speed": "CASE WHEN event_id % 5 = 0 THEN -99 ELSE value / 8 END",
    "precipitation": "value - 5",
    "sunshine_duration_10Min": "CASE WHEN event_type = 'view' THEN -99 ELSE value / 50 END",
    "uv_index": "CAST(event_id % 12 AS DOUBLE)",
}
RAW_TEXTS = {
    "visibility": "CASE WHEN event_type = 'error' THEN '-99' ELSE event_type END",
    "weather_status": "CASE WHEN event_id % 11 = 0 THEN '-99' ELSE event_type END",
}


def raw_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events snapped to ten minutes and named as readings; nothing cleaned yet."""
    snapped = F.expr(
        "CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) + make_dt_interval(0, hour(ts), CAST(10 * floor(minute(ts) / 10) AS INT))"
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.expr(STATION_ID.format(text="STRING")).alias("station_id"),
        *[F.expr(e).cast("double").alias(c) for c, e in RAW_READINGS.items()],
        F.expr("concat('Station ', user_id)").alias("station_name"),
        *[F.expr(e).alias(c) for c, e in RAW_TEXTS.items()],
        snapped.alias("measure_at"),
    )


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned and unique per (station_id, measure_at): the shape of the measurement model."""
    raw = raw_measurements(spark, sf_dir)
    cleaned = raw.select(
        "event_id",
        "station_id",
        *[negative_to_null(c).alias(c) for c in RAW_READINGS],
        "station_name",
        *[na_tag_to_null(c).alias(c) for c in RAW_TEXTS],
        classify_station("station_id").alias("station_type"),
        "measure_at",
    )
    return keep_first(cleaned, ["station_id", "measure_at"], ["event_id"]).drop("event_id")


SQL_RAW = (
    "raw AS (SELECT event_id, "
    + STATION_ID.format(text="VARCHAR")
    + " AS station_id, "
    + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in RAW_READINGS.items())
    + ", concat('Station ', user_id) AS station_name, "
    + ", ".join(f"{e} AS {c}" for c, e in RAW_TEXTS.items())
    + ", time_bucket(INTERVAL '10 minutes', ts) AS measure_at FROM events)"
)
SQL_CLASS = """CASE WHEN starts_with({id}, '46') THEN '有人站' WHEN starts_with({id}, 'C0') THEN '自動站'
    WHEN starts_with({id}, 'C1') THEN '自動站' ELSE '農業雨量站' END"""
SQL_MEASUREMENTS = (
    SQL_RAW
    + ", measurements AS (SELECT station_id, "
    + ", ".join(f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END AS {c}" for c in RAW_READINGS)
    + ", station_name, "
    + ", ".join(f"nullif({c}, '-99') AS {c}" for c in RAW_TEXTS)
    + f", {SQL_CLASS.format(id='station_id')} AS station_type, measure_at FROM raw "
    "QUALIFY row_number() OVER (PARTITION BY station_id, measure_at ORDER BY event_id) = 1)"
)
