"""One query per model, over documents made of the whole given tables, and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import model_standins as given
from checks.oracle import IDENTITY, frame_sql
from checks.scratch import scratch_dir
from gaugeworks.operators.bank import bank_frames
from gaugeworks.operators.marts import GRAIN_WORD, mart_name
from gaugeworks.plans import decimals, measurements, refresh, stations
from gaugeworks.sources import tables

Query = Callable[[SparkSession, str], DataFrame]
MODELS: dict[str, Query] = {}
MODEL_SQL: dict[str, str] = {}


def model(sql: str) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        MODELS[f.__name__], MODEL_SQL[f.__name__] = f, sql
        return f

    return add


@model(f"WITH {given.SQL_MEASURED} SELECT * FROM measurements")
def model_measurements(spark, sf_dir):
    return measurements.measurements(given.snapshots(spark, sf_dir))


@model(f"WITH {given.SQL_GEO} SELECT * FROM geo")
def model_station_geo(spark, sf_dir):
    return measurements.station_geo(given.snapshots(spark, sf_dir))


@model(f"WITH {given.SQL_RAIN} SELECT * FROM rain")
def model_rain_stations(spark, sf_dir):
    return stations.rain_stations(given.rain_documents(spark, sf_dir))


@model(f"WITH {given.SQL_WEATHER} SELECT * FROM weather")
def model_weather_stations(spark, sf_dir):
    return stations.weather_stations(given.weather_documents(spark, sf_dir))


@model(f"WITH {given.SQL_STATIONS} SELECT * FROM stations")
def model_stations(spark, sf_dir):
    return stations.stations(
        model_rain_stations(spark, sf_dir), model_weather_stations(spark, sf_dir), model_station_geo(spark, sf_dir)
    )


def _refreshed_stations(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The job that materialises all three station tables, run twice: the second replaces the first."""
    root = scratch_dir(spark)
    for _ in range(2):
        refresh.refresh_stations(
            spark, given.rain_documents(spark, sf_dir), given.weather_documents(spark, sf_dir), given.snapshots(spark, sf_dir), root
        )
    return tables.read(spark, f"{root}/{name}")


@model(f"WITH {given.SQL_STATIONS} SELECT * FROM stations WHERE station_status = '{stations.EXISTING}'")
def model_existing(spark, sf_dir):
    return _refreshed_stations(spark, sf_dir, "existing_stations")


@model(f"WITH {given.SQL_STATIONS} SELECT * FROM stations WHERE station_status = '{stations.REVOKED}'")
def model_revoked(spark, sf_dir):
    return stations.revoked_stations(model_stations(spark, sf_dir))


@model(f"WITH {given.SQL_EXTRACTED} SELECT * FROM extracted")
def model_extracted(spark, sf_dir):
    return decimals.extracted_records(given.snapshots(spark, sf_dir, "raw_data"))


@model(f"WITH {given.SQL_EXTRACTED} SELECT DISTINCT * EXCLUDE (GeoInfo, StationFieldsInfo) FROM extracted")
def model_records(spark, sf_dir):
    return decimals.weather_records(model_extracted(spark, sf_dir))


def _directory(spark: SparkSession, sf_dir: str, target: DataFrame | None) -> DataFrame:
    weather, rain = given.weather_documents(spark, sf_dir, "raw_data"), given.rain_documents(spark, sf_dir, "raw_data")
    return decimals.station_directory(model_extracted(spark, sf_dir), weather, rain, target)


@model(f"WITH {given.SQL_DIRECTORY} SELECT * FROM directory")
def model_directory(spark, sf_dir):
    return _directory(spark, sf_dir, None)


@model(f"""WITH {given.SQL_DIRECTORY} SELECT * FROM directory
    WHERE StationID NOT IN (SELECT station_id FROM rain WHERE station_id IS NOT NULL)""")
def model_directory_new(spark, sf_dir):
    """The ids of the rain registry are in the directory already."""
    known = model_rain_stations(spark, sf_dir).where("station_id IS NOT NULL")
    return _directory(spark, sf_dir, known.select(F.col("station_id").alias("StationID")))


FIRST_RUN = "measure_at < TIMESTAMP {}'2024-01-20 12:00:00'"


def _mart_sql(grain: str, runs: str = "") -> str:
    """The mart by way of the bank; each of several runs sees its own rows only."""
    names = [f.name for f in bank_frames(grains=(grain,))]
    frames = [frame_sql(f.func, f.column, "station_id" + runs, "measure_at", f.interval) for f in bank_frames(grains=(grain,))]
    columns = ", ".join(f"{sql} AS {mart_name(name, grain)}" for sql, name in zip(frames, names, strict=True))
    return f"""WITH {given.SQL_MEASURED}, bank AS (SELECT {IDENTITY}, {columns} FROM measurements)
        SELECT * FROM bank WHERE measure_at = date_trunc('{grain}', measure_at)"""


@model(_mart_sql("hour", ", " + FIRST_RUN.format("")))
def model_refresh_twice(spark, sf_dir):
    """The hourly mart after a first run without the later documents and a second run with all of them."""
    root, docs = scratch_dir(spark), given.snapshots(spark, sf_dir)
    for part in (docs.where(FIRST_RUN.replace("TIMESTAMP {}", "TIMESTAMP_NTZ")), docs):
        refresh.refresh_measurements(spark, part, root)
    return tables.read(spark, f"{root}/hourly_measurements")


def _from_bank(grain: str, word: str) -> None:
    build = getattr(measurements, word)
    MODELS[f"model_{word}"] = lambda spark, sf_dir: build(measurements.aggregated(model_measurements(spark, sf_dir)))
    MODEL_SQL[f"model_{word}"] = _mart_sql(grain)


for _grain, _word in GRAIN_WORD.items():
    _from_bank(_grain, _word)
