"""Measurement models: M-1, M-2, M-5 and the marts M-7 to M-10."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import classify_station, na_tag_to_null, negative_to_null, parse_timestamp
from gaugeworks.operators.bank import window_bank
from gaugeworks.operators.dedup import distinct_rows, keep_first
from gaugeworks.operators.marts import mart, mart_from_bank
from gaugeworks.operators.nested import field, flatten_two_level, parse_documents

# Where each reading sits in a station record.
NUMERIC_PATHS = {
    "air_temperature": "WeatherElement.AirTemperature",
    "air_pressure": "WeatherElement.AirPressure",
    "relative_humidity": "WeatherElement.RelativeHumidity",
    "wind_speed": "WeatherElement.WindSpeed",
    "wind_direction": "WeatherElement.WindDirection",
    "wind_direction_gust": "WeatherElement.GustInfo.Occurred_at.WindDirection",
    "peak_gust_speed": "WeatherElement.GustInfo.PeakGustSpeed",
    "precipitation": "WeatherElement.Now.Precipitation",
    "sunshine_duration_10Min": "WeatherElement.SunshineDuration",
    "uv_index": "WeatherElement.UVIndex",
}
TAGGED_PATHS = {"visibility": "WeatherElement.VisibilityDescription", "weather_status": "WeatherElement.Weather"}
GEO_NUMERIC_PATHS = {
    "station_latitude": "GeoInfo.Coordinates[0].StationLatitude",
    "station_longitude": "GeoInfo.Coordinates[0].StationLongitude",
    "station_altitude": "GeoInfo.StationAltitude",
}
GEO_TEXT_PATHS = {
    "country_name": "GeoInfo.CountyName",
    "country_code": "GeoInfo.CountyCode",
    "town_name": "GeoInfo.TownName",
    "town_code": "GeoInfo.TownCode",
    "coordinate_format": "GeoInfo.Coordinates[0].CoordinateFormat",
}


def station_records(documents: DataFrame, column: str = "value", lenient: bool = False) -> DataFrame:
    """One VARIANT ``record`` per station in each document; feeds M-1 and M-2.  ``lenient`` passes over malformed documents."""
    docs = parse_documents(documents.select(column), column, lenient=lenient)
    return flatten_two_level(docs, "doc", "records", "record").select("record")


def measurements(documents: DataFrame, column: str = "value", lenient: bool = False) -> DataFrame:
    """M-1: typed, cleaned readings, one per (station_id, measure_at).

    Which of several conflicting readings stays is settled by their values, the least first, so a rerun
    gives the same rows.
    """
    records = station_records(documents, column, lenient).select(
        field("record", "StationId").alias("station_id"),
        *[field("record", p, "double", lenient).alias(c) for c, p in NUMERIC_PATHS.items()],
        field("record", "StationName").alias("station_name"),
        *[field("record", p).alias(c) for c, p in TAGGED_PATHS.items()],
        parse_timestamp(field("record", "ObsTime.DateTime")).alias("measure_at"),
    )
    cleaned = records.select(
        "station_id",
        *[negative_to_null(c).alias(c) for c in NUMERIC_PATHS],
        "station_name",
        *[na_tag_to_null(c).alias(c) for c in TAGGED_PATHS],
        classify_station("station_id").alias("station_type"),
        "measure_at",
    )
    keys = ["measure_at", "station_id"]  # sorts compare instants sooner than ids that begin alike
    return keep_first(cleaned, keys, [F.col(c).asc_nulls_last() for c in cleaned.columns if c not in keys])  # a reading before none


def station_geo(documents: DataFrame, column: str = "value", lenient: bool = False) -> DataFrame:
    """M-2: distinct station descriptions; a station whose description changed has several (Q-12)."""
    described = station_records(documents, column, lenient).select(
        field("record", "StationId").alias("station_id"),
        *[field("record", p, "double", lenient).alias(c) for c, p in GEO_NUMERIC_PATHS.items()],
        *[field("record", p).alias(c) for c, p in GEO_TEXT_PATHS.items()],
    )
    return distinct_rows(described.withColumn("station_type", classify_station("station_id")))


def aggregated(measured: DataFrame) -> DataFrame:
    """M-5: measurements plus their 52 forward aggregates."""
    return window_bank(measured)


def hourly(source: DataFrame, from_bank: bool = True) -> DataFrame:
    """M-7, from the bank or straight from measurements."""
    return mart_from_bank(source, "hour") if from_bank else mart(source, "hour")


def daily(source: DataFrame, from_bank: bool = True) -> DataFrame:
    """M-8."""
    return mart_from_bank(source, "day") if from_bank else mart(source, "day")


def weekly(source: DataFrame, from_bank: bool = True) -> DataFrame:
    """M-9."""
    return mart_from_bank(source, "week") if from_bank else mart(source, "week")


def monthly(source: DataFrame, from_bank: bool = True) -> DataFrame:
    """M-10."""
    return mart_from_bank(source, "month") if from_bank else mart(source, "month")
