"""Station models: M-3, M-4, M-6, M-11 and M-12."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import classify_station, empty_to_null, empty_to_null_date, first_present
from gaugeworks.operators.joins import full_outer
from gaugeworks.operators.nested import field, flatten, parse_documents

# The two station states.
EXISTING = "現存測站"
REVOKED = "已撤銷"


def rain_stations(documents: DataFrame, column: str = "value", lenient: bool = False) -> DataFrame:
    """M-3: rain-gauge registry, from the array under ``Data``."""
    rows = flatten(parse_documents(documents.select(column), column, lenient=lenient), "doc", "Data", "s")
    return rows.select(
        field("s", "Station_ID").alias("station_id"),
        field("s", "CITY_SN").alias("city_code"),
        field("s", "TOWN_SN").alias("town_code"),
        field("s", "Station_name").alias("station_name"),
        field("s", "Station_Latitude", "decimal(10,5)", lenient).alias("station_latitude"),
        field("s", "Station_Longitude", "decimal(10,5)", lenient).alias("station_longitude"),
        field("s", "CITY").alias("city_name"),
        field("s", "TOWN").alias("town_name"),
    )


def weather_stations(documents: DataFrame, column: str = "value", lenient: bool = False) -> DataFrame:
    """M-4: weather-station registry, from a deep path."""
    rows = flatten(parse_documents(documents.select(column), column, lenient=lenient), "doc", "records.data.stationStatus.station", "s")
    return rows.select(
        field("s", "StationID").alias("station_id"),
        empty_to_null(field("s", "OriginalStationID")).alias("original_station_id"),
        empty_to_null(field("s", "NewStationID")).alias("new_station_id"),
        field("s", "status").alias("station_status"),
        field("s", "StationName").alias("station_name"),
        field("s", "StationNameEN").alias("station_name_en"),
        field("s", "CountyName").alias("country_name"),
        field("s", "Location").alias("location"),
        empty_to_null(field("s", "Notes")).alias("notes"),
        field("s", "StationAltitude", "double", lenient).alias("station_altitude"),
        field("s", "StationLongitude", "double", lenient).alias("station_longitude"),
        field("s", "StationLatitude", "double", lenient).alias("station_latitude"),
        empty_to_null_date(field("s", "StationStartDate")).alias("start_at"),
        empty_to_null_date(field("s", "StationEndDate")).alias("end_at"),
    )


def registries(rain: DataFrame, weather: DataFrame) -> DataFrame:
    """First join of M-6: rain gauges lead for id, name and place, weather stations for coordinates."""
    return full_outer(rain, weather, "station_id").select(
        first_present("l.station_id", "r.station_id").alias("station_id"),
        "r.original_station_id",
        "r.new_station_id",
        "l.city_code",
        "l.town_code",
        "r.station_status",
        first_present("l.station_name", "r.station_name").alias("station_name"),
        "r.station_name_en",
        first_present("l.city_name", "r.country_name").alias("city_name"),
        "l.town_name",
        "r.location",
        "r.notes",
        "r.station_altitude",
        first_present("r.station_longitude", "l.station_longitude").alias("station_longitude"),
        first_present("r.station_latitude", "l.station_latitude").alias("station_latitude"),
        "r.start_at",
        "r.end_at",
    )


def stations(rain: DataFrame, weather: DataFrame, geo: DataFrame) -> DataFrame:
    """M-6: all three registries."""
    return with_geo(registries(rain, weather), geo)


def with_geo(joined: DataFrame, geo: DataFrame) -> DataFrame:
    """Second join of M-6.  The station class comes from the id before this join (Q-10)."""
    return full_outer(joined, geo, "station_id").select(
        first_present("l.station_id", "r.station_id").alias("station_id"),
        "l.original_station_id",
        "l.new_station_id",
        first_present("l.city_code", "r.country_code").alias("country_code"),
        first_present("l.town_code", "r.town_code").alias("town_code"),
        "l.station_status",
        "l.station_name",
        "l.station_name_en",
        first_present("l.city_name", "r.country_name").alias("country_name"),
        first_present("l.town_name", "r.town_name").alias("town_name"),
        "l.location",
        "l.notes",
        F.col("r.coordinate_format").alias("tw97_coordinate_format"),
        classify_station("l.station_id").alias("station_type"),
        "l.station_altitude",
        F.col("l.station_longitude").alias("station_longitude_wgs87"),
        F.col("l.station_latitude").alias("station_latitude_wgs87"),
        F.col("r.station_longitude").alias("station_longitude_tw97"),
        F.col("r.station_latitude").alias("station_latitude_tw97"),
        "l.start_at",
        "l.end_at",
    )


def existing_stations(all_stations: DataFrame) -> DataFrame:
    """M-11; a NULL status is in neither mart (Q-11)."""
    return all_stations.where(F.col("station_status") == EXISTING)


def revoked_stations(all_stations: DataFrame) -> DataFrame:
    """M-12."""
    return all_stations.where(F.col("station_status") == REVOKED)
