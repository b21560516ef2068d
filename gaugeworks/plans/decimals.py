"""The older models with decimals and nested columns: M-13, M-14 and M-15."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import parse_timestamp, quote_trim
from gaugeworks.operators.dedup import distinct_rows
from gaugeworks.operators.incremental import past_mark
from gaugeworks.operators.joins import not_in
from gaugeworks.operators.nested import field, flatten, flatten_two_level, parse_documents, subdocument
from gaugeworks.plans.stations import EXISTING

FLOOR = "2024-01-01"  # fixed value: the mark of an empty target

# Where each reading sits in a station record.
DECIMAL_PATHS = {
    "AirTemperature": "WeatherElement.AirTemperature",
    "AirPressure": "WeatherElement.AirPressure",
    "RelativeHumidity": "WeatherElement.RelativeHumidity",
    "WindSpeed": "WeatherElement.WindSpeed",
    "WindDirection": "WeatherElement.WindDirection",
    "WindDirectionGust": "WeatherElement.GustInfo.Occurred_at.WindDirection",
    "PeakGustSpeed": "WeatherElement.GustInfo.PeakGustSpeed",
    "Precipitation": "WeatherElement.Now.Precipitation",
    "SunshineDuration_10Min": "WeatherElement.SunshineDuration",
}


def extracted_records(
    raw: DataFrame, target: DataFrame | None = None, column: str = "raw_data", lenient: bool = False
) -> DataFrame:
    """M-13: every record, not cleaned; nested parts as JSON text.  With a target, only later ones.

    ``lenient`` passes over malformed documents and makes readings that are no numbers NULL.
    """

    def _decimal(path: str):
        return field("record", path, "decimal(10,2)", lenient)

    docs = parse_documents(raw.select(column), column, lenient=lenient)
    records = flatten_two_level(docs, "doc", "records", "record").select(
        quote_trim(field("record", "StationId")).alias("StationId"),
        quote_trim(field("record", "StationName")).alias("StationName"),
        parse_timestamp(field("record", "ObsTime.DateTime")).alias("ObsTime"),
        quote_trim(field("record", "WeatherElement.Weather")).alias("Weather"),
        *[_decimal(p).alias(c) for c, p in DECIMAL_PATHS.items()],
        quote_trim(field("record", "WeatherElement.VisibilityDescription")).alias("Visibility"),
        _decimal("WeatherElement.UVIndex").alias("UVIndex"),
        subdocument("record", "GeoInfo").alias("GeoInfo"),
        subdocument("doc", "result.fields").alias("StationFieldsInfo"),
    )
    return past_mark(records, target, "ObsTime", FLOOR)


def weather_records(extracted: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """M-15: M-13 without its nested columns, distinct."""
    flat = [c for c in extracted.columns if c not in ("GeoInfo", "StationFieldsInfo")]
    return past_mark(distinct_rows(extracted, flat), target, "ObsTime", FLOOR)


def station_directory(
    extracted: DataFrame,
    weather_documents: DataFrame,
    rain_documents: DataFrame,
    target: DataFrame | None = None,
    column: str = "raw_data",
    lenient: bool = False,
) -> DataFrame:
    """M-14: stations seen in records, completed from both registries.  With a target, only new ids.

    Known ids go before anything is parsed, made distinct or joined.  ``lenient`` as in M-13, for the registries.
    """
    seen = extracted.select("StationId", "StationName", "GeoInfo")
    seen = seen if target is None else not_in(seen, "StationId", target.select(F.col("StationID").alias("known")), "known")
    geo = parse_documents(seen, "GeoInfo", "g").select(
        F.col("StationId").alias("StationID"),
        "StationName",
        *[field("g", c).alias(c) for c in ("CountyName", "CountyCode", "TownName", "TownCode", "StationAltitude")],
        subdocument("g", "Coordinates[0]").alias("Coordinates_TWD67"),
        subdocument("g", "Coordinates[1]").alias("Coordinates_WGS84"),
    )
    weather = flatten(
        parse_documents(weather_documents.select(column), column, lenient=lenient), "doc", "records.data.stationStatus.station", "s"
    ).select(
        field("s", "StationID").alias("StationID"),
        field("s", "status").alias("status"),
        field("s", "StationLatitude", "double", lenient).alias("latitude"),
        field("s", "StationLongitude", "double", lenient).alias("longitude"),
        field("s", "Notes").alias("Notes"),
    )
    rain = flatten(parse_documents(rain_documents.select(column), column, lenient=lenient), "doc", "Data", "s").select(
        field("s", "Station_ID").alias("StationID"),
        field("s", "Station_Latitude", "decimal(10,5)", lenient).cast("double").alias("latitude"),
        field("s", "Station_Longitude", "decimal(10,5)", lenient).cast("double").alias("longitude"),
    )
    found = geo.distinct().alias("geo")
    first = F.parse_json("geo.Coordinates_TWD67")
    return (
        found.join(rain.alias("rain"), F.col("geo.StationID") == F.col("rain.StationID"), "left")
        .join(weather.alias("basic"), F.col("geo.StationID") == F.col("basic.StationID"), "left")
        .select(
            *[f"geo.{c}" for c in ("StationID", "StationName", "CountyName", "CountyCode", "TownName", "TownCode", "StationAltitude")],
            F.coalesce("basic.status", F.lit(EXISTING)).alias("StationStatus"),
            F.coalesce(field(first, "StationLatitude", "double", lenient), "basic.latitude", "rain.latitude").alias("StationLatitude"),
            F.coalesce(field(first, "StationLongitude", "double", lenient), "basic.longitude", "rain.longitude").alias("StationLongitude"),
            F.coalesce("basic.Notes", F.lit("")).alias("Notes"),
            "geo.Coordinates_TWD67",
            "geo.Coordinates_WGS84",
        )
    )
