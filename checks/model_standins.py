"""Given tables dressed as the documents the models read, and the tables these models must yield, in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.standins import RAW_READINGS, RAW_TEXTS, SQL_CLASS, dealt, table
from gaugeworks.plans.decimals import DECIMAL_PATHS
from gaugeworks.plans.measurements import NUMERIC_PATHS
from gaugeworks.plans.stations import EXISTING, REVOKED

STATION = """concat(CASE {k} % 4 WHEN 0 THEN '46' WHEN 1 THEN 'C0' WHEN 2 THEN 'C1' ELSE '88' END,
    lpad(CAST({k} AS {text}), 9, '0'))"""

# Station descriptions; the same expressions in both engines.  A fifth of the stations has no coordinates.
GEO = {
    "county": "concat('county ', user_id % 20)",
    "county_code": "CAST(user_id % 20 AS {text})",
    "town": "CASE WHEN event_type = 'error' THEN 'old town' ELSE 'town' END",
    "town_code": "CAST(user_id % 100 AS {text})",
    "altitude": "CAST(user_id AS {text})",
    "latitude": "CASE WHEN user_id % 5 = 0 THEN NULL ELSE CAST(20 + user_id % 8 AS {text}) END",
    "longitude": "CASE WHEN user_id % 5 = 0 THEN NULL ELSE CAST(120 + user_id % 3 AS {text}) END",
}

RECORD = """named_struct('StationId', station_id, 'StationName', station_name,
    'ObsTime', named_struct('DateTime', at),
    'GeoInfo', named_struct('TownCode', town_code, 'TownName', town, 'CountyName', county, 'CountyCode', county_code,
        'StationAltitude', altitude, 'Coordinates', array(
            named_struct('CoordinateFormat', 'TWD67', 'StationLatitude', latitude, 'StationLongitude', longitude),
            named_struct('CoordinateFormat', 'WGS84', 'StationLatitude', latitude, 'StationLongitude', longitude))),
    'WeatherElement', named_struct('Weather', weather_status, 'VisibilityDescription', visibility,
        'AirTemperature', air_temperature, 'AirPressure', air_pressure, 'RelativeHumidity', relative_humidity,
        'WindSpeed', wind_speed, 'WindDirection', wind_direction, 'SunshineDuration', sunshine_duration_10Min,
        'UVIndex', uv_index, 'Now', named_struct('Precipitation', precipitation),
        'GustInfo', named_struct('PeakGustSpeed', peak_gust_speed,
            'Occurred_at', named_struct('WindDirection', wind_direction_gust))))"""


def snapshots(spark: SparkSession, sf_dir: str, column: str = "value") -> DataFrame:
    """A document for each event, and ``measure_at`` beside it; the record is under one of two keys."""
    at = F.expr("CAST(CAST(ts AS DATE) AS TIMESTAMP_NTZ) + make_dt_interval(0, hour(ts), CAST(10 * floor(minute(ts) / 10) AS INT))")
    events = dealt(table(spark, sf_dir, "events")).select(
        "event_id",
        "event_type",
        at.alias("measure_at"),
        F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00")).alias("at"),
        F.expr(STATION.format(k="user_id", text="STRING")).alias("station_id"),
        F.expr("concat('Station ', user_id)").alias("station_name"),
        *[F.expr(e).cast("double").alias(c) for c, e in RAW_READINGS.items()],
        *[F.expr(e).alias(c) for c, e in RAW_TEXTS.items()],
        *[F.expr(e.format(text="STRING")).alias(c) for c, e in GEO.items()],
    )
    records = "named_struct('Station', IF(event_id % 2 = 0, array({r}), NULL), 'Other', IF(event_id % 2 = 1, array({r}), NULL), 'Note', 'text')"
    document = f"to_json(named_struct('result', named_struct('fields', array(event_type)), 'records', {records.format(r=RECORD)}))"
    return events.select(F.expr(document).alias(column), "measure_at")


def rain_documents(spark: SparkSession, sf_dir: str, column: str = "value") -> DataFrame:
    """A document for each supplier; some have no id."""
    station = f"""named_struct('Station_ID', CASE WHEN s_suppkey % 50 <> 3 THEN {STATION.format(k='s_suppkey', text='STRING')} END,
        'CITY_SN', CAST(s_nationkey AS STRING), 'TOWN_SN', CAST(s_nationkey % 5 AS STRING), 'Station_name', s_name,
        'Station_Latitude', CAST(s_acctbal / 1000 AS STRING), 'Station_Longitude', 120 + s_nationkey,
        'CITY', concat('city ', s_nationkey), 'TOWN', concat('town ', s_suppkey % 7))"""
    return table(spark, sf_dir, "supplier").select(F.expr(f"to_json(named_struct('Data', array({station})))").alias(column))


def weather_documents(spark: SparkSession, sf_dir: str, column: str = "value") -> DataFrame:
    """A document for each customer; a third is revoked, a third has no status."""
    day = "CAST(date_add(DATE'2020-01-01', CAST(c_custkey % 1000 AS INT)) AS STRING)"
    station = f"""named_struct('StationID', {STATION.format(k='c_custkey', text='STRING')},
        'OriginalStationID', CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_name END, 'NewStationID', '',
        'status', CASE c_custkey % 3 WHEN 0 THEN '{EXISTING}' WHEN 1 THEN '{REVOKED}' END,
        'StationName', concat('weather ', c_name), 'StationNameEN', c_name, 'CountyName', c_mktsegment,
        'Location', concat('place ', c_nationkey), 'Notes', CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END,
        'StationAltitude', c_acctbal, 'StationLongitude', CAST(120 + c_nationkey AS STRING), 'StationLatitude', 20 + c_nationkey,
        'StationStartDate', {day}, 'StationEndDate', CASE WHEN c_custkey % 3 = 1 THEN {day} ELSE '' END)"""
    nested = f"named_struct('records', named_struct('data', named_struct('stationStatus', named_struct('station', array({station})))))"
    return table(spark, sf_dir, "customer").select(F.expr(f"to_json({nested})").alias(column))


SQL_SNAPSHOTS = (
    f"snapshots AS (SELECT event_id, event_type, time_bucket(INTERVAL '10 minutes', ts) AS measure_at, "
    f"{STATION.format(k='user_id', text='VARCHAR')} AS station_id, concat('Station ', user_id) AS station_name, "
    + ", ".join(f"CAST({e} AS DOUBLE) AS {c}" for c, e in RAW_READINGS.items())
    + ", "
    + ", ".join(f"{e} AS {c}" for c, e in RAW_TEXTS.items())
    + ", "
    + ", ".join(f"{e.format(text='VARCHAR')} AS {c}" for c, e in GEO.items())
    + " FROM events)"
)
_ORDER = [*NUMERIC_PATHS, "station_name", *RAW_TEXTS, "station_type"]
SQL_MEASURED = (
    SQL_SNAPSHOTS
    + ", cleaned AS (SELECT station_id, "
    + ", ".join(f"CASE WHEN {c} < 0 THEN NULL ELSE {c} END AS {c}" for c in NUMERIC_PATHS)
    + ", station_name, "
    + ", ".join(f"nullif({c}, '-99') AS {c}" for c in RAW_TEXTS)
    + f", {SQL_CLASS.format(id='station_id')} AS station_type, measure_at FROM snapshots)"
    + ", measurements AS (SELECT * FROM cleaned QUALIFY row_number() OVER (PARTITION BY station_id, measure_at ORDER BY "
    + ", ".join(f"{c} NULLS LAST" for c in _ORDER)
    + ") = 1)"
)
SQL_GEO = (
    SQL_SNAPSHOTS
    + f""", geo AS (SELECT DISTINCT station_id, CAST(latitude AS DOUBLE) AS station_latitude, CAST(longitude AS DOUBLE) AS station_longitude,
    CAST(altitude AS DOUBLE) AS station_altitude, county AS country_name, county_code AS country_code, town AS town_name, town_code,
    'TWD67' AS coordinate_format, {SQL_CLASS.format(id='station_id')} AS station_type FROM snapshots)"""
)
SQL_RAIN = f"""rain AS (SELECT CASE WHEN s_suppkey % 50 <> 3 THEN {STATION.format(k='s_suppkey', text='VARCHAR')} END AS station_id,
    CAST(s_nationkey AS VARCHAR) AS city_code, CAST(s_nationkey % 5 AS VARCHAR) AS town_code, s_name AS station_name,
    CAST(s_acctbal / 1000 AS DECIMAL(10, 5)) AS station_latitude, CAST(120 + s_nationkey AS DECIMAL(10, 5)) AS station_longitude,
    concat('city ', s_nationkey) AS city_name, concat('town ', s_suppkey % 7) AS town_name FROM supplier)"""
SQL_WEATHER = f"""weather AS (SELECT {STATION.format(k='c_custkey', text='VARCHAR')} AS station_id,
    CASE WHEN c_custkey % 2 = 1 THEN c_name END AS original_station_id, CAST(NULL AS VARCHAR) AS new_station_id,
    CASE c_custkey % 3 WHEN 0 THEN '{EXISTING}' WHEN 1 THEN '{REVOKED}' END AS station_status, concat('weather ', c_name) AS station_name,
    c_name AS station_name_en, c_mktsegment AS country_name, concat('place ', c_nationkey) AS location,
    CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS notes, c_acctbal AS station_altitude,
    CAST(120 + c_nationkey AS DOUBLE) AS station_longitude, CAST(20 + c_nationkey AS DOUBLE) AS station_latitude,
    DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS start_at,
    CASE WHEN c_custkey % 3 = 1 THEN DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) END AS end_at FROM customer)"""
SQL_STATIONS = f"""{SQL_GEO}, {SQL_RAIN}, {SQL_WEATHER}, registries AS (SELECT coalesce(l.station_id, r.station_id) AS station_id,
        original_station_id, new_station_id, city_code, town_code, station_status, coalesce(l.station_name, r.station_name) AS station_name,
        station_name_en, coalesce(city_name, country_name) AS city_name, town_name, location, notes, station_altitude,
        coalesce(r.station_longitude, l.station_longitude) AS station_longitude,
        coalesce(r.station_latitude, l.station_latitude) AS station_latitude, start_at, end_at
    FROM rain l FULL OUTER JOIN weather r ON l.station_id = r.station_id),
    stations AS (SELECT coalesce(l.station_id, r.station_id) AS station_id, original_station_id, new_station_id,
        coalesce(city_code, country_code) AS country_code, coalesce(l.town_code, r.town_code) AS town_code, station_status,
        station_name, station_name_en, coalesce(city_name, country_name) AS country_name,
        coalesce(l.town_name, r.town_name) AS town_name, location, notes, coordinate_format AS tw97_coordinate_format,
        {SQL_CLASS.format(id='l.station_id')} AS station_type, l.station_altitude,
        l.station_longitude AS station_longitude_wgs87, l.station_latitude AS station_latitude_wgs87,
        r.station_longitude AS station_longitude_tw97, r.station_latitude AS station_latitude_tw97, start_at, end_at
    FROM registries l FULL OUTER JOIN geo r ON l.station_id = r.station_id)"""


def _coordinates(name: str) -> str:
    """JSON text of one pair of coordinates; members without a value are left out."""
    pair = """concat(',"StationLatitude":"', latitude, '","StationLongitude":"', longitude, '"')"""
    return f"""concat('{{"CoordinateFormat":"{name}"', CASE WHEN latitude IS NOT NULL THEN {pair} ELSE '' END, '}}')"""


_READING = {path: column for column, path in NUMERIC_PATHS.items()}
SQL_EXTRACTED = (
    SQL_SNAPSHOTS
    + ", extracted AS (SELECT station_id AS StationId, station_name AS StationName, measure_at AS ObsTime, weather_status AS Weather, "
    + ", ".join(f"CAST(CAST({_READING[path]} AS VARCHAR) AS DECIMAL(10, 2)) AS {c}" for c, path in DECIMAL_PATHS.items())
    + f""", visibility AS Visibility, CAST(uv_index AS DECIMAL(10, 2)) AS UVIndex,
    concat('{{"Coordinates":[', {_coordinates('TWD67')}, ',', {_coordinates('WGS84')}, '],"CountyCode":"', county_code,
        '","CountyName":"', county, '","StationAltitude":"', altitude, '","TownCode":"', town_code, '","TownName":"', town, '"}}') AS GeoInfo,
    concat('["', event_type, '"]') AS StationFieldsInfo FROM snapshots)"""
)
SQL_DIRECTORY = f"""{SQL_SNAPSHOTS}, {SQL_RAIN}, {SQL_WEATHER}, seen AS (SELECT DISTINCT station_id, station_name, county, county_code, town, town_code,
        altitude, latitude, longitude, {_coordinates('TWD67')} AS Coordinates_TWD67, {_coordinates('WGS84')} AS Coordinates_WGS84 FROM snapshots),
    directory AS (SELECT seen.station_id AS StationID, seen.station_name AS StationName, county AS CountyName, county_code AS CountyCode,
        town AS TownName, seen.town_code AS TownCode, altitude AS StationAltitude, coalesce(station_status, '{EXISTING}') AS StationStatus,
        coalesce(CAST(latitude AS DOUBLE), weather.station_latitude, CAST(rain.station_latitude AS DOUBLE)) AS StationLatitude,
        coalesce(CAST(longitude AS DOUBLE), weather.station_longitude, CAST(rain.station_longitude AS DOUBLE)) AS StationLongitude,
        coalesce(notes, '') AS Notes, Coordinates_TWD67, Coordinates_WGS84
    FROM seen LEFT JOIN rain ON seen.station_id = rain.station_id LEFT JOIN weather ON seen.station_id = weather.station_id)"""
