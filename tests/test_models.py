"""Models on hand-written documents."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks import model_standins
from gaugeworks.plans import decimals, measurements, refresh, stations
from gaugeworks.sources import tables


def record(station, at="2024-01-01T00:00:00+08:00", temperature="12.5", weather="晴", geo="A", **element):
    return {
        "StationId": station,
        "StationName": f"name {station}",
        "ObsTime": {"DateTime": at},
        "GeoInfo": {
            "CountyName": f"county {geo}",
            "CountyCode": "10",
            "TownName": "town",
            "TownCode": "1001",
            "StationAltitude": "33.1",
            "Coordinates": [
                {"CoordinateFormat": "Decimal", "StationLatitude": "25.1", "StationLongitude": 121.5},
                {"CoordinateFormat": "DMS", "StationLatitude": 25.2, "StationLongitude": 121.6},
            ],
        },
        "WeatherElement": {
            "Weather": weather,
            "VisibilityDescription": "-99",
            "AirTemperature": temperature,
            "AirPressure": 1001.25,
            "RelativeHumidity": "-99",
            "WindSpeed": "2.345",
            "WindDirection": "180",
            "SunshineDuration": "0.5",
            "UVIndex": "3",
            "Now": {"Precipitation": "1.0"},
            "GustInfo": {"PeakGustSpeed": "-3.2", "Occurred_at": {"WindDirection": "20"}},
            **element,
        },
    }


def documents(spark, docs, column="value"):
    return spark.createDataFrame([(json.dumps(d, ensure_ascii=False),) for d in docs], f"{column} string")


def snapshot(*records, **other_keys):
    return {"result": {"fields": [{"id": "f"}]}, "records": {"Station": list(records), **other_keys}}


def test_measurements(spark):
    docs = documents(
        spark,
        [
            snapshot(record("466920", temperature="-3.2"), record("C0A520"), Empty=[], Note="text", Other=[record("C1F891")]),
            snapshot(record("72C440", temperature=12.5, weather="-99"), record(None, weather="-99.0")),
            snapshot(record("C0A520", temperature="7.0")),
            {"nothing": 1},
            {"records": None},
        ],
    )
    rows = {r.station_id: r for r in measurements.measurements(docs).collect()}
    assert len(rows) == 5 and len(rows[None]) == 16
    assert rows["466920"].air_temperature is None and rows["466920"].station_type == "有人站"
    assert rows["C0A520"].air_temperature == 7.0 and rows["C0A520"].station_type == "自動站"
    assert rows["C1F891"].station_type == "自動站"
    assert rows["72C440"].air_temperature == 12.5 and rows["72C440"].weather_status is None
    assert rows[None].weather_status == "-99.0" and rows[None].station_type == "農業雨量站"
    assert rows["C0A520"].measure_at == dt.datetime(2024, 1, 1)
    assert rows["C0A520"].peak_gust_speed is None and rows["C0A520"].visibility is None
    assert rows["C0A520"].wind_direction_gust == 20.0 and rows["C0A520"].sunshine_duration_10Min == 0.5


def test_text_that_is_no_number(spark):
    docs = documents(spark, [snapshot(record("466920", Now={"Precipitation": "T"}))])
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        measurements.measurements(docs).collect()
    assert measurements.measurements(docs, lenient=True).first().precipitation is None


def test_malformed_documents(spark, three):
    rain, weather, geo = (d.union(spark.createDataFrame([("{",)], "value string")) for d in three)
    models = [(stations.rain_stations, rain, 3), (stations.weather_stations, weather, 2), (measurements.station_geo, geo, 2), (measurements.measurements, geo, 2)]
    for model, docs, n in models:
        with pytest.raises(Exception, match="MALFORMED_RECORD"):
            model(docs).collect()
        assert len(model(docs, lenient=True).collect()) == n


def test_malformed_documents_of_the_decimal_models(spark):
    broken = spark.createDataFrame([("{",)], "raw_data string")
    raw = documents(spark, [snapshot(record("466920", Now={"Precipitation": "T"}))], "raw_data").union(broken)
    weather = documents(spark, [registry(weather_station("466920", Notes="kept"))], "raw_data").union(broken)
    rain = documents(spark, [{"Data": [rain_station("C0A520")]}], "raw_data").union(broken)
    with pytest.raises(Exception, match="MALFORMED_RECORD|INVALID_VARIANT_CAST"):
        decimals.extracted_records(raw).collect()
    extracted = decimals.extracted_records(raw, lenient=True)
    assert [r.Precipitation for r in extracted.collect()] == [None]
    rows = decimals.station_directory(extracted, weather, rain, lenient=True).collect()
    assert [(r.StationID, r.Notes) for r in rows] == [("466920", "kept")]


def test_station_geo_keeps_every_description(spark):
    docs = documents(spark, [snapshot(record("C0A520")), snapshot(record("C0A520")), snapshot(record("C0A520", geo="B"))])
    rows = measurements.station_geo(docs).orderBy("country_name").collect()
    assert [(r.station_latitude, r.station_longitude, r.country_name) for r in rows] == [
        (25.1, 121.5, "county A"),
        (25.1, 121.5, "county B"),
    ]
    assert rows[0].coordinate_format == "Decimal" and rows[0].station_altitude == 33.1


def weather_station(station, **other):
    blank = {"OriginalStationID": "", "NewStationID": "", "Notes": "", "StationEndDate": ""}
    known = {
        "StationID": station,
        "status": "現存測站",
        "StationName": f"weather {station}",
        "StationNameEN": "en",
        "CountyName": "weather county",
        "Location": "place",
        "StationAltitude": "5",
        "StationLongitude": "120.1",
        "StationLatitude": 24.1,
        "StationStartDate": "2020-02-29",
    }
    return {**known, **blank, **other}


def registry(*rows):
    return {"records": {"data": {"stationStatus": {"station": list(rows)}}}}


def rain_station(station):
    return {
        "Station_ID": station,
        "Station_name": f"rain {station}",
        "CITY": "rain city",
        "CITY_SN": "01",
        "TOWN": "rain town",
        "TOWN_SN": "0101",
        "Station_Latitude": "23.123456",
        "Station_Longitude": 120.5,
    }


@pytest.fixture
def three(spark):
    rain = documents(spark, [{"Data": [rain_station("466920"), rain_station("R1"), rain_station(None)]}, {"Data": []}])
    weather = documents(
        spark,
        [registry(weather_station("466920"), weather_station("C0W", status="已撤銷", StationEndDate="2021-01-01", Notes="n"))],
    )
    geo = documents(spark, [snapshot(record("466920"), record("C0GEO"))])
    return rain, weather, geo


def test_stations(spark, three):
    rain, weather, geo = three
    typed = stations.weather_stations(weather)
    assert dict(typed.dtypes)["start_at"] == "date" and dict(stations.rain_stations(rain).dtypes)["station_latitude"] == "decimal(10,5)"
    assert stations.rain_stations(rain).where("station_id = 'R1'").first().station_latitude == Decimal("23.12346")
    joined = stations.stations(stations.rain_stations(rain), typed, measurements.station_geo(geo))
    rows = {r.station_id: r for r in joined.collect()}
    assert set(rows) == {"466920", "R1", None, "C0W", "C0GEO"} and len(joined.columns) == 21
    all_three = rows["466920"]
    assert all_three.station_name == "rain 466920" and all_three.country_name == "rain city"
    assert all_three.station_longitude_wgs87 == 120.1 and all_three.station_latitude_tw97 == 25.1
    assert all_three.start_at == dt.date(2020, 2, 29) and all_three.end_at is None and all_three.notes is None
    assert rows["R1"].station_status is None and rows["R1"].station_latitude_wgs87 == 23.12346
    assert rows["C0W"].end_at == dt.date(2021, 1, 1) and rows["C0W"].notes == "n"
    assert rows["C0GEO"].country_code == "10" and rows["C0GEO"].station_type == "農業雨量站"
    assert [r.station_id for r in stations.existing_stations(joined).collect()] == ["466920"]
    assert [r.station_id for r in stations.revoked_stations(joined).collect()] == ["C0W"]


def test_refresh_stations_twice(spark, three, tmp_path):
    rain, weather, geo = three
    for _ in range(2):
        refresh.refresh_stations(spark, rain, weather, geo, str(tmp_path))
    assert tables.read(spark, f"{tmp_path}/existing_stations").count() == 1
    refresh.refresh_stations(spark, rain, weather, geo, str(tmp_path), append=True)
    assert tables.read(spark, f"{tmp_path}/existing_stations").count() == 2


def test_decimal_models(spark, tmp_path):
    raw = documents(spark, [snapshot(record('"C0A520"', temperature="-99")), snapshot(record("466920"))], "raw_data")
    rain = documents(spark, [{"Data": [rain_station("C0A520")]}], "raw_data")
    weather = documents(spark, [registry(weather_station("466920", Notes="kept", status="已撤銷"))], "raw_data")
    refresh.refresh_decimals(spark, raw, weather, rain, str(tmp_path))
    extracted = tables.read(spark, f"{tmp_path}/extracted_records")
    assert len(extracted.columns) == 17 and dict(extracted.dtypes)["WindSpeed"] == "decimal(10,2)"
    row = extracted.where("StationId = 'C0A520'").first()
    assert row.AirTemperature == Decimal("-99.00") and row.WindSpeed == Decimal("2.35") and row.Visibility == "-99"
    assert json.loads(row.StationFieldsInfo) == [{"id": "f"}] and json.loads(row.GeoInfo)["CountyCode"] == "10"
    directory = {r.StationID: r for r in tables.read(spark, f"{tmp_path}/station_directory").collect()}
    assert directory["466920"].StationStatus == "已撤銷" and directory["466920"].Notes == "kept"
    assert directory["C0A520"].StationStatus == "現存測站" and directory["C0A520"].Notes == ""
    assert directory["C0A520"].StationLatitude == 25.1 and json.loads(directory["C0A520"].Coordinates_WGS84)["StationLatitude"] == 25.2

    again = documents(
        spark,
        [snapshot(record("466920"), record("N", at="2024-01-01T00:10:00+08:00"), record("LATE", at="2023-12-31T00:00:00+08:00"))],
        "raw_data",
    )
    refresh.refresh_decimals(spark, again, weather, rain, str(tmp_path))
    assert tables.read(spark, f"{tmp_path}/extracted_records").count() == 3
    assert tables.read(spark, f"{tmp_path}/weather_records").count() == 3
    names = sorted(r.StationID for r in tables.read(spark, f"{tmp_path}/station_directory").collect())
    assert names == ["466920", "C0A520", "N"]


def test_refresh_measurements_runs_no_method_too_long_to_compile(spark, tmp_path, monkeypatch):
    limit, seen, append = "spark.sql.codegen.hugeMethodLimit", [], tables.append
    before = spark.conf.get(limit)
    monkeypatch.setattr(tables, "append", lambda df, path: (seen.append(spark.conf.get(limit)), append(df, path)))
    refresh.refresh_measurements(spark, documents(spark, [snapshot(record("466920"))]), str(tmp_path))
    assert set(seen) == {"8000"} and spark.conf.get(limit) == before
    monkeypatch.setattr(tables, "append", lambda df, path: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh.refresh_measurements(spark, documents(spark, [snapshot(record("466920"))]), str(tmp_path / "again"))
    assert spark.conf.get(limit) == before


def test_snapshots_of_one_small_file_go_to_all_cores(spark, tmp_path):
    event = (0, dt.datetime(2024, 1, 1), 1, "view", 2.0, "{}")
    events = spark.createDataFrame([event] * 100, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    found = model_standins.snapshots(spark, str(tmp_path))
    assert found.count() == 100
    assert found.select(F.spark_partition_id()).distinct().count() > spark.sparkContext.defaultParallelism


def test_refresh_measurements_truncates_until_full(spark, tmp_path):
    def at(minutes):
        stamp = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)
        return snapshot(record("466920", at=f"{stamp.isoformat()}+08:00", temperature=str(minutes)))

    first = [at(m) for m in range(0, 130, 10)]
    everything = [at(m) for m in range(0, 260, 10)]
    refresh.refresh_measurements(spark, documents(spark, first), str(tmp_path))
    refresh.refresh_measurements(spark, documents(spark, everything), str(tmp_path))

    def hourly():
        rows = tables.read(spark, f"{tmp_path}/hourly_measurements").orderBy("measure_at").collect()
        return [(r.measure_at.hour, r.air_temperature, r.air_temperaturemax, r.precipitation_sum) for r in rows]

    # The frame that began in the first batch was cut off there and stays so.
    assert hourly() == [(0, 30.0, 60.0, 7.0), (1, 90.0, 120.0, 7.0), (2, 120.0, 120.0, 1.0), (3, 210.0, 240.0, 7.0), (4, 245.0, 250.0, 2.0)]
    refresh.refresh_measurements(spark, documents(spark, everything), str(tmp_path), full=True)
    assert hourly()[2] == (2, 150.0, 180.0, 7.0)
    columns = tables.read(spark, f"{tmp_path}/monthly_measurements").columns
    assert len(columns) == 17 and "sunshine_duration" in columns and "peak_gust_speedmax" in columns
    assert len(tables.read(spark, f"{tmp_path}/aggregated_measurements").columns) == 68
