"""Materialisation of the models under one root folder, incremental or full."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.operators.incremental import append_all, append_past_mark, delete_insert, full_refresh, past_mark
from gaugeworks.operators.marts import GRAIN_WORD, mart_from_bank
from gaugeworks.plans import decimals, measurements, stations
from gaugeworks.sources import tables


HUGE_METHOD = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def _compiled(spark: SparkSession) -> Iterator[None]:
    """Plans with a generated method of over 8,000 bytes, which the JVM would never compile, run on split projections."""
    before = spark.conf.get(HUGE_METHOD)
    spark.conf.set(HUGE_METHOD, "8000")
    try:
        yield
    finally:
        spark.conf.set(HUGE_METHOD, before)


def _staged(df: DataFrame, root: str, name: str) -> DataFrame:
    """Written once and read back: what several branches read is then parsed and shuffled only once."""
    path = f"{root}/staged/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def refresh_measurements(spark: SparkSession, documents: DataFrame, root: str, full: bool = False) -> None:
    """M-5 and M-7 to M-10.  Incrementally, each table takes what lies past its own mark.

    The mark is applied before the forward aggregates are computed, see ``append_past_mark``.
    """
    with _compiled(spark):
        _refresh_measurements(spark, documents, root, full)


def _refresh_measurements(spark: SparkSession, documents: DataFrame, root: str, full: bool) -> None:
    bank_path = f"{root}/aggregated_measurements"
    target = None if full else tables.read(spark, bank_path)
    new = _staged(past_mark(measurements.measurements(documents), target, "measure_at"), root, "measurements")
    write = full_refresh if full else tables.append
    write(measurements.aggregated(new), bank_path)
    bank = tables.read(spark, bank_path)
    for grain, word in GRAIN_WORD.items():
        path = f"{root}/{word}_measurements"
        if full:
            full_refresh(mart_from_bank(bank, grain), path)
        else:
            append_past_mark(mart_from_bank(bank, grain), path, "measure_at")


def refresh_stations(
    spark: SparkSession, rain: DataFrame, weather: DataFrame, snapshots: DataFrame, root: str, append: bool = False
) -> None:
    """M-6, M-11 and M-12 from the three kinds of documents.

    The marts are replaced, unless ``append`` asks for the older way of adding everything again (Q-14).
    """
    rain_gauges = _staged(stations.rain_stations(rain), root, "rain_stations")
    weather_stations = _staged(stations.weather_stations(weather), root, "weather_stations")
    geo = _staged(measurements.station_geo(snapshots), root, "station_geo")
    registries = _staged(stations.registries(rain_gauges, weather_stations), root, "registries")
    full_refresh(stations.with_geo(registries, geo), f"{root}/stations")
    table = tables.read(spark, f"{root}/stations")
    write = append_all if append else full_refresh
    write(stations.existing_stations(table), f"{root}/existing_stations")
    write(stations.revoked_stations(table), f"{root}/revoked_stations")


def refresh_decimals(
    spark: SparkSession, raw: DataFrame, raw_weather: DataFrame, raw_rain: DataFrame, root: str
) -> None:
    """M-13, M-15 and M-14, incrementally."""
    extracted_path, records_path = f"{root}/extracted_records", f"{root}/weather_records"
    tables.append(decimals.extracted_records(raw, tables.read(spark, extracted_path)), extracted_path)
    extracted = spark.read.parquet(extracted_path)
    tables.append(decimals.weather_records(extracted, tables.read(spark, records_path)), records_path)
    directory = f"{root}/station_directory"
    new = decimals.station_directory(extracted, raw_weather, raw_rain, tables.read(spark, directory))
    delete_insert(new, directory, "StationID")
