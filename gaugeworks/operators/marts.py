"""Marts: measurements sampled at the boundaries of a grain (R-21, R-25, R-26).

Two routes with the same result on complete data.  ``mart_from_bank`` reads a materialised window
bank and only filters and renames.  ``mart`` starts from measurements: at a boundary ``t`` the frame
``[t, t + grain]`` is the bucket that starts at ``t`` plus the one row at the start of the next bucket,
so each row is added to its bucket, boundary rows also to the bucket before, and one aggregation with
partial sums per task does it all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import round2, truncate

# Word used in column names, and frame length, per grain; columns per aggregate.
GRAIN_WORD = {"hour": "hourly", "day": "daily", "week": "weekly", "month": "monthly"}
GRAIN_INTERVAL = {"hour": "1 hour", "day": "1 day", "week": "1 week", "month": "1 month"}
AVERAGED = ("air_temperature", "air_pressure", "relative_humidity", "wind_speed", "precipitation")
SUMMED = ("precipitation", "sunshine_duration_10Min")
MAXED = ("air_temperature", "air_pressure", "relative_humidity", "wind_speed", "peak_gust_speed", "precipitation")
IDENTITY = ("station_id", "station_name", "station_type", "measure_at")


def at_boundary(df: DataFrame, grain: str, ts: str = "measure_at") -> DataFrame:
    """R-21: rows that lie exactly on the start of their grain."""
    return df.where(F.col(ts) == truncate(grain, ts))


def select_by_suffix(df: DataFrame, grain: str, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """R-25: the identity columns and those of the grain, found by name in any case."""
    word = GRAIN_WORD[grain]
    endings = tuple(f"{word}_{kind}" for kind in ("sum", "average", "max"))
    return df.select(*identity, *[c for c in df.columns if c.lower().endswith(endings)])


def mart_name(column: str, grain: str) -> str:
    """R-26: sums keep ``_sum`` but for sunshine, averages lose their ending, maxima end in ``max``."""
    word, name = GRAIN_WORD[grain], column.lower()
    if name.startswith("sunshine_duration_10min") and name.endswith(f"_{word}_sum"):
        return name.replace(f"_10min_{word}_sum", "")
    return name.replace(f"_{word}_sum", "_sum").replace(f"_{word}_average", "").replace(f"_{word}_max", "max")


def rename_by_pattern(df: DataFrame, grain: str, identity: Sequence[str] = IDENTITY) -> DataFrame:
    return df.withColumnsRenamed({c: mart_name(c, grain) for c in df.columns if c not in identity})


def mart_from_bank(bank: DataFrame, grain: str, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """M-7 to M-10 from the window bank: filter at the boundary, then project; no shuffle."""
    return rename_by_pattern(select_by_suffix(at_boundary(bank, grain), grain, identity), grain, identity)


def mart(
    measurements: DataFrame,
    grain: str,
    averaged: Sequence[str] = AVERAGED,
    summed: Sequence[str] = SUMMED,
    maxed: Sequence[str] = MAXED,
    key: str = "station_id",
    ts: str = "measure_at",
    carried: Sequence[str] = ("station_name", "station_type"),
) -> DataFrame:
    """M-7 to M-10 straight from measurements that are unique per (key, ts).

    A bucket without a row on its boundary is left out (Q-8).
    """
    word = GRAIN_WORD[grain]
    start = truncate(grain, ts)
    on_boundary = F.col(ts) == start
    one_before = F.expr(f"INTERVAL {GRAIN_INTERVAL[grain]}")
    values = sorted({*averaged, *summed, *maxed})
    opened = F.col("__bucket") == F.col("__at")
    rows = measurements.select(
        key,
        *[F.when(on_boundary, F.col(c)).alias(c) for c in carried],
        *[F.col(v).cast("double").alias(v) for v in values],
        F.col(ts).cast("timestamp_ntz").alias("__at"),
        F.explode(F.when(on_boundary, F.array(start, start - one_before)).otherwise(F.array(start))).alias("__bucket"),
    )
    buckets = rows.groupBy(key, "__bucket").agg(
        F.max(opened).alias("__opened"),
        *[F.max(F.when(opened, F.col(c))).alias(c) for c in carried],
        *[F.sum(c).alias(f"__sum_{c}") for c in sorted({*averaged, *summed})],
        *[F.count(c).alias(f"__count_{c}") for c in averaged],
        *[F.max(c).alias(f"__max_{c}") for c in maxed],
    )
    kept = buckets.where("__opened")
    means = kept.select(
        "*", *[F.when(F.col(f"__count_{c}") > 0, F.col(f"__sum_{c}") / F.col(f"__count_{c}")).alias(f"__avg_{c}") for c in averaged]
    )
    return means.select(
        key,
        *carried,
        F.col("__bucket").alias(ts),
        *[round2(f"__avg_{c}").alias(mart_name(f"{c}_{word}_average", grain)) for c in averaged],
        *[round2(f"__sum_{c}").alias(mart_name(f"{c}_{word}_sum", grain)) for c in summed],
        *[round2(f"__max_{c}").alias(mart_name(f"{c}_{word}_max", grain)) for c in maxed],
    )
