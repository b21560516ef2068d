"""The bank of forward aggregates per measurement (R-18, R-43)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gaugeworks.functions.frames import average_over, max_over, sum_over
from gaugeworks.operators.frames import Frame, forward_frames
from gaugeworks.operators.marts import AVERAGED, GRAIN_INTERVAL, GRAIN_WORD, MAXED, SUMMED


def bank_frames(
    averaged: Sequence[str] = AVERAGED,
    summed: Sequence[str] = SUMMED,
    maxed: Sequence[str] = MAXED,
    grains: Sequence[str] = tuple(GRAIN_WORD),
) -> list[Frame]:
    """By default 4 grains x (5 averages + 2 sums + 6 maxima) = 52 frames."""
    by_func = (("avg", "average", averaged), ("sum", "sum", summed), ("max", "max", maxed))
    return [
        Frame(f"{c}_{GRAIN_WORD[g]}_{word}", func, c, GRAIN_INTERVAL[g])
        for g in grains
        for func, word, columns in by_func
        for c in columns
    ]


def window_bank(
    measurements: DataFrame,
    frames: Sequence[Frame] | None = None,
    ts: str = "measure_at",
    partition_by: Sequence[str] = ("station_id",),
    base: str | None = None,
) -> DataFrame:
    """Every column of ``measurements`` plus one per frame."""
    return forward_frames(measurements, frames or bank_frames(), ts, partition_by, base)


def sliding_window_bank(
    measurements: DataFrame,
    frames: Sequence[Frame] | None = None,
    ts: str = "measure_at",
    partition_by: Sequence[str] = ("station_id",),
) -> DataFrame:
    """The same by plain windows: one shuffle and one sort, but work per row grows with the frame and
    a key stays in one task.  For short histories without hot keys.

    A sliding frame cannot shrink at its far end, so after 31 January, say, month frames that should
    end earlier than the one before them come out too long; ``window_bank`` is exact there.
    """
    call = {"avg": average_over, "sum": sum_over, "max": max_over}
    columns = [call[f.func](f.column, ts, f.interval, partition_by).alias(f.name) for f in frames or bank_frames()]
    return measurements.select("*", *columns)
