"""Forward-looking range-frame aggregates as ``Column`` builders (R-38 to R-41).

``[t, t + interval]`` is closed at both ends.  These are the direct window form: every row re-reads
its frame, and one partition lands in one task.  ``operators.frames`` has the form for big data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import ROUND2


def _over(call: str, ts: str, interval: str, partition_by: Sequence[str] | None) -> Column:
    parts = "PARTITION BY " + ", ".join(f"`{p}`" for p in partition_by) if partition_by else ""
    frame = f"RANGE BETWEEN CURRENT ROW AND INTERVAL {interval} FOLLOWING"
    return F.expr(ROUND2.format(x=f"CAST({call} OVER ({parts} ORDER BY `{ts}` {frame}) AS DOUBLE)"))


def average_over(column: str, ts: str, interval: str, partition_by: Sequence[str] = ("station_id",)) -> Column:
    """R-38."""
    return _over(f"avg(`{column}`)", ts, interval, partition_by)


def sum_over(column: str, ts: str, interval: str, partition_by: Sequence[str] = ("station_id",)) -> Column:
    """R-39."""
    return _over(f"sum(`{column}`)", ts, interval, partition_by)


def max_over(column: str, ts: str, interval: str, partition_by: Sequence[str] = ("station_id",)) -> Column:
    """R-40."""
    return _over(f"max(`{column}`)", ts, interval, partition_by)


def mode_over(column: str, ts: str, interval: str, partition_by: Sequence[str] | None = None) -> Column:
    """R-41: no partition by default (Q-15); the smallest value wins a tie."""
    return _over(f"mode(`{column}`, true)", ts, interval, partition_by)
