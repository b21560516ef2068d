"""Incremental materialisation (R-22, R-23, R-31, R-33, R-57 to R-61)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.sources import tables


def high_water_mark(target: DataFrame, ts: str, floor: str | None = None) -> Column:
    """Greatest ``ts`` in the target as a scalar subquery (R-33), or ``floor`` if there is none."""
    mark = target.agg(F.max(ts).alias("mark")).scalar()
    return mark if floor is None else F.coalesce(mark, F.lit(floor).cast("timestamp_ntz"))


def past_mark(df: DataFrame, target: DataFrame | None, ts: str, floor: str | None = None) -> DataFrame:
    """Rows strictly later than the mark; all rows if there is no target yet.

    Without ``floor`` an existing but empty target lets nothing through (Q-2).  The mark is one for all
    keys, so rows that arrive late are dropped (Q-3).  The comparison reaches the parquet scan.
    """
    return df if target is None else df.where(F.col(ts) > high_water_mark(target, ts, floor))


def append_past_mark(
    df: DataFrame,
    path: str,
    ts: str,
    floor: str | None = None,
    derive: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """R-57, R-59: append what lies past the mark.

    ``derive`` is applied to the new rows only.  For forward-looking columns that equals filtering
    afterwards, and saves recomputing the past; it also means that frames cut short by the end of the
    data are never completed until a full refresh (Q-1).
    """
    new = past_mark(df, tables.read(df.sparkSession, path), ts, floor)
    tables.append(derive(new) if derive else new, path)


def append_all(df: DataFrame, path: str) -> None:
    """R-61: every run adds the whole result again."""
    tables.append(df, path)


def full_refresh(df: DataFrame, path: str) -> None:
    """R-60."""
    tables.overwrite(df, path)


def delete_insert(new: DataFrame, path: str, key: str, buckets: int | None = None) -> None:
    """R-58: the rows of the keys in ``new`` give way to it; buckets without such a key are not written.  NULL keys replace nothing."""
    tables.replace_keys(new, path, key, buckets)
