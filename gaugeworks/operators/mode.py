"""Forward range MODE at scale (R-41): the most frequent value in ``[t, t + interval]``, smallest on a tie.

Counts per value add up, so time is cut into slices as in ``operators.frames``.  A slice starts from one
histogram, that of itself and the slices before the one its frames end in.  From there on rows enter and
leave the frame in time order.  Between two such events the count of a value stands still, which makes a run
of instants with a count and a value; the mode of an instant is the best run that covers it.  Runs are laid on
all instants of a stretch at once: a run of any length is two runs whose length is a power of two, and the
best of each such length is handed down to the next smaller one.
Equal rows are pre-aggregated first, so copies of a value never meet.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import round2
from gaugeworks.operators.frames import null_safe_keys
from gaugeworks.operators.intervals import Interval, slice_number_sql

NO_TIME = -(2**62)  # stands for a NULL instant


# Order of what happens at one instant: a frame holds both its first and its last instant.
HISTOGRAM, ENTER, ASK, LEAVE = range(4)
STRETCH = 1 << 17  # rows answered at once


def best_cover(low: np.ndarray, high: np.ndarray, rank: np.ndarray, places: int) -> np.ndarray:
    """For each place the greatest rank of the runs [low, high) that cover it, -1 where there is none."""
    best = np.full(places, -1, "i8")
    size = np.frexp(high - low)[1] - 1  # of the power of two that fits
    for level in range(int(size.max(initial=0)), -1, -1):
        here, half = size == level, 1 << level
        np.maximum.at(best, low[here], rank[here])
        np.maximum.at(best, high[here] - half, rank[here])
        if level:
            lower = best.copy()
            np.maximum(lower[half // 2 :], best[: places - half // 2], out=lower[half // 2 :])
            best = lower
    return best


def _modes(slice_: np.ndarray, step: np.ndarray, value: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, pd.DataFrame]:
    """(modes of the ASK rows, counts left in the last slice) of sorted rows; a mode is NaN for NaN and masked for none."""
    asked = step == ASK
    before = np.cumsum(asked) - asked  # instants that come earlier
    values, code = np.unique(value[~asked], return_inverse=True)  # one NaN, after all numbers
    key = slice_[~asked] * max(1, len(values)) + code
    order = np.argsort(key, kind="stable")
    key, at = key[order], before[~asked][order]
    change = np.where(step[~asked] == LEAVE, -n[~asked], n[~asked])[order]
    last = np.append(key[1:] != key[:-1], True) if len(key) else np.zeros(0, bool)
    total = np.cumsum(change)
    ends = np.flatnonzero(last)
    total -= np.repeat(np.append(0, total[ends[:-1]]) if len(ends) else ends, np.diff(np.append(-1, ends)))
    slice_end = np.searchsorted(slice_, np.arange(slice_[-1] + 1), side="right")
    until = np.append(before, asked.sum())[slice_end]  # instants up to the end of each slice
    stop = np.where(last, until[key // max(1, len(values))], np.append(at[1:], 0))
    run = (total > 0) & (at < stop)
    rank = total[run] * len(values) + (len(values) - 1 - key[run] % max(1, len(values)))
    best = best_cover(at[run], stop[run], rank, int(asked.sum()))
    found = np.ma.masked_array(values[len(values) - 1 - best % len(values)] if len(values) else np.zeros(len(best)), best < 0)
    left = last & (key // max(1, len(values)) == slice_[-1]) & (total > 0)
    return found, pd.DataFrame({"value": values[key[left] % max(1, len(values))], "n": total[left]})


def _sweep(group: list[str]):
    """Function over sorted batches that answers each ASK with the mode at that instant.

    Rows are taken STRETCH at a time; what a slice counts at the end of one begins the next.
    """

    def answers(batches):
        held, rows, carried = [], 0, None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                rows += len(batch)
            if not rows or (batch is not None and rows < STRETCH):
                continue
            stretch = pd.concat(held, ignore_index=True)
            held, rows = [], 0
            if carried is not None and len(carried) and (stretch.loc[0, group] == carried.loc[0, group]).all():
                stretch = pd.concat([carried, stretch], ignore_index=True)
            keys = stretch[group]
            earlier = keys.shift()
            other = ((keys != earlier) & ~(keys.isna() & earlier.isna())).any(axis=1).to_numpy()
            other[0] = True
            number = other.cumsum() - 1
            step = stretch["step"].to_numpy()
            modes, left = _modes(number, step, stretch["value"].to_numpy("f8"), stretch["n"].to_numpy("i8"))
            carried = left.assign(step=HISTOGRAM, depth=-1, **{g: keys[g].iloc[-1] for g in group})[stretch.columns]
            out = stretch.loc[step == ASK, [*group, "depth"]]
            none = np.ma.getmaskarray(modes)
            nans = ~none & np.isnan(modes.data)
            yield out.assign(mode=pd.array(np.where(none, np.nan, modes.data), dtype="float64"), nan=nans)

    return answers


def forward_mode(
    df: DataFrame,
    column: str,
    ts: str,
    interval: str,
    name: str,
    partition_by: Sequence[str] = (),
    slices: int = 6,
) -> DataFrame:
    """``df`` with the mode of a numeric column as ``name``; NULLs do not count.

    A frame spans ``slices`` slices, months as many as they have days.  More slices mean more tasks and
    more copies of the histograms.
    """
    span = Interval.parse(interval)
    if not span.months and (span.seconds % slices or 86400 % (span.seconds // slices)):
        slices = span.slices("hour")[0] if span.divided_by("hour") else span.seconds
    width = 86400 if span.months else span.seconds // slices
    at = f"CAST(`{ts}` AS TIMESTAMP_NTZ)"
    second = slice_number_sql("second", at)
    start = f"CAST(CAST({at} AS DATE) AS TIMESTAMP_NTZ)"
    keys, key_columns = null_safe_keys(df, partition_by)
    rows = df.selectExpr(
        "*",
        *key_columns,
        f"CAST(`{column}` AS DOUBLE) AS __value",
        f"{start} AS __day",
        f"coalesce(floor({second} / {width}), {NO_TIME}) AS __slice",
        f"coalesce(pmod({second}, {width}) * 1000000 + CAST(extract(SECOND FROM {at}) * 1000000 AS BIGINT) % 1000000, 0) AS __depth",
    )
    where = [*keys, "__slice"]
    starts = rows.select(*where, "__depth").distinct()
    instants = rows.where("__value IS NOT NULL").groupBy(*where, "__day", "__depth", "__value").agg(F.count("*").alias("n"))
    slice_counts = instants.groupBy(*where, "__day", "__value").agg(F.sum("n").alias("n"))
    dated = "__day IS NOT NULL"
    if span.months:
        days = f"transform(sequence(0, {span.slices('day')[1] - 1}), k -> __day - make_dt_interval(k))"
        number = slice_number_sql("day", "s")
        frames_over = f"transform(filter({days}, s -> s + {span.sql} > __day), s -> {number})"
        frames_ending = f"transform({span.slices_ending_at('__day')}, s -> {number})"
    else:
        frames_over = f"sequence(__slice - {slices - 1}, __slice)"
        frames_ending = f"array(__slice - {slices})"
    histogram = (
        slice_counts.withColumn("__slice", F.expr(f"explode(CASE WHEN {dated} THEN {frames_over} ELSE array(__slice) END)"))
        .groupBy(*where, "__value")
        .agg(F.sum("n").alias("n"))
        .selectExpr(*where, "-1L AS depth", f"{HISTOGRAM} AS step", "__value AS value", "n")
    )
    entering = (
        instants.where(dated)
        .withColumn("__slice", F.expr(f"explode({frames_ending})"))
        .selectExpr(*where, "__depth AS depth", f"{ENTER} AS step", "__value AS value", "n")
    )
    asking = starts.selectExpr(*where, "__depth AS depth", f"{ASK} AS step", "CAST(NULL AS DOUBLE) AS value", "0L AS n")
    leaving = instants.selectExpr(*where, "__depth AS depth", f"{LEAVE} AS step", "__value AS value", "n")
    together = histogram.unionByName(entering).unionByName(asking).unionByName(leaving)
    key_types = dict(rows.dtypes)
    schema = ", ".join([*[f"{k} {key_types[k]}" for k in keys], "__slice bigint", "depth bigint", "mode double", "nan boolean"])
    found = (
        together.repartition(*where).sortWithinPartitions(*where, "depth", "step").mapInPandas(_sweep(where), schema)
    )
    found = found.withColumn("mode", F.when(F.col("nan"), F.lit(float("nan"))).otherwise(F.col("mode"))).drop("nan")
    joined = rows.join(found.withColumnRenamed("depth", "__depth"), [*where, "__depth"], "left")
    return joined.select(*[f"`{c}`" for c in df.columns], round2("mode").alias(name))
