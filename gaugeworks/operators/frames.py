"""Forward range frames at scale: ``[t, t + interval]`` per key, closed at both ends (R-38 to R-43).

A sliding window re-reads its whole frame for every row and keeps a key in one task.  Here time is
cut into slices that divide the interval, so a frame is

    rows from ``t`` on in its own slice                              (running aggregate, backwards)
  + whole slices strictly between                                   (pre-aggregated, far fewer rows)
  + rows up to ``t + interval`` in the slice that instant falls in  (running aggregate, forwards)

``t`` and ``t + interval`` lie equally deep in their slices.  So each row is also sent, under a role
number, to the slice whose frames end in its own, and a single shuffle on (key, slice) yields both
running aggregates.  Work per row is constant, whatever the frame length, and a key that
holds a third of the data is spread over all of its slices.  The slices in between are treated in the
same way one level up, then by a short sliding window over days.

Expressions are SQL text: a bank has hundreds, and each is then a single call to the JVM.  Window
functions take bare columns only, since Spark puts any other argument into the shuffled and sorted rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.cleaning import round2, truncate_sql
from gaugeworks.operators.intervals import SLICE_SECONDS, Interval, slice_number_sql

OWN = 0  # role of a row in its own slice; role j > 0 closes the frames of interval j
LEVELS = ("second", "minute", "hour", "day")
WIDEST = "day"
NULL_STAND_IN = {"string": "''", "boolean": "false", "date": "'1970-01-01'", "timestamp": "'1970-01-01'", "timestamp_ntz": "'1970-01-01'"}


@dataclass(frozen=True)
class Frame:
    """One output column: ``func`` (avg, sum or max) of ``column`` over ``interval``."""

    name: str
    func: str
    column: str
    interval: str


# An average needs a sum and a count; parts of a frame combine by adding, or by taking the greatest.
PARTIALS = {"avg": ("sum", "count"), "sum": ("sum",), "max": ("max",)}


@dataclass(frozen=True, order=True)
class Partial:
    kind: str
    column: str

    @property
    def state(self) -> str:
        return f"__{self.kind}_{self.column}"

    def named(self, part: str, role: int) -> str:
        return f"__{part}{role}_{self.kind}_{self.column}"

    @property
    def of_rows(self) -> str:
        return f"{self.kind}(`{self.column}`)"

    @property
    def merge(self) -> str:
        return "max" if self.kind == "max" else "sum"

    @property
    def of_states(self) -> str:
        return f"{self.merge}(`{self.state}`)"

    def combined(self, parts: Sequence[str], name: str) -> str:
        listed = ", ".join(f"`{p}`" for p in parts)
        if len(parts) == 1:
            return f"{listed} AS `{name}`"
        if self.kind == "max":
            return f"greatest({listed}) AS `{name}`"
        total = " + ".join(f"coalesce(`{p}`, 0)" for p in parts)
        return f"CASE WHEN coalesce({listed}) IS NOT NULL THEN {total} END AS `{name}`"


def forward_frames(
    df: DataFrame,
    frames: Sequence[Frame],
    ts: str = "measure_at",
    partition_by: Sequence[str] = ("station_id",),
    base: str | None = None,
    rounded: bool = True,
) -> DataFrame:
    """``df`` with one column per frame.

    ``base`` is the widest slice allowed: day (if left out), hour, minute or second; each interval uses the widest
    allowed slice that divides it, and a task sorts the rows of a key in a slice.  It is the caller's
    choice and not taken from the data.  A zoned ``ts`` counts by its wall clock in the session's zone.
    Nothing runs before an action.
    """
    allowed = LEVELS[: LEVELS.index(base or WIDEST) + 1]
    columns, types = df.columns, dict(df.dtypes)
    other = {f.column for f in frames if types[f.column] != "double"}
    framed = df.selectExpr("*", *[f"CAST(`{c}` AS DOUBLE) AS `__double_{c}`" for c in sorted(other)])
    by_slice: dict[str, list[Frame]] = {}
    for f in frames:
        interval = Interval.parse(f.interval)
        if f.column in other:
            f = replace(f, column=f"__double_{f.column}")
        by_slice.setdefault(next(u for u in reversed(allowed) if interval.divided_by(u)), []).append(f)
    given = framed
    for slice_, some in by_slice.items():
        framed = _one_pass(framed, given, some, ts, partition_by, slice_)
    values = [round2(f.name).alias(f.name) if rounded else F.col(f"`{f.name}`") for f in frames]
    return framed.select(*[f"`{c}`" for c in columns], *values)


def _one_pass(df: DataFrame, given: DataFrame, frames: Sequence[Frame], ts: str, partition_by: Sequence[str], base: str) -> DataFrame:
    """``df`` with the frames of one slice width.  ``given`` has the same rows before any pass: whole slices are summed from it."""
    roles = {text: j for j, text in enumerate(dict.fromkeys(f.interval for f in frames), start=1)}
    by_role = {
        j: (Interval.parse(text), sorted({Partial(k, f.column) for f in frames if f.interval == text for k in PARTIALS[f.func]}))
        for text, j in roles.items()
    }
    keys, key_columns = null_safe_keys(df, partition_by)
    values = sorted({f.column for f in frames})
    # The row itself travels as one struct: sorts and window buffers then copy it as a block.
    packed = f"named_struct({', '.join(f"'{c}', `{c}`" for c in df.columns)}) AS __row"
    start = f"{truncate_sql(base, f'`{ts}`')} AS __slice"
    placed = [*[f"`{v}`" for v in values], *key_columns, f"CAST(`{ts}` AS TIMESTAMP_NTZ) AS __at", start]
    rows = df.selectExpr(packed, *placed)
    between = _between(given.selectExpr(*placed), keys, LEVELS[LEVELS.index(base) :], by_role)
    parts = _within_slices(rows, values, keys, by_role)
    if between is not None:
        parts = parts.join(between, ["__slice", *keys], "left")
    available = set(parts.columns)

    def total(p: Partial, j: int) -> str:
        names = [p.named("head", OWN), p.named("middle", j), p.named("tail", j)]
        return p.combined([n for n in names if n in available], p.named("all", j))

    def value(f: Frame) -> str:
        j = roles[f.interval]
        if f.func != "avg":
            return f"`{Partial(f.func, f.column).named('all', j)}` AS `{f.name}`"
        s, n = (Partial(kind, f.column).named("all", j) for kind in PARTIALS["avg"])
        return f"CASE WHEN `{n}` > 0 THEN `{s}` / `{n}` END AS `{f.name}`"

    totals = [total(p, j) for j, (_, partials) in by_role.items() for p in partials]
    unpacked = [f"__row.`{c}` AS `{c}`" for c in df.columns]
    return parts.selectExpr("__row", *totals).selectExpr(*unpacked, *[value(f) for f in frames])


def null_safe_keys(df: DataFrame, partition_by: Sequence[str]) -> tuple[list[str], list[str]]:
    """Key columns that compare equal for NULL keys too, so that windows and joins share a shuffle."""
    types, columns = dict(df.dtypes), []
    for i, name in enumerate(partition_by):
        stand_in = f"CAST({NULL_STAND_IN.get(types[name], '0')} AS {types[name]})"
        columns += [f"coalesce(`{name}`, {stand_in}) AS __key{i}", f"`{name}` IS NULL AS __null{i}"]
    return [f"__{kind}{i}" for i in range(len(partition_by)) for kind in ("key", "null")], columns


def _with_roles(start: str, by_role: dict) -> str:
    """Array of the slices a row takes part in, with its role there; a NULL start has no other role."""
    own = f"array(named_struct('role', {OWN}, 'slice', {start}))"
    closing = [
        f"transform({interval.slices_ending_at(start)}, s -> named_struct('role', {j}, 'slice', s))"
        for j, (interval, _) in by_role.items()
    ]
    return f"explode(CASE WHEN {start} IS NULL THEN {own} ELSE concat({', '.join([own, *closing])}) END) AS __in"


def _over(parts: Sequence[str], order: str, frame: str) -> str:
    return f"OVER ({f'PARTITION BY {", ".join(parts)}' if parts else ''} ORDER BY {order} {frame})"


def _all_partials(by_role: dict) -> list[Partial]:
    return sorted({p for _, partials in by_role.values() for p in partials})


UP_TO_PEERS = "RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
STRICTLY_BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _closing_states(placed: DataFrame, parts: list[str], by_role: dict, running: dict, order: str, frame: str) -> DataFrame:
    """Own rows only, each with how far the running aggregates of every other role have got at its depth.

    Each role has its own copy of the values, empty in the rows of other roles, so one sort and one window do.
    ``running`` has the function and the column of each partial.
    """
    columns = {j: sorted({running[p][1] for p in wanted}) for j, (_, wanted) in by_role.items()}
    of_role = [f"CASE WHEN __role = {j} THEN `{c}` END AS `__of{j}{c}`" for j, some in columns.items() for c in some]
    reached = [
        f"{running[p][0]}(`__of{j}{running[p][1]}`) {_over(parts, order, frame)} AS `{p.named('closing', j)}`"
        for j, (_, wanted) in by_role.items()
        for p in wanted
    ]
    rest = [f"`{c}`" for c in placed.columns]
    return placed.repartition(*parts).selectExpr(*rest, *of_role).selectExpr(*rest, *reached).where(f"__role = {OWN}")


def _within_slices(rows: DataFrame, values: Sequence[str], keys: list[str], by_role: dict) -> DataFrame:
    """Running aggregates inside the slice: ``head`` from ``t`` on, ``tail`` up to ``t + interval``."""
    partials = _all_partials(by_role)
    placed = rows.selectExpr("*", _with_roles("__slice", by_role)).selectExpr(
        f"CASE WHEN __in.role = {OWN} THEN __row END AS __row",
        *[f"`{v}`" for v in values],
        *keys,
        "__at - __slice AS __depth",
        "__in.role AS __role",
        "__in.slice AS __slice",
    )
    parts = ["__slice", *keys]  # a slice is told apart by the eight bytes that sorts look at first, ids often are not
    own_rows = _closing_states(placed, parts, by_role, {p: (p.kind, p.column) for p in partials}, "__depth", UP_TO_PEERS)
    tails = [f"`{p.named('closing', j)}` AS `{p.named('tail', j)}`" for j, (_, wanted) in by_role.items() for p in wanted]
    heads = [f"{p.of_rows} {_over(parts, '__depth DESC', UP_TO_PEERS)} AS `{p.named('head', OWN)}`" for p in partials]
    headed = own_rows.selectExpr("*", *heads)
    return headed.selectExpr("__row", *parts, *[f"`{p.named('head', OWN)}`" for p in partials], *tails)


def _between(rows: DataFrame, keys: list[str], levels: Sequence[str], by_role: dict) -> DataFrame | None:
    """Aggregates of the whole slices strictly between both ends of a frame, per (key, slice)."""
    spanning = {j: v for j, v in by_role.items() if v[0].slices(levels[0])[1] > 1}
    if not spanning:
        return None
    states = [F.expr(p.of_rows).alias(p.state) for p in _all_partials(spanning)]
    slices = rows.where("__slice IS NOT NULL").groupBy(*keys, "__slice").agg(*states)
    return _between_slices(slices, keys, levels, spanning)


def _between_slices(slices: DataFrame, keys: list[str], levels: Sequence[str], by_role: dict) -> DataFrame:
    level, coarser = levels[0], levels[1:]
    upwards = {j: v for j, v in by_role.items() if coarser and v[0].divided_by(coarser[0])}
    here = {j: v for j, v in by_role.items() if j not in upwards}
    result, names = slices, [*keys, "__slice"]
    if upwards:
        result = _within_parents(slices, keys, coarser, upwards)
        names += [p.named("middle", j) for j, (_, partials) in upwards.items() for p in partials]
    if here:
        result, added = _sliding(result, keys, level, here)
        names += added
    return result.select(*names)


def _sliding(slices: DataFrame, keys: list[str], level: str, by_role: dict) -> tuple[DataFrame, list[str]]:
    """Top of the slices: a sliding window over at most a month of pre-aggregated days, say.

    A month has 28 to 31 days: 27 of them always lie between, the others are looked at one by one.
    """
    numbered = slices.selectExpr("*", f"{slice_number_sql(level, '__slice')} AS __number")
    columns, combined, added = [], [], []
    for j, (interval, partials) in by_role.items():
        shortest, longest = interval.slices(level)
        for p in partials:
            parts = []
            if shortest > 1:
                parts.append(p.named("sure", j))
                frame = f"RANGE BETWEEN 1 FOLLOWING AND {shortest - 1} FOLLOWING"
                columns.append(f"{p.of_states} {_over(keys, '__number', frame)} AS `{parts[-1]}`")
            for k in range(shortest, longest):
                parts.append(p.named(f"maybe{k}_", j))
                inside = f"__slice + make_dt_interval({k}) < __slice + {interval.sql}"
                one = f"{p.of_states} {_over(keys, '__number', f'RANGE BETWEEN {k} FOLLOWING AND {k} FOLLOWING')}"
                columns.append(f"CASE WHEN {inside} THEN {one} END AS `{parts[-1]}`")
            if parts:
                added.append(p.named("middle", j))
                combined.append(p.combined(parts, added[-1]))
    kept = [f"`{c}`" for c in slices.columns]
    return numbered.selectExpr("*", *columns).selectExpr(*kept, *combined), added


def _within_parents(slices: DataFrame, keys: list[str], levels: Sequence[str], by_role: dict) -> DataFrame:
    """Slices after the own one in its parent, slices before the closing one in its parent, and the
    parents strictly between."""
    partials = _all_partials(by_role)
    spanning = {j: v for j, v in by_role.items() if v[0].slices(levels[0])[1] > 1}
    owned = slices.selectExpr("*", f"{truncate_sql(levels[0], '__slice')} AS __parent")
    placed = owned.selectExpr("*", _with_roles("__parent", by_role)).selectExpr(
        *[f"`{c}`" for c in slices.columns],
        "__slice - __parent AS __depth",
        "__in.role AS __role",
        "__in.slice AS __parent",
    )
    parts = ["__parent", *keys]
    # The own slice sorts before the slices that close a frame at the same depth, so they stay out.
    own = _closing_states(placed, parts, by_role, {p: (p.merge, p.state) for p in partials}, "__depth, __role", STRICTLY_BEFORE)
    after = _over(parts, "__depth DESC", STRICTLY_BEFORE)
    own = own.selectExpr("*", *[f"{p.of_states} {after} AS `{p.named('after', OWN)}`" for p in partials])
    tails = [f"`{p.named('closing', j)}` AS `{p.named('before', j)}`" for j, (_, wanted) in by_role.items() for p in wanted]
    own = own.selectExpr("*", *tails)
    if spanning:
        states = [F.expr(p.of_states).alias(p.state) for p in partials]
        rolled = owned.groupBy(*keys, F.col("__parent").alias("__slice")).agg(*states)
        parents = _between_slices(rolled, keys, levels, spanning).withColumnsRenamed(
            {p.named("middle", j): p.named("parents", j) for j, (_, wanted) in spanning.items() for p in wanted}
        )
        own = own.join(parents.withColumnRenamed("__slice", "__parent"), parts, "left")
    available = set(own.columns)
    combined = []
    for j, (_, wanted) in by_role.items():
        for p in wanted:
            names = [p.named("after", OWN), p.named("parents", j), p.named("before", j)]
            combined.append(p.combined([n for n in names if n in available], p.named("middle", j)))
    return own.selectExpr(*[f"`{c}`" for c in slices.columns], *combined)
