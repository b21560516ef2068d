"""Frame lengths and the time slices that divide them."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from functools import lru_cache

# Seconds per unit, and months per calendar unit.
SLICE_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
UNIT_SECONDS = {**SLICE_SECONDS, "week": 604800}
UNIT_MONTHS = {"month": 1, "year": 12}


@dataclass(frozen=True)
class Interval:
    """A frame length: a fixed number of seconds, or a number of calendar months."""

    seconds: int
    months: int

    @classmethod
    def parse(cls, text: str) -> Interval:
        count, unit = text.split()
        unit = unit.lower().removesuffix("s")
        if unit in UNIT_MONTHS:
            parsed = cls(0, int(count) * UNIT_MONTHS[unit])
        elif unit in UNIT_SECONDS:
            parsed = cls(int(count) * UNIT_SECONDS[unit], 0)
        else:
            raise ValueError(f"unknown unit in interval {text!r}")
        if parsed.seconds + parsed.months <= 0:
            raise ValueError(f"interval {text!r} is not positive")
        return parsed

    @property
    def sql(self) -> str:
        return f"INTERVAL '{self.months}' MONTH" if self.months else f"INTERVAL '{self.seconds}' SECOND"

    def divided_by(self, level: str) -> bool:
        """Months start at midnight, so every slice level divides them."""
        return bool(self.months) or self.seconds % SLICE_SECONDS[level] == 0

    def slices(self, level: str) -> tuple[int, int]:
        """Least and greatest number of slices the interval spans."""
        width = SLICE_SECONDS[level]
        if self.months:
            shortest, longest = _days_in_months(self.months)
            return shortest * 86400 // width, longest * 86400 // width
        return self.seconds // width, self.seconds // width

    def slices_ending_at(self, start: str) -> str:
        """SQL for the array of all slice starts ``s`` with ``s + interval = start``.

        None to four of them for months: 29, 30 and 31 January all reach the end of February, and
        nothing reaches 30 March.
        """
        if not self.months:
            return f"array({start} - {self.sql})"
        candidates = f"transform(sequence(0, 3), k -> {start} - {self.sql} + make_dt_interval(k))"
        return f"filter({candidates}, s -> s + {self.sql} = {start})"


@lru_cache
def _days_in_months(months: int) -> tuple[int, int]:
    """Shortest and longest distance in days covered by adding ``months`` to a date."""
    spans = set()
    for first in range(2000 * 12, 2400 * 12):  # one full cycle of the calendar
        year, month = divmod(first, 12)
        to_year, to_month = divmod(first + months, 12)
        length = calendar.monthrange(year, month + 1)[1]
        to_length = calendar.monthrange(to_year, to_month + 1)[1]
        between = _ordinal(to_year, to_month + 1) - _ordinal(year, month + 1)
        spans.update(between + min(d, to_length) - d for d in (1, *range(28, length + 1)))
    return min(spans), max(spans)


def _ordinal(year: int, month: int) -> int:
    before = year - 1
    leap_days = before // 4 - before // 100 + before // 400
    return before * 365 + leap_days + sum(calendar.monthrange(year, m)[1] for m in range(1, month))


def slice_number_sql(level: str, start: str) -> str:
    """Slices since the epoch, as a bigint; exact and free of the session time zone."""
    days = f"CAST(unix_date(CAST({start} AS DATE)) AS BIGINT)"
    if level == "day":
        return days
    seconds = f"({days} * 86400 + hour({start}) * 3600 + minute({start}) * 60 + second({start}))"
    return f"({seconds} div {SLICE_SECONDS[level]})"
