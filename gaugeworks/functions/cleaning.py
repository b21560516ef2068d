"""Scalar cleaning rules as plain ``Column`` builders (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that marks a missing reading, and the station classes by id prefix.
MISSING_TAG = "-99"
STATION_CLASS_BY_PREFIX = {"46": "有人站", "C0": "自動站", "C1": "自動站"}
STATION_CLASS_OTHERWISE = "農業雨量站"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def negative_to_null(c: Column | str) -> Column:
    """R-44: readings below zero are missing codes."""
    c = _col(c)
    return F.when(c < 0, None).otherwise(c)


def na_tag_to_null(c: Column | str, tag: str = MISSING_TAG) -> Column:
    """R-45: the exact missing tag becomes NULL; ``-99.0`` does not match."""
    return F.nullif(_col(c), F.lit(tag))


def empty_to_null(c: Column | str) -> Column:
    """R-46."""
    return F.nullif(_col(c), F.lit(""))


def empty_to_null_date(c: Column | str) -> Column:
    """R-47: empty text is NULL, anything else must be a date."""
    return empty_to_null(c).cast("date")


def classify_station(station_id: Column | str) -> Column:
    """R-48: station class from the id prefix; a NULL id takes the last class."""
    c = _col(station_id)
    branch = F
    for prefix, name in STATION_CLASS_BY_PREFIX.items():
        branch = branch.when(c.startswith(prefix), F.lit(name))
    return branch.otherwise(F.lit(STATION_CLASS_OTHERWISE))


def quote_trim(c: Column | str) -> Column:
    """R-49: strip double quotes from both ends."""
    return F.btrim(_col(c), F.lit('"'))


def parse_timestamp(c: Column | str) -> Column:
    """R-50: ISO-8601 text to a zone-less timestamp; an offset is dropped, the wall clock kept."""
    return _col(c).cast("timestamp_ntz")


def first_present(*cols: Column | str) -> Column:
    """R-51, R-52: the first non-NULL of the columns, in priority order."""
    return F.coalesce(*[_col(c) for c in cols])


def truncate_sql(grain: str, c: str) -> str:
    """R-54 as SQL text: start of the second, minute, hour, day, week (Monday), month or year.

    ``date_trunc`` goes through the session zone and returns a zoned value; this form does neither.
    """
    day = f"CAST({c} AS DATE)"
    if grain == "day":
        return f"CAST({day} AS TIMESTAMP_NTZ)"
    if grain in ("week", "month", "year"):
        return f"CAST(trunc({day}, '{grain}') AS TIMESTAMP_NTZ)"
    clock = {"hour": f"hour({c})", "minute": f"hour({c}), minute({c})", "second": f"hour({c}), minute({c}), second({c})"}
    return f"CAST({day} AS TIMESTAMP_NTZ) + make_dt_interval(0, {clock[grain]})"


def truncate(grain: str, column: str) -> Column:
    """R-54 for a named column; zone-less."""
    return F.expr(truncate_sql(grain, f"`{column}`"))


#: R-53 for an operand that is named twice: two decimals, half away from zero, settled on the sixth decimal
#: first.  What no decimal can hold (NaN, infinities, from 1e32 up) stays as it is.
ROUND2 = "coalesce(CAST(round(TRY_CAST({x} AS DECIMAL(38, 6)), 2) AS DOUBLE), {x})"
#: The same, without decimals for values under 1e7 that lie over 1e-6 from where two roundings meet: neither the
#: sixth decimal nor the product's last bit can matter there, and n / 100 is the double nearest to that decimal.
ROUND2_FAST = (
    "CASE WHEN abs({x} * 100D) < 1e9D AND abs({x} * 100D - floor({x} * 100D) - 0.5D) > 1e-4D "
    "THEN floor({x} * 100D + 0.5D) / 100D ELSE " + ROUND2 + " END"
)


def round2(column: str) -> Column:
    """R-53 for a named column."""
    return F.expr(ROUND2_FAST.format(x=f"CAST(`{column}` AS DOUBLE)"))
