"""Time functions with warehouse semantics on TIMESTAMP_NTZ columns.

Every function that the reference evaluates against the wall clock takes an
``as_of`` argument instead; ``None`` means now. Tests pass the newest order
time so results are reproducible.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNITS = {"minute": "MINUTE", "hour": "HOUR", "day": "DAY"}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def now_ntz() -> Column:
    return F.current_timestamp().cast("timestamp_ntz")


def resolve_as_of(as_of: Column | dt.datetime | str | None) -> Column:
    """Column for the reference instant: now, a literal, or an expression."""
    if as_of is None:
        return now_ntz()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(as_of).cast("timestamp_ntz")


def interval(amount: int, unit: str) -> Column:
    """A day-time interval literal, e.g. ``interval(5, "minute")``."""
    if unit not in _UNITS:
        raise ValueError(f"unknown unit {unit!r}; expected one of {sorted(_UNITS)}")
    return F.expr(f"INTERVAL {int(amount)} {_UNITS[unit]}")


def within_last(ts: Column | str, as_of: Column, amount: int, unit: str) -> Column:
    """``ts >= as_of - amount unit`` with no upper bound (trailing window)."""
    return _col(ts) >= as_of - interval(amount, unit)


def hour_bucket(ts: Column | str) -> Column:
    """DATE_TRUNC('hour', ts), kept without zone.

    Built from the value's own fields, so the session time zone never
    enters (``date_trunc`` would pass through it, and misplace times that
    fall into a daylight-saving gap).
    """
    ts = _col(ts)
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts),
                                F.lit(0), F.lit(0))


def ingest_hour(ts: Column | str) -> Column:
    """The landing table's partition value of an arrival time: text that sorts
    as the hours do."""
    ts = _col(ts)
    return F.concat(F.date_format(F.to_date(ts), "yyyy-MM-dd"), F.lit("-"),
                    F.lpad(F.hour(ts).cast("string"), 2, "0"))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Midnights crossed from ``start`` to ``end`` (23:00 -> 01:00 is 1)."""
    return F.datediff(_col(end), _col(start)).cast("long")


def day_name(ts: Column | str) -> Column:
    """Three-letter English weekday, 'Mon' ... 'Sun'."""
    return F.dayname(_col(ts))


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(_col(ts)).cast("long")


# Dashboard periods for the top-seller ranking. A rolling hour,
# the calendar day of ``as_of``, and a rolling seven days.
PERIODS = ("hour", "today", "week")


def period_start(period: str, as_of: Column) -> Column:
    """Earliest order time a named period can include (for pruning)."""
    if period == "hour":
        return as_of - interval(1, "hour")
    if period == "today":
        return F.to_date(as_of).cast("timestamp_ntz")
    if period == "week":
        return as_of - interval(7, "day")
    raise ValueError(f"unknown period {period!r}; expected one of {PERIODS}")


def period_filter(period: str, ts: Column | str, as_of: Column) -> Column:
    """Predicate selecting the rows of a named dashboard period."""
    ts = _col(ts)
    if period == "hour":
        return within_last(ts, as_of, 1, "hour")
    if period == "today":
        return F.to_date(ts) == F.to_date(as_of)
    if period == "week":
        return within_last(ts, as_of, 7, "day")
    raise ValueError(f"unknown period {period!r}; expected one of {PERIODS}")
