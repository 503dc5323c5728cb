"""Timestamps, calendar parts and date predicates."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def utc_timestamp(col) -> Column:
    """ISO text with or without offset -> UTC wall-clock timestamp; bad text -> NULL.

    Relies on ``spark.sql.session.timeZone=UTC`` (set by ``session.local_session``).
    """
    return F.try_to_timestamp(_c(col))


def weekday_no(day) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(_c(day))


def weekday_name(day) -> Column:
    """English weekday name, e.g. ``Monday``."""
    return F.date_format(_c(day), "EEEE")


def date_parts(day) -> dict[str, Column]:
    d = _c(day)
    return {"year": F.year(d), "month": F.month(d), "weekday_no": F.weekday(d),
            "weekday": F.date_format(d, "EEEE")}


def add_seconds(ts, n) -> Column:
    return F.timestamp_add("SECOND", _c(n), _c(ts))


def month_start_key(year, month) -> Column:
    return F.make_date(_c(year), _c(month), F.lit(1))


def week_end_sunday(day) -> Column:
    """Label of the week (weeks end on Sunday)."""
    d = _c(day)
    return F.date_add(d, F.lit(6) - F.weekday(d))


def date_range_predicate(day, start=None, end=None) -> Column:
    """Inclusive bounds, either of which may be absent."""
    d = _c(day)
    cond = F.lit(True)
    if start is not None:
        cond = cond & (d >= F.lit(start).cast("date"))
    if end is not None:
        cond = cond & (d <= F.lit(end).cast("date"))
    return cond


def lookback_window(day, as_of: str | _dt.date, days: int) -> Column:
    """``as_of - days <= day <= as_of``; ``as_of`` is explicit so runs repeat."""
    a = F.lit(str(as_of)).cast("date")
    d = _c(day)
    return (d >= F.date_sub(a, days)) & (d <= a)
