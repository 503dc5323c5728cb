"""Tolerant conversions, fallbacks, unit changes and rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def safe_double(col) -> Column:
    """float(x) or NULL, from JSON text, a number or a variant."""
    return _c(col).try_cast("double")


def safe_int(col) -> Column:
    """int(x) or NULL. On a variant: ``"12"`` -> 12, ``"1.5"`` -> NULL, ``1.9`` -> 1."""
    return _c(col).try_cast("int")


def safe_long(col) -> Column:
    return _c(col).try_cast("bigint")


def safe_string(col) -> Column:
    return _c(col).try_cast("string")


def falsy_fallback(a, b) -> Column:
    """Python ``a or b`` for numbers: 0 and NULL both fall through to ``b``."""
    return F.coalesce(F.nullif(_c(a), F.lit(0)), _c(b))


def null_or_default(col, default) -> Column:
    """NULL and NaN -> default."""
    c = _c(col)
    return F.coalesce(F.nanvl(c, F.lit(None).cast("double")), F.lit(default))


def round_to(col, digits: int | None) -> Column:
    c = _c(col)
    return c if digits is None else F.round(c, digits)


def m_to_km(col, digits: int | None = 3) -> Column:
    return round_to(_c(col) / 1000.0, digits)


def ms_to_minutes(col, digits: int | None = 2) -> Column:
    return round_to(_c(col) / 60000.0, digits)


def minutes_to_hours(col, digits: int | None = 2) -> Column:
    return round_to(_c(col) / 60.0, digits)


def ppi_to_bpm(col, digits: int | None = 1) -> Column:
    """60000 / mean pulse interval (ms); NULL when the mean is not positive."""
    c = _c(col)
    return F.when(c > 0, round_to(F.lit(60000.0) / c, digits))
