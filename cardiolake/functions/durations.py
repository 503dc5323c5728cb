"""ISO-8601 durations (``PT1H30M45S``) to minutes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_NUM = r"(\d+(?:\.\d+)?)"


def _part(s: Column, unit: str) -> Column:
    # the regex only runs when the unit letter is present at all
    txt = F.regexp_extract(s, _NUM + unit, 1)
    return F.when(F.instr(s, unit) > 0, F.coalesce(txt.try_cast("double"), F.lit(0.0))).otherwise(F.lit(0.0))


def iso_duration_minutes(col: Column | str, digits: int | None = 4) -> Column:
    """Lenient form used for file exports.

    Each of ``<n>H``, ``<n>M``, ``<n>S`` is searched on its own and summed;
    anything unparseable counts as 0. Minutes are only read after the ``T``
    so that a month (``P1M``) is not taken for minutes. NULL/empty -> 0.0.
    """
    return time_part_minutes(time_part(col), digits)


def time_part(col: Column | str) -> Column:
    """What follows the last "T"; a "P..." duration without "T" has none (P1M is a month)."""
    s = F.col(col) if isinstance(col, str) else col
    return (F.when(F.instr(s, "T") > 0, F.substring_index(s, "T", -1))
            .when(F.startswith(s, F.lit("P")), F.lit("")).otherwise(s))


def time_part_minutes(t: Column, digits: int | None = 4) -> Column:
    """Minutes of a ``time_part``; reads ``t`` several times, so a column of its own serves best."""
    secs = _part(t, "H") * 3600 + _part(t, "M") * 60 + _part(t, "S")
    mins = secs / 60.0 if digits is None else F.round(secs / 60.0, digits)
    return F.coalesce(mins, F.lit(0.0))


def iso_duration_minutes_strict(col: Column | str) -> Column:
    """Anchored form used for API payloads: ``PT(h H)?(m M)?(s S)?``; else 0.0."""
    s = F.col(col) if isinstance(col, str) else col
    pat = r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?"
    ok = s.rlike(pat)

    def g(i):
        return F.coalesce(F.regexp_extract(s, pat, i).try_cast("double"), F.lit(0.0))

    return F.when(ok, g(1) * 60 + g(2) + g(3) / 60.0).otherwise(F.lit(0.0))
