"""Labels, bands and the file-name classifier."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cardiolake.dims import FILE_CATEGORY_RULES, OTHER_CATEGORY


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def file_category(name) -> Column:
    """Ordered substring rules on the lower-cased file name; first match wins."""
    n = F.lower(_c(name))
    e = None
    for needles, cat in FILE_CATEGORY_RULES:
        cond = None
        for s in needles:
            c = n.contains(s)
            cond = c if cond is None else (cond | c)
        e = F.when(cond, F.lit(cat)) if e is None else e.when(cond, F.lit(cat))
    return e.otherwise(F.lit(OTHER_CATEGORY))


def label_at(labels: list[str], idx, base: int = 0) -> Column:
    """``labels[idx - base]`` (NULL outside the list)."""
    arr = F.array(*[F.lit(x) for x in labels])
    return F.get(arr, _c(idx) - F.lit(base))


def title_case(col) -> Column:
    """Python ``str.title`` for names of words: TRAIL_RUNNING -> Trail_Running, NORDIC WALKING -> Nordic Walking."""
    return F.array_join(F.transform(F.split(_c(col), "_"), F.initcap), "_")


# FIXED VALUES: sleep bands (right-closed) and their labels
SLEEP_BANDS = [(0, 5, "<5h"), (5, 6, "5–6h"), (6, 7, "6–7h"), (7, 8, "7–8h"), (8, 9, "8–9h"),
               (9, 99, ">9h")]


def sleep_band(col) -> Column:
    c = _c(col)
    e = None
    for lo, hi, lab in SLEEP_BANDS:
        cond = (c > lo) & (c <= hi)
        e = F.when(cond, F.lit(lab)) if e is None else e.when(cond, F.lit(lab))
    return e


def effect_label(r) -> Column:
    """|r| < .3 weak, < .6 moderate, else strong."""
    a = F.abs(_c(r))
    return F.when(a < 0.3, "weak").when(a < 0.6, "moderate").when(a.isNotNull(), "strong")
