"""Row-based window operators over per-subject daily series.

All windows partition by ``subject_id``; a subject's daily series is bounded
by the calendar (about 365 rows a year), whatever the raw data volume, so the
sliding frames below stay small per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardiolake.functions.convert import round_to


def centered_frame(n: int) -> tuple[int, int]:
    """Row offsets of a centred window of ``n`` rows (even ``n`` leans back)."""
    return -(n // 2), n - n // 2 - 1


def _w(partition, order, lo, hi):
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(lo, hi)


def rolling_mean(col: str, n: int, min_periods: int, center: bool = True,
                 partition=("subject_id",), order=("day",), digits: int | None = None) -> Column:
    """Mean over ``n`` rows (centred or trailing), NULL unless ``min_periods``
    non-NULL values are in the frame; NULLs are skipped, not counted."""
    lo, hi = centered_frame(n) if center else (-(n - 1), 0)
    w = _w(partition, order, lo, hi)
    return F.when(F.count(col).over(w) >= min_periods, round_to(F.avg(col).over(w), digits))


def rolling_quantile(col: str, q: float, n: int, min_periods: int, center: bool = True,
                     partition=("subject_id",), order=("day",), digits: int | None = None) -> Column:
    """Exact (linear) quantile over a sliding row frame."""
    lo, hi = centered_frame(n) if center else (-(n - 1), 0)
    w = _w(partition, order, lo, hi)
    return F.when(F.count(col).over(w) >= min_periods,
                  round_to(F.percentile(F.col(col), F.lit(q)).over(w), digits))


def lead_one(col: str, partition=("subject_id",), order=("day",), strict_days: bool = False) -> Column:
    """Next row's value (row-based). ``strict_days`` keeps it only if the next
    row is exactly the next calendar day."""
    w = Window.partitionBy(*partition).orderBy(*order)
    nxt = F.lead(col).over(w)
    if not strict_days:
        return nxt
    return F.when(F.lead(order[0]).over(w) == F.date_add(F.col(order[0]), 1), nxt)


def best_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the first row per key by ``order`` (row_number = 1)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_per_key(df: DataFrame, keys: list[str], order: list[tuple[str, bool, bool]]) -> DataFrame:
    """One row per key: the first by ``order`` = [(column, descending, nulls_last)].

    An aggregate (the least struct of order values and columns) instead of a
    window: duplicates collapse map-side before the shuffle, and a hot key is
    combined in many tasks. Descending order needs numeric columns (negated);
    remaining ties fall back to all other columns.
    """
    others = [c for c in df.columns if c not in keys]
    okey = []
    for c, desc, nulls_last in order:
        col = F.col(c)
        okey.append(col.isNull() if nulls_last else col.isNotNull())
        okey.append(-col if desc else col)
    # the columns end the struct, so they break ties and are the row that is kept: nothing is carried twice
    packed = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(okey)], *[F.col(c).alias(f"_c{i}") for i, c in enumerate(others)])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_row"))
    return agg.select(*keys, *[F.col("_row")[f"_c{i}"].alias(c) for i, c in enumerate(others)])


def average_rank(col: str, partition=("subject_id",)) -> Column:
    """Rank with ties averaged (as used by Spearman); NULLs get NULL."""
    w = Window.partitionBy(*partition).orderBy(F.col(col).asc_nulls_last())
    wt = Window.partitionBy(*partition, col)
    r = F.rank().over(w) + (F.count(F.lit(1)).over(wt) - 1) / 2.0
    return F.when(F.col(col).isNotNull(), r.cast("double"))
