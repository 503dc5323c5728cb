"""Sliding windows over series of any length (W01-W03 on raw samples).

A window function sorts a whole partition in one task. Here a series is
numbered first (rows are dealt into ranges of the order, so no task sees all of
it), cut into blocks of consecutive numbers, and each block gets the rows beside
it that its frames reach (its halo) as copies. The window then runs per block;
the result equals the one over the whole series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from cardiolake.functions.convert import round_to
from cardiolake.operators.ranking import ranges_of, skew_join, stored
from cardiolake.operators.windows import centered_frame


def numbered(df: DataFrame, partition: list[str], order: list[str], name: str = "_no", ranges: int | None = None) -> DataFrame:
    """``df`` with each row's place (from 0) in its series, nulls of the order first; stored.

    ``order`` should tell the rows of a series apart; equal ones are numbered in any order.
    """
    by = [F.col(c).asc_nulls_first() for c in [*partition, *order]]
    # the id counts up within a task's sorted rows, with the task's number in the bits from 33 up
    rows = stored(df.repartitionByRange(ranges or ranges_of(df.sparkSession), *by).sortWithinPartitions(*by)
                  .withColumn("_place", F.monotonically_increasing_id())
                  .withColumn("_range", F.shiftright("_place", 33)))
    parts = rows.groupBy(*partition, "_range").agg(F.count(F.lit(1)).alias("_c"), F.min("_place").alias("_first"))
    # one row per range of a series
    w = Window.partitionBy(*partition).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(*partition, "_range", "_first", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_before"))
    return (skew_join(rows, starts, [*partition, "_range"])
            .withColumn(name, F.col("_before") + F.col("_place") - F.col("_first"))
            .drop("_place", "_range", "_first", "_before"))


def blockwise(df: DataFrame, columns: dict[str, tuple[int, int, Callable[[WindowSpec], Column]]],
              partition=("subject_id",), order=("ts",), block: int = 65_536, ranges: int | None = None) -> DataFrame:
    """``df`` with window columns: name -> (first, last, make), where ``make(window)`` is computed over
    the rows ``first`` to ``last`` places from the row's own, as in ``rowsBetween``."""
    p = list(partition)
    before = max([0, *(-lo for lo, _, _ in columns.values())])
    after = max([0, *(hi for _, hi, _ in columns.values())])
    size = max(block, before, after, 1)  # a frame reaches into the blocks beside its own, no farther
    rows = numbered(df, p, list(order), ranges=ranges)
    own = F.floor(F.col("_no") / size)
    place = F.pmod(F.col("_no"), F.lit(size))
    # a row also stands in the next block if that one's first frames reach back to it, and the other way round
    spots = F.array_compact(F.array(own, F.when(place >= size - before, own + 1) if before else F.lit(None).cast("long"),
                                    F.when((place < after) & (own > 0), own - 1) if after else F.lit(None).cast("long")))
    spread = (rows.withColumn("_own", own).withColumn("_block", F.explode(spots)))
    w = Window.partitionBy(*p, "_block").orderBy("_no")
    out = spread.select("*", *[make(w.rowsBetween(lo, hi)).alias(name) for name, (lo, hi, make) in columns.items()])
    return out.where("_own = _block").drop("_no", "_own", "_block")


def mean_of(col: str, n: int, min_periods: int, center: bool = True, digits: int | None = None):
    """A column for ``blockwise``: W01 (centred) or W03 (trailing) mean, null below ``min_periods`` values."""
    lo, hi = centered_frame(n) if center else (-(n - 1), 0)
    return lo, hi, lambda w: F.when(F.count(col).over(w) >= min_periods, round_to(F.avg(col).over(w), digits))


def quantile_of(col: str, q: float, n: int, min_periods: int, center: bool = True, digits: int | None = None):
    """A column for ``blockwise``: W02, the exact (linear) quantile."""
    lo, hi = centered_frame(n) if center else (-(n - 1), 0)
    return lo, hi, lambda w: F.when(F.count(col).over(w) >= min_periods,
                                    round_to(F.percentile(F.col(col), F.lit(q)).over(w), digits))
