"""Calendar spines, resampling and gap reports.

A spine covers each subject's own first..last period, so it is bounded by
the calendar (days, weeks, months), never by data volume. It is generated
from the observed periods themselves (each one emits the empty periods up to
the next), which needs neither a cross join nor a self-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardiolake.functions.dates import week_end_sunday

PERIOD_KEYS = {
    "day": lambda d: d,
    "week": week_end_sunday,              # weeks end on Sunday
    "month": lambda d: F.last_day(d),     # month end
}
PERIOD_STEP = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH"}


def period_key(period: str, day: str | Column = "day") -> Column:
    d = F.col(day) if isinstance(day, str) else day
    return PERIOD_KEYS[period](d)


def _gap_periods(period: str, key: Column, nxt: Column) -> Column:
    """Periods from ``key`` up to (not including) ``nxt``; just ``key`` when last."""
    if period == "month":
        end = F.last_day(F.add_months(nxt, -1))
    else:
        end = F.date_sub(nxt, 7 if period == "week" else 1)
    seq = F.sequence(key, F.coalesce(end, key), F.expr(PERIOD_STEP[period]))
    if period == "month":  # month steps from a month end: take each month's end
        seq = F.transform(seq, lambda d: F.last_day(d))
    return seq


def resample(df: DataFrame, period: str, sums=(), means=(), day: str = "day",
             key: str = "period", group=("subject_id",), fill_spine: bool = True) -> DataFrame:
    """Calendar resample: sums fill empty periods with 0, means leave them NULL.

    The spine spans the first..last period of *this* table per subject. It
    is built in one pass over the aggregated periods: each period emits
    itself and the empty periods up to the next observed one (``lead`` over
    the subject's periods, then ``sequence``), so there is no second
    aggregation and no self-join.
    """
    g = list(group)
    keyed = df.withColumn(key, period_key(period, day))
    aggs = [F.sum(c).alias(c) for c in sums] + [F.avg(c).alias(c) for c in means]
    agg = keyed.groupBy(*g, key).agg(*aggs)
    if not fill_spine:
        return agg
    with_next = agg.withColumn("_next", F.lead(key).over(Window.partitionBy(*g).orderBy(key)))
    filled = with_next.select("*", F.explode(_gap_periods(period, F.col(key), F.col("_next"))).alias("_p"))
    own = F.col("_p") == F.col(key)
    return filled.select(
        *g, F.col("_p").alias(key),
        *[F.when(own, F.coalesce(F.col(c), F.lit(0))).otherwise(F.lit(0)).cast("double").alias(c) for c in sums],
        *[F.when(own, F.col(c)).alias(c) for c in means])


def missing_days(df: DataFrame, day: str = "day", group=("subject_id",)) -> DataFrame:
    """Days in each subject's first..last range that have no row,
    generated directly as the gaps between consecutive observed days."""
    g = list(group)
    obs = df.select(*g, F.col(day).alias("day")).distinct()
    nxt = F.col("_next")
    gap = F.when(F.datediff(nxt, F.col("day")) > 1,
                 F.sequence(F.date_add("day", 1), F.date_sub(nxt, 1), F.expr("INTERVAL 1 DAY")))
    with_next = obs.withColumn("_next", F.lead("day").over(Window.partitionBy(*g).orderBy("day")))
    return with_next.select(*g, F.explode(gap).alias("day"))


def coverage(df: DataFrame, day: str = "day", group=("subject_id",)) -> DataFrame:
    """Days present, span, percent covered and days missing per subject."""
    g = list(group)
    obs = df.select(*g, F.col(day).alias("day")).distinct()
    return (obs.groupBy(*g)
            .agg(F.count(F.lit(1)).alias("days_present"),
                 F.min("day").alias("first_day"), F.max("day").alias("last_day"))
            .withColumn("span_days", F.datediff("last_day", "first_day") + 1)
            .withColumn("days_missing", F.col("span_days") - F.col("days_present"))
            .withColumn("pct_covered", F.try_divide(F.col("days_present") * 100.0, F.col("span_days"))))


def missing_per_year(df: DataFrame, day: str = "day", group=("subject_id",)) -> DataFrame:
    """Missing days per subject and year."""
    g = list(group)
    return (missing_days(df, day, g).groupBy(*g, F.year("day").alias("year"))
            .agg(F.count(F.lit(1)).alias("days_missing")))


def _fixed(agg: DataFrame, key: str, lo: int, hi: int, g: list[str], cols: list[str]) -> DataFrame:
    """The aggregate ``agg`` (one row per group and ``key``) with all keys ``lo..hi`` of every group.

    A group's few rows become a map and are laid out again: the input is not read a second time.
    """
    entry = F.struct(F.col(key).cast("int").alias("k"), F.struct(*cols).alias("v"))
    # at most hi - lo + 1 entries
    filled = (agg.groupBy(*g).agg(F.map_from_entries(F.collect_list(F.when(F.col(key).between(lo, hi), entry))).alias("_m"))
              .select(*g, F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias(key), "_m"))
    row = F.try_element_at("_m", F.col(key))
    return filled.select(*g, key, *[row[c].alias(c) for c in cols])


def grid_pivot(df: DataFrame, value: str, row: str = "month", col: str = "weekday_no",
               labels: list[str] | None = None, group=("subject_id",), rows=(1, 12)) -> DataFrame:
    """Mean of ``value`` by row x column, reindexed to all rows (12 months)
    and all columns (7 weekdays, fixed pivot values: no extra pass to find them)."""
    g = list(group)
    labels = labels or [str(i) for i in range(7)]
    piv = df.groupBy(*g, row).pivot(col, list(range(len(labels)))).agg(F.avg(value))
    for i, lab in enumerate(labels):
        piv = piv.withColumnRenamed(str(i), lab)
    return _fixed(piv, row, rows[0], rows[1], g, labels)


def weekday_counts(df: DataFrame, day: str = "day", group=("subject_id",)) -> DataFrame:
    """Rows per weekday, all seven weekdays present (0 when none)."""
    g = list(group)
    c = df.groupBy(*g, F.weekday(day).alias("weekday_no")).agg(F.count(F.lit(1)).alias("n"))
    return (_fixed(c, "weekday_no", 0, 6, g, ["n"])
            .select(*g, "weekday_no", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def monthly_profile(df: DataFrame, value: str, group=("subject_id",)) -> DataFrame:
    """Mean per calendar month, all 12 months present."""
    g = list(group)
    m = df.groupBy(*g, F.month("day").alias("month")).agg(F.avg(value).alias(f"{value}_mean"))
    return _fixed(m, "month", 1, 12, g, [f"{value}_mean"])
