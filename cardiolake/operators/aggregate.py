"""Rollups and descriptive statistics.

All are hash aggregates with map-side partial aggregation; exact quantiles
use ``percentile`` (value->count maps, merged across tasks), which suits daily
tables; with ``spread=True`` they come from ``operators.ranking``, which holds
no group's values together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cardiolake.functions.convert import round_to
from cardiolake.functions.labels import sleep_band
from cardiolake.operators.ranking import exact_quantiles, skew_join

SUMMER = (6, 7, 8)
WINTER = (12, 1, 2)


def monthly_activity(act: DataFrame, digits=(0, 1, 2, 3), group=("subject_id",)) -> DataFrame:
    """Monthly means of steps, calories, sleep, sleep quality over days with steps."""
    g = list(group)
    ds, dc, dh, dq = digits if digits is not None else (None,) * 4
    return (act.where(F.col("steps").isNotNull())
            .groupBy(*g, F.year("day").alias("year"), F.month("day").alias("month"))
            .agg(round_to(F.avg("steps"), ds).alias("steps_avg"),
                 round_to(F.avg("calories"), dc).alias("calories_avg"),
                 round_to(F.avg("sleep_hours"), dh).alias("sleep_avg"),
                 round_to(F.avg("sleep_quality"), dq).alias("sleep_quality_avg"),
                 F.count(F.lit(1)).alias("n_days")))


def trainings_per_year(tr: DataFrame, digits: int | None = 1, group=("subject_id",)) -> DataFrame:
    """Sessions and hours per year and sport (sessions with a duration)."""
    g = list(group)
    return (tr.where(F.col("duration_min") > 0)
            .groupBy(*g, "year", "sport")
            .agg(F.count(F.lit(1)).alias("n_sessions"),
                 round_to(F.sum("duration_min") / 60.0, digits).alias("hours")))


def resting_hr_grid(hr: DataFrame, digits: int | None = 1, group=("subject_id",)) -> DataFrame:
    """Mean resting HR and count by month x weekday."""
    g = list(group)
    return (hr.where(F.col("resting_hr").isNotNull())
            .groupBy(*g, "month", "weekday_no")
            .agg(round_to(F.avg("resting_hr"), digits).alias("hr_avg"), F.count(F.lit(1)).alias("n")))


def import_log_overview(log: DataFrame) -> DataFrame:
    """Files and last import per category."""
    return log.groupBy("category").agg(F.count(F.lit(1)).alias("n_files"),
                                       F.max("imported_at").alias("last_import"))


def table_overview(tables: dict[str, DataFrame], day: str = "day") -> DataFrame:
    """Rows and first/last day per table, stacked."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(day).alias("min_day"),
                    F.max(day).alias("max_day")).select(F.lit(name).alias("table_name"), "*")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def document_overview(docs: DataFrame) -> DataFrame:
    """Documents and first/last day by category."""
    return docs.groupBy("category").agg(F.count(F.lit(1)).alias("n_docs"),
                                        F.min("day").alias("min_day"), F.max("day").alias("max_day"))


def yearly_stats(df: DataFrame, value: str, digits: int | None = 1, group=("subject_id",)) -> DataFrame:
    """Mean, median, std, min, max, count per year."""
    g = list(group)
    v = F.col(value)
    return (df.where(v.isNotNull()).groupBy(*g, F.year("day").alias("year"))
            .agg(round_to(F.avg(v), digits).alias("mean"),
                 round_to(F.median(v), digits).alias("median"),
                 round_to(F.stddev_samp(v), digits).alias("std"),
                 round_to(F.min(v), digits).alias("min"),
                 round_to(F.max(v), digits).alias("max"),
                 F.count(v).alias("n")))


def yearly_mean(df: DataFrame, value: str, group=("subject_id",)) -> DataFrame:
    """A14."""
    g = list(group)
    return df.groupBy(*g, F.year("day").alias("year")).agg(F.avg(value).alias(f"{value}_mean"))


def monthly_mean_sem(df: DataFrame, value: str, group=("subject_id",)) -> DataFrame:
    """Mean, standard error and 95% half-width per calendar month."""
    g = list(group)
    v = F.col(value)
    sem = F.stddev_samp(v) / F.sqrt(F.count(v))
    return (df.groupBy(*g, F.month("day").alias("month"))
            .agg(F.avg(v).alias("mean"), sem.alias("sem"), (sem * 1.96).alias("ci95"),
                 F.count(v).alias("n")))


def season_contrast_of_monthly_means(df: DataFrame, value: str, group=("subject_id",)) -> DataFrame:
    """Mean of the monthly means in Jun-Aug vs Dec-Feb, and the difference."""
    g = list(group)
    m = df.groupBy(*g, F.month("day").alias("month")).agg(F.avg(value).alias("m"))
    return _contrast(m, "m", "month", g)


def season_contrast_of_days(df: DataFrame, value: str, group=("subject_id",)) -> DataFrame:
    """Mean of daily values in Jun-Aug vs Dec-Feb, and the difference."""
    g = list(group)
    return _contrast(df.withColumn("month", F.month("day")), value, "month", g)


def _contrast(df, v, month, g):
    s = F.avg(F.when(F.col(month).isin(*SUMMER), F.col(v)))
    w = F.avg(F.when(F.col(month).isin(*WINTER), F.col(v)))
    return df.groupBy(*g).agg(s.alias("summer"), w.alias("winter")) \
        .withColumn("summer_minus_winter", F.col("summer") - F.col("winter"))


def value_counts(df: DataFrame, col: str, group=("subject_id",)) -> DataFrame:
    """Rows per value (NULL dropped)."""
    g = list(group)
    return df.where(F.col(col).isNotNull()).groupBy(*g, col).agg(F.count(F.lit(1)).alias("n"))


def running_per_year(tr: DataFrame, group=("subject_id",)) -> DataFrame:
    """Running distance and sessions per year."""
    g = list(group)
    return (tr.where(F.col("sport") == "RUNNING").groupBy(*g, "year")
            .agg(F.sum("distance_km").alias("distance_km"), F.count(F.lit(1)).alias("n_runs")))


def frequency_year_month(tr: DataFrame, group=("subject_id",)) -> DataFrame:
    """Sessions per year x month (12 fixed pivot columns, 0 when none)."""
    g = list(group)
    p = tr.groupBy(*g, "year").pivot("month", list(range(1, 13))).agg(F.count(F.lit(1)))
    for m in range(1, 13):
        p = p.withColumn(str(m), F.coalesce(F.col(str(m)), F.lit(0)).cast("long")) \
             .withColumnRenamed(str(m), f"m{m:02d}")
    return p


def hr_by_hour(samples: DataFrame, digits: int | None = 1, group=("subject_id",)) -> DataFrame:
    """Mean heart rate and sample count by hour of day."""
    g = list(group)
    hour = F.floor(F.col("seconds_from_day_start") / 3600).cast("int")
    return (samples.groupBy(*g, hour.alias("hour"))
            .agg(round_to(F.avg("hr"), digits).alias("hr_mean"), F.count(F.lit(1)).alias("n")))


def _quartiles(v: Column, approx_accuracy: int | None) -> Column:
    qs = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    if approx_accuracy is None:
        return F.percentile(v, qs)
    return F.percentile_approx(v, qs, approx_accuracy)


QUARTILES = [0.25, 0.5, 0.75]


def describe(df: DataFrame, cols: list[str], group=("subject_id",),
             approx_accuracy: int | None = None, spread: bool = False) -> DataFrame:
    """Count, mean, std, min, quartiles, max per column, long format.

    Quartiles are exact (``percentile`` keeps each distinct value of a group),
    which suits daily tables; for a hot group of raw samples pass ``spread``
    (exact, by value ranges) or ``approx_accuracy`` (``percentile_approx``).
    """
    g = list(group)
    stacked = df.select(*g, F.explode(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(c).cast("double").alias("value")) for c in cols
    ])).alias("_kv")).select(*g, "_kv.col_name", "_kv.value")
    base = [F.count("value").alias("count"), F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")]
    keys = [*g, "col_name"]
    if spread:
        q = exact_quantiles(stacked, "value", QUARTILES, keys, "_q").drop("n")
        rows = skew_join(stacked.groupBy(*keys).agg(*base), q, keys, "left")
    else:
        rows = stacked.groupBy(*keys).agg(*base, _quartiles(F.col("value"), approx_accuracy).alias("_q"))
    return (rows.select(*g, "col_name", "count", "mean", "std", "min",
                    F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"),
                    F.col("_q")[2].alias("p75"), "max"))


def quality_report(tables: dict[str, tuple[DataFrame, str]], day: str = "day") -> DataFrame:
    """Rows, first/last day, years covered and NULL share of a key column per table."""
    parts = []
    for name, (df, col) in tables.items():
        parts.append(df.agg(
            F.count(F.lit(1)).alias("n_rows"), F.min(day).alias("min_day"), F.max(day).alias("max_day"),
            F.countDistinct(F.year(day)).alias("n_years"),
            F.try_divide(F.count_if(F.col(col).isNull()) * 100.0, F.count(F.lit(1))).alias("pct_null"),
        ).select(F.lit(name).alias("table_name"), F.lit(col).alias("key_column"), "*"))
    return reduce(DataFrame.unionByName, parts)


def fitness_stats(ft: DataFrame, group=("subject_id",)) -> DataFrame:
    """Tests, mean/max own index and VO2max."""
    g = list(group)
    return ft.groupBy(*g).agg(F.count(F.lit(1)).alias("n_tests"),
                              F.avg("own_index").alias("own_index_mean"),
                              F.max("own_index").alias("own_index_max"),
                              F.avg("vo2max").alias("vo2max_mean"), F.max("vo2max").alias("vo2max_max"))


def box_stats(df: DataFrame, value: str, by: str | Column, by_name: str = "grp",
              group=("subject_id",), approx_accuracy: int | None = None, spread: bool = False) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (furthest values inside the fences)
    and the number of outliers per group. Quartiles come from one aggregate
    (``spread``: from value ranges, for raw samples), then a join back to the
    rows; no window spans a whole group."""
    g = list(group)
    b = F.col(by) if isinstance(by, str) else by
    v = df.select(*g, b.alias(by_name), F.col(value).alias("v")).where(F.col("v").isNotNull())
    found = (exact_quantiles(v, "v", QUARTILES, [*g, by_name], "_q") if spread else
             v.groupBy(*g, by_name).agg(_quartiles(F.col("v"), approx_accuracy).alias("_q")))
    q = (found.select(*g, by_name, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3")))
    # fences and values compared at 9 digits: a value on a fence stays on it
    lo = F.round(F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), 9)
    hi = F.round(F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")), 9)
    vr = F.round("v", 9)
    if spread:  # equal values travel as one row with their number
        v = v.groupBy(*g, by_name, "v").agg(F.count(F.lit(1)).alias("_n"))
    else:
        v = v.withColumn("_n", F.lit(1).cast("long"))
    j = skew_join(v, q, g + [by_name])
    return (j.groupBy(*g, by_name, "q1", "median", "q3")
            .agg(F.min(F.when(vr >= lo, F.col("v"))).alias("whisker_lo"),
                 F.max(F.when(vr <= hi, F.col("v"))).alias("whisker_hi"),
                 F.coalesce(F.sum(F.when((vr < lo) | (vr > hi), F.col("_n"))), F.lit(0)).alias("n_outliers"),
                 F.sum("_n").alias("n")))


def sleep_band_means(df: DataFrame, sleep: str = "sleep_hours", value: str = "hr_next",
                     group=("subject_id",)) -> DataFrame:
    """Mean and count of ``value`` per sleep band; empty bands absent."""
    g = list(group)
    return (df.where(sleep_band(sleep).isNotNull())
            .groupBy(*g, sleep_band(sleep).alias("sleep_band"))
            .agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n")))


def histogram(df: DataFrame, value: str, bins: int = 40, group=("subject_id",)) -> DataFrame:
    """Equal-width bins between each subject's min and max (last edge closed)."""
    g = list(group)
    v = df.select(*g, F.col(value).alias("v")).where(F.col("v").isNotNull())
    rng = v.groupBy(*g).agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor(F.round((F.col("v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins, 9)),
                F.lit(bins - 1)))
    return (v.join(rng, g).select(*g, idx.cast("int").alias("bin"), "_lo", width.alias("_w"))
            .groupBy(*g, "bin").agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"),
                                     F.first("_w").alias("_w"))
            .select(*g, "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"), "n"))


def median_marker(df: DataFrame, value: str, group=("subject_id",), spread: bool = False) -> DataFrame:
    """A35."""
    g = list(group)
    if spread:
        return exact_quantiles(df, value, [0.5], g, "_q").select(*g, F.col("_q")[0].alias("median"))
    return df.groupBy(*g).agg(F.median(value).alias("median"))


def first_last_year(df: DataFrame, value: str, group=("subject_id",)) -> DataFrame:
    """Mean of the first and of the last year, and the change."""
    g = list(group)
    y = yearly_mean(df, value, g)
    m = f"{value}_mean"
    return (y.groupBy(*g).agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"),
                              F.min_by(m, "year").alias("first_mean"), F.max_by(m, "year").alias("last_mean"))
            .withColumn("change", F.col("last_mean") - F.col("first_mean")))


def year_span(df: DataFrame, day: str = "day", group=("subject_id",)) -> DataFrame:
    """A41."""
    g = list(group)
    return df.groupBy(*g).agg(F.min(F.year(day)).alias("first_year"), F.max(F.year(day)).alias("last_year"))


def kpis(act: DataFrame, hr: DataFrame, tr: DataFrame, hrv: DataFrame | None = None,
         group=("subject_id",)) -> DataFrame:
    """One row per subject: years covered, mean steps/sleep/resting HR/RMSSD,
    sessions, runs; absent parts count as 0."""
    g = list(group)
    a = act.groupBy(*g).agg(
        (F.datediff(F.max("day"), F.min("day")) / 365.25).alias("years"),
        F.avg("steps").alias("steps_avg"), F.avg("sleep_hours").alias("sleep_avg"))
    h = hr.groupBy(*g).agg(F.avg("resting_hr").alias("resting_hr_avg"))
    t = tr.groupBy(*g).agg(F.count(F.lit(1)).alias("sessions"),
                           F.count_if(F.col("sport") == "RUNNING").alias("runs"))
    parts = [a, h, t]
    if hrv is not None:
        parts.append(hrv.groupBy(*g).agg(F.avg("rmssd").alias("rmssd_avg")))
    out = reduce(lambda x, y: x.join(y, g, "full_outer"), parts)
    fill = {c: 0 for c in out.columns if c not in g}
    return out.na.fill(fill)
