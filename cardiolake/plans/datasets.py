"""Chart-ready datasets (D01-D10): the data behind each dashboard figure."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cardiolake.operators import windows as W


def resting_hr_trend(daily_hr: DataFrame, digits: int | None = 2) -> DataFrame:
    """Day, resting HR, 30-day (min 7), 6-month (min 30), 12-month (min 60)
    centred means and the centred 6-month p25/p75 band."""
    v = "resting_hr"
    return daily_hr.select(
        "subject_id", "day", v,
        W.rolling_mean(v, 30, 7, digits=digits).alias("trend_30d"),
        W.rolling_mean(v, 180, 30, digits=digits).alias("trend_6m"),
        W.rolling_mean(v, 365, 60, digits=digits).alias("trend_12m"),
        W.rolling_quantile(v, 0.25, 180, 30, digits=digits).alias("p25"),
        W.rolling_quantile(v, 0.75, 180, 30, digits=digits).alias("p75"),
    )


from pyspark.sql import functions as F  # noqa: E402

from cardiolake.functions.dates import month_start_key  # noqa: E402
from cardiolake.functions.labels import title_case  # noqa: E402
from cardiolake.operators import aggregate as AG, calendar as C, stats as ST, topk as TK  # noqa: E402

STEPS_GOAL = 10_000


def steps_monthly_trend(act: DataFrame) -> DataFrame:
    """Month, mean steps, centred 6-month trend (min 2, over months with data), goal."""
    m = AG.monthly_activity(act, digits=None)
    return m.select("subject_id", month_start_key("year", "month").alias("month_start"), "steps_avg",
                    W.rolling_mean("steps_avg", 6, 2, order=("year", "month")).alias("steps_trend"),
                    F.lit(STEPS_GOAL).alias("goal"))


def sleep_trend(act: DataFrame) -> DataFrame:
    """Month, mean sleep, centred 6-month trend (min 2), mean sleep quality."""
    m = AG.monthly_activity(act, digits=None)
    return m.select("subject_id", month_start_key("year", "month").alias("month_start"), "sleep_avg",
                    W.rolling_mean("sleep_avg", 6, 2, order=("year", "month")).alias("sleep_trend"),
                    "sleep_quality_avg")


def trainings_by_year(tr: DataFrame, k: int = 5) -> DataFrame:
    """Sessions per year for the top-k sports, the rest as Other."""
    return TK.counts_per_year_top(tr, "sport", k)


def sport_share(tr: DataFrame, k: int = 7) -> DataFrame:
    """Top-k sports + Other with counts and shares; display label title-cased."""
    t = TK.top_k_plus_rest(tr, "sport", k)
    return t.withColumn("label", F.when(F.col("sport") == TK.OTHER, F.col("sport"))
                        .otherwise(title_case("sport")))


def resting_hr_heatmap(hr: DataFrame) -> DataFrame:
    """Month x weekday grid of mean resting HR (12 x 7 per subject)."""
    from cardiolake.dims import WEEKDAY_SHORT
    return C.grid_pivot(hr, "resting_hr", "month", "weekday_no", WEEKDAY_SHORT)


def weekly_training_hr(tr: DataFrame, hr: DataFrame, lag_weeks: int = 0) -> DataFrame:
    """D07 table: weekly training minutes (empty weeks 0) with the same week's
    mean resting HR (``lag_weeks`` shifts HR later); weeks lacking HR dropped."""
    t = C.resample(tr, "week", sums=["duration_min"]).withColumnRenamed("duration_min", "training_min")
    h = C.resample(hr, "week", means=["resting_hr"])
    if lag_weeks:
        h = h.withColumn("period", F.date_sub("period", 7 * lag_weeks))
    return t.join(h, ["subject_id", "period"]).dropna(subset=["training_min", "resting_hr"])


def hypothesis_training_hr(tr: DataFrame, hr: DataFrame, lag_weeks: int = 0) -> DataFrame:
    """D07 statistics per subject: n, Pearson r, R^2, slope, intercept, Spearman rho."""
    return ST.correlation_report(weekly_training_hr(tr, hr, lag_weeks), "training_min", "resting_hr")


def sleep_next_day_hr(act: DataFrame, hr: DataFrame, lo: float = 3, hi: float = 12,
                      strict_days: bool = False) -> DataFrame:
    """D08 table: sleep of a day with the next row's resting HR (row-based lead
    over the joined days), rows with gaps dropped, sleep within lo..hi."""
    j = hr.join(act, ["subject_id", "day"])
    t = j.select("subject_id", "day", "sleep_hours", "resting_hr",
                 W.lead_one("resting_hr", strict_days=strict_days).alias("hr_next"))
    return (t.dropna(subset=["sleep_hours", "resting_hr", "hr_next"])
            .where(F.col("sleep_hours").between(lo, hi)))


def hypothesis_sleep_hr(act: DataFrame, hr: DataFrame) -> DataFrame:
    """D08 statistics per subject."""
    return ST.correlation_report(sleep_next_day_hr(act, hr), "sleep_hours", "hr_next")


def hrv_monthly_trend(hrv: DataFrame) -> DataFrame:
    """Month-end means of RMSSD/SDNN (empty months NULL) + trailing 6-month RMSSD mean (min 2)."""
    m = C.resample(hrv, "month", means=["rmssd", "sdnn"])
    return m.withColumn("rmssd_trend", W.rolling_mean("rmssd", 6, 2, center=False, order=("period",)))


def hrv_hr_fit(hrv: DataFrame, hr: DataFrame) -> DataFrame:
    """RMSSD vs resting HR on common days: r, R^2, slope, intercept."""
    j = hrv.join(hr, ["subject_id", "day"]).dropna(subset=["rmssd", "resting_hr"])
    return ST.pearson(j, "rmssd", "resting_hr")


def kpi_cards(act: DataFrame, hr: DataFrame, tr: DataFrame, hrv: DataFrame | None = None,
              digits: bool = True) -> DataFrame:
    """One KPI row per subject (reference rounding unless ``digits=False``)."""
    k = AG.kpis(act, hr, tr, hrv)
    if not digits:
        return k
    rnd = {"years": 1, "steps_avg": 0, "sleep_avg": 1, "resting_hr_avg": 1, "rmssd_avg": 1}
    return k.select(*[F.round(c, rnd[c]).alias(c) if c in rnd else F.col(c) for c in k.columns])
