"""Table scans with pushed-down predicates (S06-S12) and ad-hoc SQL.

Filters are plain Column predicates on the scanned table, so Catalyst pushes
them into the Parquet scan (row-group skipping) and prunes columns to the
projection; with ``partitionBy("subject_id", "year")`` at write time they
also prune directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.functions.dates import date_range_predicate

ACTIVITY_COLS = ["subject_id", "day", "steps", "calories", "sleep_hours", "sleep_quality", "met_minutes"]
TRAINING_COLS = ["subject_id", "day", "sport", "category", "duration_min", "hr_avg", "hr_max",
                 "distance_km", "calories", "weekday", "year"]
HEARTRATE_COLS = ["subject_id", "day", "resting_hr", "hr_mean", "hr_max", "weekday_no", "month"]
HRV_COLS = ["subject_id", "day", "rmssd", "sdnn", "ppi_mean_ms", "hr_from_ppi", "n_samples"]


def scan(df: DataFrame, cols: list[str] | None, start=None, end=None, day: str = "day",
         subjects: list[int] | None = None) -> DataFrame:
    """Projected, date-bounded (both bounds optional, inclusive), ordered scan."""
    out = df.where(date_range_predicate(day, start, end))
    if subjects is not None:
        out = out.where(F.col("subject_id").isin(*subjects))
    if cols:
        out = out.select(*cols)
    return out.orderBy("subject_id", day)


def scan_activity(df, start=None, end=None, subjects=None) -> DataFrame:
    """S06."""
    return scan(df, ACTIVITY_COLS, start, end, subjects=subjects)


def scan_training(df, start=None, end=None, sport: str | None = None, subjects=None) -> DataFrame:
    """Plus a case-insensitive sport filter."""
    out = df if sport is None else df.where(F.upper("sport") == sport.upper())
    return scan(out, TRAINING_COLS, start, end, subjects=subjects)


def scan_heartrate(df, start=None, end=None, subjects=None) -> DataFrame:
    """S08."""
    return scan(df, HEARTRATE_COLS, start, end, subjects=subjects)


def scan_hrv(df, start=None, end=None, subjects=None) -> DataFrame:
    """S09."""
    return scan(df, HRV_COLS, start, end, subjects=subjects)


def scan_fitness(df) -> DataFrame:
    """All fitness tests ordered by day."""
    return df.orderBy("subject_id", "day")


def adhoc_sql(spark: SparkSession, sql: str, args: dict | None = None, **views: DataFrame) -> DataFrame:
    """Run SQL with named parameters over the given views. Errors raise."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args or {})
