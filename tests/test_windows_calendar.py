"""Windows and resampling, cross-checked with pandas (FIXTURES.md section 5)."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cardiolake.operators import calendar as C, windows as W

D = dt.date


def _series(spark, values, subject=0):
    rows = [(subject, D(2024, 1, 1) + dt.timedelta(days=i), None if v is None else float(v))
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "subject_id long, day date, v double")


def test_centered_sum_frames(spark):
    df = _series(spark, range(10))
    for n, want in [(4, [1, 3, 6, 10, 14, 18, 22, 26, 30, 24]), (5, [3, 6, 10, 15, 20, 25, 30, 35, 30, 24])]:
        lo, hi = W.centered_frame(n)
        w = W._w(("subject_id",), ("day",), lo, hi)
        got = [r[0] for r in df.orderBy("day").select(F.sum("v").over(w)).collect()]
        assert got == want


def test_rolling_mean_and_quantile_match_pandas(spark):
    rng = np.random.default_rng(3)
    vals = [None if rng.random() < 0.15 else float(rng.integers(40, 70)) for _ in range(120)]
    df = _series(spark, vals)
    s = pd.Series(vals, dtype="float64")
    for n, m, center in [(30, 7, True), (8, 3, True), (6, 2, False), (7, 7, True)]:
        got = [r[0] for r in df.orderBy("day").select(W.rolling_mean("v", n, m, center=center)).collect()]
        want = s.rolling(n, min_periods=m, center=center).mean().tolist()
        assert np.allclose(np.array(got, dtype=float), np.array(want), equal_nan=True)
    got = [r[0] for r in df.orderBy("day").select(W.rolling_quantile("v", 0.25, 30, 7)).collect()]
    want = s.rolling(30, min_periods=7, center=True).quantile(0.25).tolist()
    assert np.allclose(np.array(got, dtype=float), np.array(want), equal_nan=True)


def test_lead_row_based_and_strict(spark):
    rows = [(0, D(2024, 1, d), float(d)) for d in (1, 2, 5)]
    df = spark.createDataFrame(rows, "subject_id long, day date, v double")
    got = [(r[0], r[1]) for r in df.orderBy("day").select(W.lead_one("v"), W.lead_one("v", strict_days=True)).collect()]
    assert got == [(2.0, 2.0), (5.0, None), (None, None)]


def test_week_resample_sum_and_mean(spark):
    rows = [(0, D(2024, 1, 1), 1.0), (0, D(2024, 1, 7), 2.0), (0, D(2024, 1, 8), 3.0), (0, D(2024, 1, 29), 4.0)]
    df = spark.createDataFrame(rows, "subject_id long, day date, v double")
    s = C.resample(df, "week", sums=["v"]).orderBy("period").collect()
    assert [(r.period, r.v) for r in s] == [(D(2024, 1, 7), 3.0), (D(2024, 1, 14), 3.0), (D(2024, 1, 21), 0.0),
                                           (D(2024, 1, 28), 0.0), (D(2024, 2, 4), 4.0)]
    m = C.resample(df, "week", means=["v"]).orderBy("period").collect()
    assert [r.v for r in m] == [1.5, 3.0, None, None, 4.0]
    pdf = pd.DataFrame({"d": pd.to_datetime([r[1] for r in rows]), "v": [r[2] for r in rows]}).set_index("d")
    assert pdf.resample("W")["v"].sum().tolist() == [r.v for r in s]


def test_month_resample_spine_handles_month_ends(spark):
    rows = [(0, D(2024, 1, 31), 1.0), (0, D(2024, 4, 2), 2.0)]
    df = spark.createDataFrame(rows, "subject_id long, day date, v double")
    got = [(r.period, r.v) for r in C.resample(df, "month", means=["v"]).orderBy("period").collect()]
    assert got == [(D(2024, 1, 31), 1.0), (D(2024, 2, 29), None), (D(2024, 3, 31), None), (D(2024, 4, 30), 2.0)]


def test_missing_days_and_coverage(spark):
    rows = [(0, D(2024, 1, d), 1.0) for d in (1, 2, 5)] + [(1, D(2024, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "subject_id long, day date, v double")
    miss = sorted((r.subject_id, r.day) for r in C.missing_days(df).collect())
    assert miss == [(0, D(2024, 1, 3)), (0, D(2024, 1, 4))]
    cov = {r.subject_id: r for r in C.coverage(df).collect()}
    assert (cov[0].days_present, cov[0].span_days, cov[0].days_missing) == (3, 5, 2)
    assert cov[1].pct_covered == 100.0


def test_grid_pivot_reindexed(spark):
    rows = [(0, D(2024, 1, 1), 50.0, 0, 1), (0, D(2024, 1, 2), 52.0, 1, 1)]
    df = spark.createDataFrame(rows, "subject_id long, day date, resting_hr double, weekday_no int, month int")
    g = C.grid_pivot(df, "resting_hr", labels=["mon", "tue", "wed", "thu", "fri", "sat", "sun"]).collect()
    assert len(g) == 12
    jan = [r for r in g if r.month == 1][0]
    assert (jan.mon, jan.tue, jan.wed) == (50.0, 52.0, None)
