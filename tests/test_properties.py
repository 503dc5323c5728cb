"""Properties that must hold on any input, on the sf0.001 tables."""

import os

import pytest
from pyspark.sql import functions as F

from cardiolake.operators import calendar as C, daily, upsert as UP
from cardiolake.plans import adapters as A

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def test_daily_metric_properties(spark):
    hr = daily.daily_hr(A.hr_samples_lines(spark, SF), digits=None)
    bad = hr.where((F.col("resting_hr") > F.col("hr_mean")) | (F.col("hr_mean") > F.col("hr_max"))).count()
    assert hr.count() > 0 and bad == 0
    hrv = daily.daily_hrv(A.ppi_samples_events(spark, SF), digits=None, mean_digits=None, hr_digits=None)
    assert hrv.where((F.col("rmssd") < 0) | (F.col("sdnn") < 0) | (F.col("n_samples") < 5)).count() == 0


def test_coverage_adds_up(spark):
    act = A.activity_orders(spark, SF)
    cov = C.coverage(act)
    miss = C.missing_days(act).groupBy("subject_id").agg(F.count(F.lit(1)).alias("m"))
    j = cov.join(miss, "subject_id", "left").na.fill({"m": 0}).collect()
    assert j and all(r.days_present + r.m == r.span_days and r.days_missing == r.m for r in j)


def test_merge_counts_add_up(spark):
    act = A.activity_orders(spark, SF)
    tgt = act.where(F.dayofmonth("day") > 10)
    src = act.unionByName(act.limit(5))  # duplicate keys in the source
    m = UP.merge_plan(tgt, src, ["subject_id", "day"], ["steps", "calories", "sleep_hours"])
    c = UP.merge_counts(m).collect()[0]
    n_src_keys = src.select("subject_id", "day").distinct().count()
    assert c.inserted + c.updated + c.unchanged == n_src_keys
    assert c.kept == tgt.join(src, ["subject_id", "day"], "left_anti").count()
    assert m.count() == c.inserted + c.updated + c.unchanged + c.kept
