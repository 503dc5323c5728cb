"""Scans, date helpers, table creation, insert-only, fit line, KPIs, API durations."""

import datetime as dt
import os

from pyspark.sql import functions as F

from cardiolake import schemas as S
from cardiolake.functions import (add_seconds, date_range_predicate, label_at, lookback_window,
                                  month_start_key, null_or_default)
from cardiolake.operators import aggregate as AG, incremental as INC, stats as ST, upsert as UP
from cardiolake.sources import tables as TB

D = dt.date


def _training(spark):
    rows = [(0, D(2024, 1, d), "RUNNING" if d % 2 else "Cycling", "OUTDOOR", 30.0, 140.0, 170.0, 5.0, 300.0,
             "Monday", 2024) for d in range(1, 11)]
    return spark.createDataFrame(rows, "subject_id long, day date, sport string, category string, "
                                       "duration_min double, hr_avg double, hr_max double, distance_km double, "
                                       "calories double, weekday string, year int")


def test_scans_and_adhoc_sql(spark):
    tr = _training(spark)
    got = TB.scan_training(tr, start="2024-01-03", end="2024-01-07", sport="running").collect()
    assert [r.day.day for r in got] == [3, 5, 7]
    assert TB.scan_training(tr, end="2024-01-02").count() == 2
    assert TB.scan_training(tr, sport="CYCLING").count() == 5
    out = TB.adhoc_sql(spark, "SELECT count(*) AS n FROM t WHERE day >= :d", {"d": D(2024, 1, 9)}, t=tr).collect()
    assert out[0].n == 2
    try:
        TB.adhoc_sql(spark, "SELECT nope FROM t", t=tr).collect()
        raised = False
    except Exception:  # noqa: BLE001
        raised = True
    assert raised  # errors raise instead of returning an empty frame


def test_date_and_label_helpers(spark):
    df = spark.createDataFrame([(D(2024, 1, 10), 3, None)], "d date, i int, x double")
    r = df.select(
        date_range_predicate("d", "2024-01-10", None).alias("a"),
        date_range_predicate("d", None, "2024-01-09").alias("b"),
        lookback_window("d", "2024-02-01", 28).alias("c"),
        lookback_window("d", "2024-02-01", 21).alias("c2"),
        month_start_key(F.lit(2024), F.lit(2)).alias("m"),
        label_at(["Mo", "Di", "Mi", "Do"], "i").alias("lab"),
        null_or_default("x", 0).alias("z"),
        add_seconds(F.lit("2024-01-10 00:00:00").cast("timestamp"), F.lit(3661)).alias("ts"),
    ).collect()[0]
    assert (r.a, r.b, r.c, r.c2, r.m, r.lab, r.z) == (True, False, True, False, D(2024, 2, 1), "Do", 0.0)
    assert r.ts == dt.datetime(2024, 1, 10, 1, 1, 1)


def test_create_tables_and_not_null(spark, tmpdir_path):
    store = UP.TableStore(spark, os.path.join(tmpdir_path, "t"))
    made = store.create_tables()
    assert set(made) == set(S.TABLES) - S.BUCKETED_TABLES and store.create_tables() == []
    assert store.read("import_log", S.IMPORT_LOG).count() == 0  # bucketed: created by the first merge
    got = [(f.name, f.dataType) for f in store.read("activity").schema.fields]
    assert got == [(f.name, f.dataType) for f in S.ACTIVITY.fields]  # Parquet reads all as nullable
    assert store.check_not_null("activity", S.ACTIVITY).count() == 0


def test_insert_only_and_known_days(spark):
    tgt = spark.createDataFrame([(0, D(2024, 1, 1), 1)], "subject_id long, day date, v int")
    src = spark.createDataFrame([(0, D(2024, 1, 1), 2), (0, D(2024, 1, 2), 3)], "subject_id long, day date, v int")
    assert [r.v for r in UP.insert_only(tgt, src, ["subject_id", "day"]).collect()] == [3]
    assert [r.v for r in INC.known_days_removed(src, tgt).collect()] == [3]


def test_fit_line_and_kpis(spark):
    st = spark.createDataFrame([(0, 2.0, 1.0, 0.0, 10.0)], "subject_id long, slope double, intercept double, "
                                                          "lo double, hi double")
    pts = ST.fit_line(st, "lo", "hi", points=5).orderBy("i").collect()
    assert [(p.x, p.y) for p in pts] == [(0.0, 1.0), (2.5, 6.0), (5.0, 11.0), (7.5, 16.0), (10.0, 21.0)]
    act = spark.createDataFrame([(0, D(2020, 1, 1), 1000, 7.0), (0, D(2021, 1, 1), 3000, None)],
                                "subject_id long, day date, steps long, sleep_hours double")
    hr = spark.createDataFrame([(0, D(2020, 1, 1), 50.0)], "subject_id long, day date, resting_hr double")
    k = AG.kpis(act, hr, _training(spark)).collect()[0]
    assert (round(k.years, 3), k.steps_avg, k.sleep_avg, k.resting_hr_avg, k.sessions, k.runs) == \
        (1.002, 2000.0, 7.0, 50.0, 10, 5)  # 366 days / 365.25


def test_preview_and_distinct(spark):
    from cardiolake.operators import topk as TK
    tr = _training(spark)
    assert [r.day.day for r in TK.preview(tr, 3, ["day"]).collect()] == [1, 2, 3]
    assert [r.year for r in TK.distinct_values(tr, ["year"]).collect()] == [2024]
