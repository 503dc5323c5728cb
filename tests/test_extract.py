"""Extraction of export documents (cases from FIXTURES.md)."""

import datetime as dt
import json
import re

from pyspark.sql import functions as F

from cardiolake import schemas as S
from cardiolake.operators import daily, extract as X
from cardiolake.sources import json_docs as JD
from tests.helpers import files_df

D = dt.date


def parse(spark, docs, schema):
    return JD.good(JD.parse_documents(files_df(spark, docs), schema))


def test_activity(spark):
    docs = [
        ("activity-2024-01-15.json", json.dumps({"date": "2024-01-15", "summary": {
            "stepCount": 8421, "calories": 2310.5, "sleepDuration": "PT25200S", "sleepQuality": 0.82,
            "dailyMetMinutes": 410.0}})),
        ("activity-nodate.json", json.dumps({"summary": {"stepCount": 1}})),
        ("activity-2024-01-16.json", json.dumps({"date": "2024-01-16", "summary": {"stepCount": "12", "sleepDuration": ""}})),
        ("activity-2024-01-17.json", json.dumps({"date": "2024-01-17", "summary": {"stepCount": "1.5", "sleepDuration": "PT0S"}})),
        ("activity-2024-01-18-a.json", json.dumps({"date": "2024-01-18", "summary": {"stepCount": 5}})),
        ("activity-2024-01-18-b.json", json.dumps({"date": "2024-01-18", "summary": {"stepCount": 6}})),
    ]
    rows = {r["day"]: r for r in X.flatten_activity(parse(spark, docs, S.ACTIVITY_DOC)).collect()}
    assert len(rows) == 4
    r = rows[D(2024, 1, 15)]
    assert (r.steps, r.calories, r.sleep_hours, r.sleep_quality, r.met_minutes) == (8421, 2310.5, 7.0, 0.82, 410.0)
    assert rows[D(2024, 1, 16)].steps == 12 and rows[D(2024, 1, 16)].sleep_hours is None
    assert rows[D(2024, 1, 17)].steps is None and rows[D(2024, 1, 17)].sleep_hours is None
    assert rows[D(2024, 1, 18)].steps == 5  # first file name wins


def _training(spark, docs):
    return X.explode_training(parse(spark, docs, S.TRAINING_DOC)).orderBy("file_name", "ordinal").collect()


def test_training_exercise_rules(spark):
    base = {"startTime": "2024-01-15T23:30:00+02:00", "sport": "RUNNING", "name": "Abend",
            "durationMillis": 3600000, "distanceMeters": 9000, "calories": 600, "hrAvg": 140, "hrMax": 171}
    ex = {"sport": {"id": 4}, "durationMillis": 1800000, "duration": "PT30M", "distanceMeters": 4000,
          "calories": 280, "heartRate": {"average": 128, "maximum": 150}}
    docs = [
        ("training-a.json", json.dumps({**base, "exercises": [ex]})),
        ("training-b.json", json.dumps({**base, "exercises": []})),
        ("training-c.json", json.dumps({**base, "exercises": [{**ex, "durationMillis": 0, "calories": 0,
                                                                 "heartRate": {"average": 0}}]})),
        ("training-d.json", json.dumps({**base, "exercises": [{**ex, "durationMillis": 2400000}]})),
        ("training-e.json", json.dumps({**base, "name": "Laufband 5k", "exercises": [ex]})),
        ("training-f.json", json.dumps({**base, "exercises": [{**ex, "sport": {"id": 27}}]})),
        ("training-g.json", json.dumps({**base, "exercises": [{**ex, "sport": {"id": 999}}]})),
        ("training-h.json", json.dumps({**base, "sport": "", "exercises": []})),
        ("training-i.json", json.dumps({**base, "sport": " 'CYCLING' ", "exercises": []})),
        ("training-j.json", json.dumps({**base, "exercises": [ex, {**ex, "sport": {"id": 2}}]})),
        ("training-k.json", json.dumps({**base, "startTime": "2024-01-15T01:30:00+02:00", "exercises": []})),
        ("training-l.json", json.dumps({**base, "startTime": "not a time"})),
    ]
    rows = _training(spark, docs)
    by = {}
    for r in rows:
        by.setdefault(r.file_name, []).append(r)
    a = by["training-a.json"][0]
    assert a.day == D(2024, 1, 15) and a.sport == "RUNNING" and a.category == "OUTDOOR"
    assert (a.duration_min, a.distance_km, a.hr_avg, a.hr_max, a.calories) == (30.0, 4.0, 128.0, 150.0, 280.0)
    assert a.weekday == "Monday" and a.year == 2024
    b = by["training-b.json"][0]
    assert (b.sport, b.category, b.duration_min, b.distance_km, b.hr_avg) == ("RUNNING", "OUTDOOR", 60.0, 9.0, 140.0)
    c = by["training-c.json"][0]  # 0 falls back to the session values
    assert (c.duration_min, c.calories, c.hr_avg, c.hr_max) == (60.0, 600.0, 140.0, 171.0)
    d = by["training-d.json"][0]  # 40 min / 4 km = pace 10 exactly: stays HIKING
    assert (d.sport, d.category) == ("HIKING", "OUTDOOR")
    assert by["training-e.json"][0].category == "TREADMILL"
    f = by["training-f.json"][0]
    assert (f.sport, f.category) == ("RUNNING", "TRAIL")
    assert by["training-g.json"][0].sport == "ID_999" and by["training-g.json"][0].category is None
    assert by["training-h.json"][0].sport == "UNKNOWN"
    assert by["training-i.json"][0].sport == "CYCLING"
    assert [r.sport for r in by["training-j.json"]] == ["RUNNING", "CYCLING"]
    assert [r.ordinal for r in by["training-j.json"]] == [0, 1]
    assert by["training-k.json"][0].day == D(2024, 1, 14)  # UTC 23:30 the day before
    assert "training-l.json" not in by


def test_hr_samples_and_daily(spark):
    docs = [
        ("247ohr_1.json", json.dumps({"deviceDays": [{"date": "2024-01-15", "samples": [
            {"heartRate": 40}, {"heartRate": 19}, {"heartRate": 20}, {"heartRate": 0}, {"heartRate": 251}]}]})),
        ("247ohr_2.json", json.dumps({"deviceDays": [{"date": "2024-01-15", "samples": [
            {"heartRate": 50}, {"heartRate": 60}, {"heartRate": 71}, {"heartRate": 250}]},
            {"date": "2024-01-16", "samples": [{"heartRate": 5}]}]})),
    ]
    s = X.explode_hr_samples(parse(spark, docs, S.HR_DOC))
    assert sorted(r.hr for r in s.collect()) == [20, 40, 50, 60, 71, 250]
    docs2 = [("247ohr_3.json", json.dumps({"deviceDays": [{"date": "2024-01-15", "samples": [
        {"heartRate": v} for v in (40, 50, 60, 71)]}]}))]
    d = daily.daily_hr(X.explode_hr_samples(parse(spark, docs2, S.HR_DOC))).collect()
    assert len(d) == 1
    assert (d[0].resting_hr, d[0].hr_mean, d[0].hr_max, d[0].weekday_no, d[0].month) == (41.5, 55.3, 71, 0, 1)


def test_ppi_hrv(spark):
    five = [{"pulseLength": v} for v in (800, 820, 790, 810, 805)]
    docs = [
        ("ppi_a.json", json.dumps([{"date": "2024-01-15", "devicePpiSamplesList": [{"ppiSamples": five}]}])),
        ("ppi_b.json", json.dumps({"date": "2024-01-16", "devicePpiSamplesList": [{"ppiSamples": five}]})),
        ("ppi_c.json", json.dumps({"date": "2024-01-17", "devicePpiSamplesList": [{"ppiSamples": five[:4]}]})),
        ("ppi_d.json", json.dumps({"date": "2024-01-18", "devicePpiSamplesList": [{"ppiSamples": [
            {"pulseLength": v} for v in (299, 300, 2000, 2001, 1000, 1000, 1000)]}]})),
    ]
    s = X.explode_ppi_samples(parse(spark, docs, S.PPI_DOC))
    h = {r.day: r for r in daily.daily_hrv(s, order=("file_name", "entry", "device", "pos"),
                                           chunk=X.ppi_chunk()).collect()}
    assert set(h) == {D(2024, 1, 15), D(2024, 1, 16), D(2024, 1, 18)}
    r = h[D(2024, 1, 15)]
    assert (r.rmssd, r.sdnn, r.ppi_mean_ms, r.hr_from_ppi, r.n_samples) == (20.77, 11.18, 805.0, 74.5, 5)
    assert h[D(2024, 1, 16)].rmssd == 20.77  # object root
    assert h[D(2024, 1, 18)].n_samples == 5


def test_hrv_chunked_equals_single_window(spark):
    """The chunked successive-difference plan equals a plain window over the day."""
    import random
    rnd = random.Random(7)
    rows = [(0, D(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0) + dt.timedelta(seconds=rnd.randint(0, 7200)), i,
             rnd.randint(600, 1100)) for i in range(3000)]
    df = spark.createDataFrame(rows, "subject_id long, day date, ts timestamp, event_id long, ppi int")
    a = daily.daily_hrv(df, digits=None, mean_digits=None, hr_digits=None).collect()[0]
    pdf = df.toPandas().sort_values(["ts", "event_id"])
    import numpy as np
    v = pdf.ppi.to_numpy(dtype=float)
    assert abs(a.rmssd - float(np.sqrt(np.mean(np.diff(v) ** 2)))) < 1e-9
    assert abs(a.sdnn - float(np.std(v, ddof=1))) < 1e-9
    # order-key chunks on three levels give the same result
    pdf2 = pdf.sort_values("event_id")
    v2 = pdf2.ppi.to_numpy(dtype=float)
    levels = [F.floor(F.col("event_id") / 7), F.floor(F.col("event_id") / 49), F.floor(F.col("event_id") / 343)]
    b = daily.daily_hrv(df, order=("event_id",), chunk=levels, digits=None, mean_digits=None,
                        hr_digits=None).collect()[0]
    assert abs(b.rmssd - float(np.sqrt(np.mean(np.diff(v2) ** 2)))) < 1e-9
    assert b.n_samples == 3000


def test_hrv_of_new_days_has_no_cap(spark):
    rows = [(0, D(2024, 1, 1 + i // 60_000), dt.datetime(2024, 1, 1 + i // 60_000) + dt.timedelta(seconds=i % 60_000), i, 800 + i % 7)
            for i in range(60_100)]
    df = spark.createDataFrame(rows, "subject_id long, day date, ts timestamp, event_id long, ppi int")
    got = {r.day: r.n_samples for r in daily.daily_hrv_new_days(df).collect()}
    assert got == {D(2024, 1, 1): 60_000, D(2024, 1, 2): 100}
    known = df.where("event_id < 60000").select("subject_id", "day")
    assert [r.day for r in daily.daily_hrv_new_days(df, known_days=known).collect()] == [D(2024, 1, 2)]


def test_document_names_keep_wide_ids(spark):
    from cardiolake.plans import documents as DOC

    ids = [5, 600000000001, 600000000099, 2**63 - 1]
    df = spark.createDataFrame([(i,) for i in ids], "event_id long").select(
        F.concat(F.lit("ppi_"), F.lpad(F.col("event_id").cast("string"), DOC.ID_DIGITS, "0"), F.lit(".json")).alias("file_name"))
    rows = df.select("file_name", *[c.alias(f"c{k}") for k, c in enumerate(DOC.ppi_file_chunks())]).collect()
    names = [r.file_name for r in rows]
    assert len(set(names)) == len(ids) and names == sorted(names)
    assert [r.c0[4:].lstrip("0") or "0" for r in rows] == [str(i // 1000) if i >= 1000 else "0" for i in ids]


def test_fitness_best_per_day(spark):
    def doc(own, vo2=None):
        return json.dumps({"startTime": "2024-01-15T08:00:00Z", "fitnessTestResult": {
            "ownIndex": own, "fitnessClass": "GOOD", "physicalInformation": {"birthday": "1980-05-01",
                                                                          "vo2Max": vo2, "sex": "MALE"}}})
    docs = [("fitness-test-results-1.json", doc(None)), ("fitness-test-results-2.json", doc(45, 44)),
            ("fitness-test-results-3.json", doc(40))]
    rows = X.flatten_fitness(parse(spark, docs, S.FITNESS_DOC)).collect()
    assert len(rows) == 1 and rows[0].own_index == 45.0 and rows[0].vo2max == 44.0
    assert rows[0].birthday == D(1980, 5, 1) and rows[0].training_background == ""


def test_keep_document_and_quarantine(spark):
    docs = [("account-1.json", json.dumps([{"a": 1}])),
            ("account-2.json", json.dumps({"startTime": "bad", "created": "2024-03-01T10:00:00Z"})),
            ("account-3.json", "{not json"),
            ("account-4.json", b"\xff\xfe\x00")]
    p = JD.with_parse_error(files_df(spark, docs))
    errs = {r.file_name: r.parse_error for r in p.collect()}
    assert errs == {"account-1.json": None, "account-2.json": None, "account-3.json": "malformed_json",
                    "account-4.json": "invalid_utf8"}
    ok = p.where("parse_error IS NULL").withColumn("text", JD.decode_text("content")) \
        .withColumn("category", F.lit("account"))
    days = {r.file_name: r.day for r in X.keep_document(ok).collect()}
    assert days == {"account-1.json": None, "account-2.json": D(2024, 3, 1)}
    ec = JD.error_counts(files_df(spark, docs)).collect()[0]
    assert (ec.n_files, ec.n_invalid_utf8, ec.n_malformed) == (4, 1, 1)


def test_expand_json_and_typed_projection(spark):
    df = spark.createDataFrame([(1, '{"k": 5, "z": "a"}'), (2, '{"z": "b"}')], "id long, j string")
    out = X.expand_json_column(df, "j", "k int, missing string").orderBy("id").collect()
    assert [(r.id, r.k, r.missing) for r in out] == [(1, 5, None), (2, None, None)]
    t = X.typed_projection(spark.createDataFrame([("2024-01-01", "12", 3)], "day string, steps string, x int"),
                           S.ACTIVITY)
    assert t.columns == [f.name for f in S.ACTIVITY.fields]
    r = t.collect()[0]
    assert r.day == D(2024, 1, 1) and r.steps == 12 and r.calories is None


def test_training_steps_stay_small_enough_to_be_compiled(spark, capsys):
    """The JVM leaves methods above 8,000 bytes uncompiled; the steps after the explode are one method."""
    ex = [{"sport": {"id": "27"}, "duration": "PT2M30S", "heartRate": {"average": "0"}}, None,
          {"durationMillis": "120000", "distance": 500, "distanceMeters": None, "calories": "7"}]
    docs = [("training-a.json", json.dumps({"startTime": "2024-01-15T08:00:00Z", "sport": " 'YOGA' ", "hrAvg": 99, "calories": 5,
                                            "exercises": ex}))]
    t = X.explode_training(parse(spark, docs, S.TRAINING_DOC), round_values=False)
    t.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
    assert [(r.ordinal, r.sport, r.category, r.duration_min, r.hr_avg, r.distance_km, r.calories) for r in t.collect()] == [
        (0, "RUNNING", "TRAIL", 2.5, 99.0, None, 5.0), (1, "YOGA", "INDOOR", None, 99.0, None, 5.0),
        (2, "YOGA", "INDOOR", 2.0, 99.0, 0.5, 7.0)]
