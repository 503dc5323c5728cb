"""Streaming jobs (T01-T03) and API payload extraction."""

import datetime as dt
import json
import os
import uuid

from pyspark.sql import functions as F

from cardiolake.operators import api_extract as AX
from cardiolake.operators.upsert import TableStore
from cardiolake.sources.api_payloads import read_payloads
from cardiolake.streaming import jobs as J

D = dt.date


def test_daily_hr_stream_equals_batch_on_emitted_days(spark, tmpdir_path):
    rows = [(s, dt.datetime(2024, 1, d, h), 40 + (d * 7 + h * 3 + s) % 60)
            for s in (0, 1) for d in range(1, 11) for h in range(0, 24, 3)]
    src = os.path.join(tmpdir_path, "samples")
    spark.createDataFrame(rows, "subject_id long, ts timestamp, hr int").write.parquet(src)
    stream = spark.readStream.schema("subject_id long, ts timestamp, hr int").parquet(src)
    out = J.daily_hr_stream(spark, stream, os.path.join(tmpdir_path, "out"), name=uuid.uuid4().hex)
    got = {(r.subject_id, r.day): r for r in out.collect()}
    # max event 01-10 21:00, watermark 2 days -> windows ending by 01-08 21:00 are emitted
    assert sorted({d for _, d in got}) == [D(2024, 1, d) for d in range(1, 8)]
    batch = J.daily_hr_aggregate(spark.read.parquet(src)).collect()
    for b in batch:
        if (b.subject_id, b.day) in got:
            g = got[(b.subject_id, b.day)]
            assert (g.resting_hr, g.hr_mean, g.hr_max, g.n_samples) == (b.resting_hr, b.hr_mean, b.hr_max, b.n_samples)


def test_file_stream_runs_once_per_file(spark, tmpdir_path):
    inbox = os.path.join(tmpdir_path, "inbox")
    os.makedirs(inbox)
    with open(os.path.join(inbox, "activity-2024-01-15.json"), "w") as f:
        json.dump({"date": "2024-01-15", "summary": {"stepCount": 100}}, f)
    store = TableStore(spark, os.path.join(tmpdir_path, "tables"))
    name = uuid.uuid4().hex
    r1 = J.file_stream(spark, inbox, store, name=name)
    assert sum(r["new"] for r in r1) == 1 and store.read("activity").collect()[0].steps == 100
    r2 = J.file_stream(spark, inbox, store, name=name)
    assert r2 == []  # the stream checkpoint already saw the file
    with open(os.path.join(inbox, "activity-2024-01-16.json"), "w") as f:
        json.dump({"date": "2024-01-16", "summary": {"stepCount": 5}}, f)
    r3 = J.file_stream(spark, inbox, store, name=name)
    assert sum(r["new"] for r in r3) == 1 and store.read("activity").count() == 2
    # subject taken from a subject_id=<n> directory
    sub = os.path.join(tmpdir_path, "inbox2", "subject_id=7")
    os.makedirs(sub)
    with open(os.path.join(sub, "activity-2024-01-17.json"), "w") as f:
        json.dump({"date": "2024-01-17", "summary": {"stepCount": 9}}, f)
    J.file_stream(spark, os.path.join(tmpdir_path, "inbox2", "*"), store, name=uuid.uuid4().hex)
    assert store.read("activity").where("subject_id = 7").count() == 1


def _land(root, endpoint, payloads):
    d = os.path.join(root, endpoint)
    os.makedirs(d, exist_ok=True)
    for i, p in enumerate(payloads):
        with open(os.path.join(d, f"{i}.json"), "w") as f:
            json.dump(p, f)


def test_api_payloads(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing")
    _land(root, "activity", [{"date": "2024-01-15", "steps": 9000, "calories": 2100.5, "active-calories": 500},
                             {"date": "2024-01-16"}])
    _land(root, "sleep", [{"nights": [{"date": "2024-01-15", "total_sleep_minutes": 450, "continuous_rating": 4}]}])
    _land(root, "exercise", [
        {"start-time": "2024-01-15T10:00:00", "sport": "OTHER", "detailed-sport-info": "mobility_dynamic",
         "duration": "PT45M", "distance": 0},
        {"start-time": "2024-01-16T10:00:00", "sport": "TREADMILL_RUNNING", "duration": "PT1H",
         "distance": 10000, "heart-rate": {"average": 150, "maximum": 0}},
        {"start-time": "2024-01-17T10:00:00", "sport": "WALKING", "duration": "PT30M", "distance": 4000},
    ])
    _land(root, "physical_info", [{"created": "2024-01-20T08:00:00"}, {"weight": 70}])
    _land(root, "nightly_recharge", [{"recharges": [{"date": "2024-01-15", "ans-charge": 3.2, "hrv-avg": 45.0}]}])
    act = AX.api_activity(read_payloads(spark, root, "activity"))
    slp = AX.api_sleep(read_payloads(spark, root, "sleep"))
    j = {r.day: r for r in AX.activity_with_sleep(act, slp).collect()}
    assert (j[D(2024, 1, 15)].steps, j[D(2024, 1, 15)].met_minutes, j[D(2024, 1, 15)].sleep_hours,
            j[D(2024, 1, 15)].sleep_quality) == (9000, 500.0, 7.5, 4.0)
    assert (j[D(2024, 1, 16)].steps, j[D(2024, 1, 16)].calories, j[D(2024, 1, 16)].sleep_hours) == (0, 0.0, None)
    ex = {r.day: r for r in AX.api_exercise(read_payloads(spark, root, "exercise")).collect()}
    assert (ex[D(2024, 1, 15)].sport, ex[D(2024, 1, 15)].category, ex[D(2024, 1, 15)].distance_km) == \
        ("MOBILITY_DYNAMIC", "INDOOR", None)
    t = ex[D(2024, 1, 16)]
    assert (t.sport, t.category, t.duration_min, t.hr_avg, t.hr_max, t.distance_km) == \
        ("RUNNING", "TREADMILL", 60.0, 150.0, None, 10.0)
    assert (ex[D(2024, 1, 17)].sport, ex[D(2024, 1, 17)].category) == ("RUNNING", "OUTDOOR")
    pi = {r.day for r in AX.api_physical_info(read_payloads(spark, root, "physical_info"), "2024-02-01").collect()}
    assert pi == {D(2024, 1, 20), D(2024, 2, 1)}
    rc = AX.api_recharge(read_payloads(spark, root, "nightly_recharge")).collect()
    assert [(r.file_name, r.category, r.day) for r in rc] == [("nightly_recharge_2024-01-15", "nightly_recharge",
                                                               D(2024, 1, 15))]
    assert json.loads(rc[0].json_data)["hrv-avg"] == 45.0


def test_payload_stream_upserts(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing2")
    _land(root, "exercise", [{"start-time": "2024-01-15T10:00:00", "sport": "CYCLING", "duration": "PT1H",
                              "distance": 30000}])
    store = TableStore(spark, os.path.join(tmpdir_path, "tables2"))
    c = J.payload_stream(spark, root, "exercise", store, name=uuid.uuid4().hex)
    assert c[0]["inserted"] == 1
    t = store.read("training").collect()[0]
    assert (t.sport, t.category, t.distance_km) == ("CYCLING", "OUTDOOR", 30.0)
    assert store.read("training").where(F.col("day") == D(2024, 1, 15)).count() == 1


def test_payload_stream_keeps_sessions_subjects_sleep_and_text_numbers(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing3")
    store = TableStore(spark, os.path.join(tmpdir_path, "tables3"))
    for subject in (7, 8):
        _land(root, f"exercise/subject_id={subject}", [
            {"start-time": "2024-01-15T07:00:00", "sport": "RUNNING", "duration": "PT1H", "distance": "5000.0",
             "calories": "300", "heart-rate": {"average": "140", "maximum": 170}},
            {"start-time": "2024-01-15T18:00:00", "sport": "CYCLING", "duration": "PT2H", "distance": 1000},
            {"start-time": "15.01.2024", "sport": "RUNNING"}])
    J.payload_stream(spark, root, "exercise", store, name=uuid.uuid4().hex)
    t = {(r.subject_id, r.start_ts.hour): r for r in store.read("training").collect()}
    assert set(t) == {(7, 7), (7, 18), (8, 7), (8, 18)}
    r = t[(7, 7)]
    assert (r.distance_km, r.calories, r.hr_avg, r.hr_max) == (5.0, 300.0, 140.0, 170.0)
    # a night, then its day without sleep, then a day with a date of another form
    _land(root, "sleep/subject_id=7", [{"nights": [{"date": "2024-01-15", "total_sleep_minutes": "420"}]}])
    J.payload_stream(spark, root, "sleep", store, name=uuid.uuid4().hex)
    _land(root, "activity/subject_id=7", [{"date": "2024-01-15", "steps": 9000}, {"date": "15.01.2024", "steps": 1}])
    J.payload_stream(spark, root, "activity", store, name=uuid.uuid4().hex)
    assert [(r.subject_id, r.steps, r.sleep_hours) for r in store.read("activity").collect()] == [(7, 9000, 7.0)]


def test_file_stream_reads_archives(spark, tmpdir_path):
    import zipfile

    inbox = os.path.join(tmpdir_path, "zips", "subject_id=5")
    os.makedirs(inbox)
    with zipfile.ZipFile(os.path.join(inbox, "export.zip"), "w") as z:
        z.writestr("activity-2024-01-15.json", json.dumps({"date": "2024-01-15", "summary": {"stepCount": 12}}))
        z.writestr("readme.txt", "no")
    store = TableStore(spark, os.path.join(tmpdir_path, "tables4"))
    r = J.file_stream(spark, os.path.join(tmpdir_path, "zips", "*"), store, name=uuid.uuid4().hex)
    assert sum(x["new"] for x in r) == 1
    assert [(x.subject_id, x.steps) for x in store.read("activity").collect()] == [(5, 12)]
