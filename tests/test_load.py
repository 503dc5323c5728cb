"""Upsert semantics, archive source, end-to-end ingest and its idempotence."""

import datetime as dt
import io
import json
import os
import zipfile

from pyspark.sql import functions as F

from cardiolake.operators import upsert as UP
from cardiolake.plans.ingest import Ingest
from cardiolake.sources import archive as AR

D = dt.date
SCHEMA = "subject_id long, day date, steps long, calories double, note string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_merge_plan_cases(spark):
    tgt = _df(spark, [(0, D(2024, 1, 1), 10, 1.0, "a"),      # equal row
                      (0, D(2024, 1, 2), 10, 1.0, "a"),      # watched differs
                      (0, D(2024, 1, 3), 10, 1.0, "a"),      # only unwatched differs
                      (0, D(2024, 1, 4), None, 1.0, "a"),    # target NULL vs value
                      (0, D(2024, 1, 5), 10, 1.0, "a")])     # not in source -> kept
    src = _df(spark, [(0, D(2024, 1, 1), 10, 1.0, "a"), (0, D(2024, 1, 2), 11, 1.0, "a"),
                      (0, D(2024, 1, 3), 10, 1.0, "zzz"), (0, D(2024, 1, 4), 7, 1.0, "a"),
                      (0, D(2024, 1, 6), 1, 1.0, "new"), (0, D(2024, 1, 6), 2, 1.0, "dup")])
    keys = ["subject_id", "day"]
    m = {r.day.day: r for r in UP.merge_plan(tgt, src, keys, ["steps", "calories"]).collect()}
    assert {d: m[d]._action for d in m} == {1: "unchanged", 2: "updated", 3: "unchanged", 4: "unchanged",
                                           5: "kept", 6: "inserted"}
    assert m[2].steps == 11 and m[3].note == "a" and m[4].steps is None and m[6].steps == 1
    ns = {r.day.day: r._action for r in UP.merge_plan(tgt, src, keys, ["steps"], null_safe=True).collect()}
    assert ns[4] == "updated"
    always = {r.day.day: r._action for r in UP.merge_plan(tgt, src, keys, None).collect()}
    assert always[1] == "updated" and always[3] == "updated"
    ins = {r.day.day: r._action for r in UP.merge_plan(tgt, src, keys, []).collect()}
    assert ins[2] == "unchanged" and ins[6] == "inserted"
    c = UP.merge_counts(UP.merge_plan(tgt, src, keys, ["steps", "calories"])).collect()[0]
    assert (c.inserted, c.updated, c.unchanged, c.kept) == (1, 1, 3, 1)


def test_table_store_versions(spark, tmpdir_path):
    store = UP.TableStore(spark, os.path.join(tmpdir_path, "tables"))
    src = _df(spark, [(0, D(2024, 1, 1), 10, 1.0, "a")])
    assert store.upsert("t", src, ["subject_id", "day"], ["steps"])["inserted"] == 1
    again = store.upsert("t", src, ["subject_id", "day"], ["steps"])
    assert again["inserted"] == 0 and again["unchanged"] == 1
    assert store.current_path("t").endswith("v=1") and store.read("t").count() == 1


def _fixture_docs():
    hr = lambda d, vals: json.dumps({"deviceDays": [{"date": d, "samples": [{"heartRate": v} for v in vals]}]})
    return {
        "activity-2024-01-15.json": json.dumps({"date": "2024-01-15", "summary": {"stepCount": 8421,
                                                "sleepDuration": "PT25200S"}}),
        "training-session-1.json": json.dumps({"startTime": "2024-01-15T07:00:00Z", "sport": "RUNNING",
                                               "durationMillis": 1800000, "distanceMeters": 5000}),
        "247ohr_a.json": hr("2024-01-15", [40, 50]),
        "247ohr_b.json": hr("2024-01-15", [60, 71]),
        "ppi_1.json": json.dumps([{"date": "2024-01-15", "devicePpiSamplesList": [{"ppiSamples": [
            {"pulseLength": v} for v in (800, 820, 790, 810, 805)]}]}]),
        "fitness-test-results-1.json": json.dumps({"startTime": "2024-01-15T08:00:00Z",
                                                   "fitnessTestResult": {"ownIndex": 45}}),
        "account-data.json": json.dumps({"created": "2020-05-05T00:00:00Z"}),
        "broken.json": "{nope",
    }


def _zip(path, docs):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for n, t in docs.items():
            z.writestr(n, t)
        z.writestr("readme.txt", "not json")
    with open(path, "wb") as f:
        f.write(buf.getvalue())


def test_archive_ingest_idempotent_and_affected_days(spark, tmpdir_path):
    inbox = os.path.join(tmpdir_path, "inbox", "subject_id=3")
    os.makedirs(inbox)
    docs = _fixture_docs()
    _zip(os.path.join(inbox, "export1.zip"), docs)
    files = AR.archive_source(spark, os.path.join(tmpdir_path, "inbox"))
    assert files.count() == len(docs)
    assert set(r.subject_id for r in files.collect()) == {3}
    summary = {r.category: r.n_files for r in AR.archive_summary(files).collect()}
    assert summary[None] == len(docs) and summary["heartrate"] == 2
    listing = AR.archive_listing(spark, os.path.join(tmpdir_path, "inbox")).collect()
    assert len(listing) == 1 and listing[0].size_mb >= 0

    store = UP.TableStore(spark, os.path.join(tmpdir_path, "tables"))
    rep1 = Ingest(spark, store, "2024-02-01 00:00:00").run(files)
    assert (rep1["new"], rep1["changed"], rep1["unchanged"], rep1["errors"]) == (8, 0, 0, 1)
    hr = store.read("heartrate").collect()
    assert len(hr) == 1 and hr[0].resting_hr == 41.5 and hr[0].hr_max == 71
    assert store.read("activity").collect()[0].steps == 8421
    assert store.read("training").collect()[0].sport == "RUNNING"
    assert store.read("hrv").collect()[0].rmssd == 20.77
    assert store.read("fitness_tests").collect()[0].own_index == 45.0
    raw = store.read("raw_documents").collect()
    assert [(r.file_name, r.day) for r in raw] == [("account-data.json", D(2020, 5, 5))]
    assert store.read("import_log").count() == 8

    rep2 = Ingest(spark, store).run(AR.archive_source(spark, os.path.join(tmpdir_path, "inbox")))
    assert (rep2["new"], rep2["changed"], rep2["unchanged"]) == (0, 0, 8)

    # one HR file changes: the day is re-aggregated from both files
    # (heart-rate rows update only when the resting HR differs, as in the source's merge)
    docs2 = dict(docs)
    docs2["247ohr_b.json"] = json.dumps({"deviceDays": [{"date": "2024-01-15", "samples": [
        {"heartRate": 30}, {"heartRate": 35}]}]})
    os.makedirs(os.path.join(tmpdir_path, "inbox2", "subject_id=3"))
    _zip(os.path.join(tmpdir_path, "inbox2", "subject_id=3", "export2.zip"), docs2)
    rep3 = Ingest(spark, store).run(AR.archive_source(spark, os.path.join(tmpdir_path, "inbox2")))
    assert (rep3["new"], rep3["changed"], rep3["unchanged"]) == (0, 1, 7)
    hr = store.read("heartrate").collect()
    assert len(hr) == 1 and hr[0].hr_max == 50 and hr[0].resting_hr == 30.8
    assert hr[0].hr_mean == 38.8  # (30 + 35 + 40 + 50) / 4 = 38.75: both files of the day

    # the file moves to another day: its old day keeps only the other file's samples
    docs3 = dict(docs2)
    docs3["247ohr_b.json"] = json.dumps({"deviceDays": [{"date": "2024-01-16", "samples": [
        {"heartRate": 30}, {"heartRate": 35}]}]})
    os.makedirs(os.path.join(tmpdir_path, "inbox3", "subject_id=3"))
    _zip(os.path.join(tmpdir_path, "inbox3", "subject_id=3", "export3.zip"), docs3)
    ing = Ingest(spark, store)
    rep4 = ing.run(AR.archive_source(spark, os.path.join(tmpdir_path, "inbox3")))
    assert rep4["changed"] == 1
    silver = ing.read_silver("hr_samples")
    by_day = {}
    for r in silver.collect():
        by_day.setdefault(r.day, []).append(r.hr)
    assert sorted(by_day[D(2024, 1, 15)]) == [40, 50] and sorted(by_day[D(2024, 1, 16)]) == [30, 35]
    hr = {r.day: r for r in store.read("heartrate").collect()}
    assert hr[D(2024, 1, 15)].hr_max == 50 and hr[D(2024, 1, 16)].hr_max == 35


def test_folder_source(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "folder")
    os.makedirs(d)
    for n, t in _fixture_docs().items():
        with open(os.path.join(d, n), "w") as f:
            f.write(t)
    files = AR.folder_source(spark, d, default_subject=1)
    assert files.count() == 8 and files.where(F.col("subject_id") == 1).count() == 8
    assert AR.route_by_name(files, "heartrate").count() == 2


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, tmpdir_path):
    import glob
    store = UP.TableStore(spark, os.path.join(tmpdir_path, "b"))
    schema = "subject_id long, file_name string, hash_md5 string"
    rows = [(s, f"f{s}_{i}.json", "h") for s in range(4) for i in range(3)]
    c1 = store.upsert_bucketed("log", spark.createDataFrame(rows, schema), ["subject_id", "file_name"], None, n_buckets=8)
    assert c1["inserted"] == 12
    before = {p: os.path.getmtime(p) for p in glob.glob(os.path.join(tmpdir_path, "b", "log", "current", "_bucket=*", "*.parquet"))}
    change = spark.createDataFrame([(1, "f1_0.json", "h2"), (1, "f1_9.json", "h")], schema)
    c2 = store.upsert_bucketed("log", change, ["subject_id", "file_name"], None, n_buckets=8)
    assert (c2["inserted"], c2["updated"], c2["kept"]) == (1, 1, 2)  # kept: other files of subject 1
    after = {p: os.path.getmtime(p) for p in glob.glob(os.path.join(tmpdir_path, "b", "log", "current", "_bucket=*", "*.parquet"))}
    untouched = [p for p in before if p in after and after[p] == before[p]]
    assert len(untouched) >= len(before) - 2  # only subject 1's bucket was rewritten
    t = store.read("log")
    assert t.count() == 13 and "_bucket" not in t.columns
    assert t.where("file_name = 'f1_0.json'").first().hash_md5 == "h2"


def _load(spark, store, docs, name, base, subject=3):
    """One archive with ``docs`` in a folder of its own -> run of the load."""
    folder = os.path.join(base, name, f"subject_id={subject}")
    os.makedirs(folder)
    _zip(os.path.join(folder, f"{name}.zip"), docs)
    return Ingest(spark, store).run(AR.archive_source(spark, os.path.join(base, name)))


def _hr(day, values):
    return json.dumps({"deviceDays": [{"date": day, "samples": [{"heartRate": v, "secondsFromDayStart": 1.5}
                                                                for v in values]}]})


def test_entries_repeated_by_archives_count_once_newest_wins(spark, tmpdir_path):
    docs = _fixture_docs()
    inbox = os.path.join(tmpdir_path, "in", "subject_id=3")
    os.makedirs(inbox)
    ppi = {"ppi_1.json": docs["ppi_1.json"]}
    act = lambda n: {"activity-2024-01-15.json": json.dumps({"date": "2024-01-15", "summary": {"stepCount": n}})}
    _zip(os.path.join(inbox, "z_old.zip"), {**ppi, **act(1)})
    _zip(os.path.join(inbox, "a_new.zip"), {**ppi, **act(2)})
    os.utime(os.path.join(inbox, "z_old.zip"), (1_700_000_000, 1_700_000_000))
    store = UP.TableStore(spark, os.path.join(tmpdir_path, "t"))
    rep = Ingest(spark, store).run(AR.archive_source(spark, os.path.join(tmpdir_path, "in")))
    assert (rep["new"], rep["errors"]) == (2, 0)
    hrv = store.read("hrv").collect()
    assert [(r.n_samples, r.rmssd) for r in hrv] == [(5, 20.77)]
    assert store.read("activity").first().steps == 2
    runs = store.read("import_runs").collect()
    assert len(runs) == 1 and runs[0].n_new == 2 and runs[0].seconds > 0


def test_only_file_of_a_day_moves_and_numbers_of_any_form_load(spark, tmpdir_path):
    store = UP.TableStore(spark, os.path.join(tmpdir_path, "t"))
    fit = json.dumps({"startTime": "2024-01-15T08:00:00Z", "fitnessTestResult": {
        "ownIndex": 45, "physicalInformation": {"maximumHeartRate": 180.5, "sleepGoal": 28800000}}})
    rep = _load(spark, store, {"247ohr_a.json": _hr("2024-01-15", [40, 50]), "fitness-test-results-1.json": fit}, "one", tmpdir_path)
    assert rep["errors"] == 0 and store.read("fitness_tests").first().max_hr == 180
    assert [r.hr_max for r in store.read("heartrate").collect()] == [50]
    _load(spark, store, {"247ohr_a.json": _hr("2024-01-16", [60, 61])}, "two", tmpdir_path)
    silver = Ingest(spark, store).read_silver("hr_samples")
    assert {r.day for r in silver.collect()} == {D(2024, 1, 16)}
    assert [(r.day, r.hr_max) for r in store.read("heartrate").collect()] == [(D(2024, 1, 16), 61)]
    # the file has no sample left: neither has the table
    _load(spark, store, {"247ohr_a.json": json.dumps({"deviceDays": []})}, "three", tmpdir_path)
    assert store.read("heartrate").count() == 0


def test_corrected_session_replaces_all_its_exercises(spark, tmpdir_path):
    def session(*millis):
        return {"training-session-1.json": json.dumps({
            "startTime": "2024-01-15T07:00:00Z", "sport": "RUNNING",
            "exercises": [{"sport": "RUNNING", "durationMillis": m} for m in millis]})}

    store = UP.TableStore(spark, os.path.join(tmpdir_path, "t"))
    _load(spark, store, session(1_800_000, 600_000), "one", tmpdir_path)
    assert sorted(r.duration_min for r in store.read("training").collect()) == [10.0, 30.0]
    _load(spark, store, session(3_600_000), "two", tmpdir_path)
    assert [r.duration_min for r in store.read("training").collect()] == [60.0]


def test_quarantine_names_files_and_lets_mended_ones_go(spark, tmpdir_path):
    store = UP.TableStore(spark, os.path.join(tmpdir_path, "t"))
    rep = _load(spark, store, {"activity-1.json": '{"date": "2024-01-15", "summary": [1]}', "247ohr_x.json": "{nope"},
                "one", tmpdir_path)
    assert rep["errors"] == 2
    assert {(r.file_name, r.parse_error) for r in store.read("quarantine").collect()} == {
        ("activity-1.json", "unfit_json"), ("247ohr_x.json", "malformed_json")}
    rep = _load(spark, store, {"activity-1.json": '{"date": "2024-01-15", "summary": {"stepCount": 3}}'}, "two", tmpdir_path)
    assert rep["errors"] == 0 and [r.file_name for r in store.read("quarantine").collect()] == ["247ohr_x.json"]


def test_folder_of_a_lost_run_does_not_block_a_table(spark, tmpdir_path):
    store = UP.TableStore(spark, os.path.join(tmpdir_path, "t"))
    rows = _df(spark, [(0, D(2024, 1, 1), 10, 1.0, "a")])
    os.makedirs(os.path.join(tmpdir_path, "t", "x", "v=0"))
    os.makedirs(os.path.join(tmpdir_path, "t", "y", "current"))
    assert store.upsert("x", rows, ["subject_id", "day"])["inserted"] == 1 and store.current_path("x").endswith("v=1")
    assert store.upsert_bucketed("y", rows, ["subject_id", "day"])["inserted"] == 1 and store.read("y").count() == 1
