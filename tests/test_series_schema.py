"""Blockwise windows, discovered schemas, open days with late samples, table rules, plans of one pass."""

import datetime as dt
import json
import os
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardiolake import schemas as S
from cardiolake.operators import calendar as C, daily, extract as X, series as SE, topk as TK, upsert as UP, windows as W
from cardiolake.session import ensure_checkpoint_dir
from cardiolake.streaming import jobs as J, open_days as OD

D = dt.date


# ------------------------------------------------------------------ blockwise windows


@pytest.mark.parametrize("block, ranges", [(7, 5), (40, 3), (1000, 4)])
def test_blockwise_windows_equal_whole_series(spark, block, ranges):
    rng = np.random.default_rng(block)
    n = 400
    pdf = pd.DataFrame({"subject_id": np.where(rng.random(n) < 0.8, 1, rng.integers(2, 6, n)), "ts": rng.permutation(n),
                        "v": np.where(rng.random(n) < 0.2, np.nan, rng.normal(size=n))})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = SE.blockwise(df, {"c": SE.mean_of("v", 30, 7), "t": SE.mean_of("v", 13, 3, center=False),
                            "q": SE.quantile_of("v", 0.25, 9, 2),
                            "n": (-2, 3, lambda w: F.count("v").over(w))}, block=block, ranges=ranges)
    w = W._w(("subject_id",), ("ts",), -2, 3)
    want = df.select("*", W.rolling_mean("v", 30, 7, order=("ts",)).alias("c"),
                     W.rolling_mean("v", 13, 3, center=False, order=("ts",)).alias("t"),
                     W.rolling_quantile("v", 0.25, 9, 2, order=("ts",)).alias("q"), F.count("v").over(w).alias("n"))

    def rows(x):
        return sorted((r.subject_id, r.ts, r.v, *[None if y is None else round(y, 12) for y in (r.c, r.t, r.q)], r.n) for r in x.collect())

    assert rows(got) == rows(want)


def test_a_series_is_numbered_across_ranges(spark):
    df = spark.range(300).select((F.col("id") % 2).alias("subject_id"), ((F.col("id") * 37) % 301).alias("ts"))
    for r in SE.numbered(df, ["subject_id"], ["ts"], ranges=6).groupBy("subject_id").agg(
            F.sort_array(F.collect_list(F.struct("_no", "ts"))).alias("x")).collect():
        assert [e["_no"] for e in r.x] == list(range(150))
        assert [e["ts"] for e in r.x] == sorted(e["ts"] for e in r.x)
    assert SE.blockwise(df.limit(0), {"m": SE.mean_of("ts", 3, 1)}).count() == 0


# ------------------------------------------------------------------ discovered schemas


def docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, j string").repartition(4)


def test_schema_of_all_rows(spark):
    texts = [json.dumps(x) for x in ({"a": 1}, {"a": 2, "b": 1.5}, {"b": 2, "c": "x"}, {"n": None}, {"o": {"p": 1}},
                                     {"o": {"p": 2, "q": [1, 2]}}, {"m": 1}, {"m": "one"}, {"r s": True}, {"t": [{"u": 1}, {"u": "x"}]})]
    df = docs(spark, [*texts, "{broken", None, "[1, 2]", '"text"', "17"])
    schema = {f.name: f.dataType.simpleString() for f in X.discover_schema(df, "j").fields}
    assert schema == {"a": "bigint", "b": "double", "c": "string", "m": "string", "n": "string",
                      "o": "struct<p:bigint,q:array<bigint>>", "r s": "boolean", "t": "array<struct<u:string>>"}
    got = {r.id: r.asDict() for r in X.expand_discovered(df, "j", nested=True).collect()}
    assert got[1]["a"] == 2 and got[1]["b"] == 1.5 and got[0]["b"] is None
    assert got[5]["o.p"] == 2 and got[5]["o.q"] == [1, 2]
    assert got[6]["m"] == "1" and got[7]["m"] == "one"  # conflicting types: the text
    assert got[8]["r s"] is True and all(v is None for k, v in got[10].items() if k != "id")
    assert len(got) == 15
    some = X.expand_discovered(df, "j", wanted=["a", "nowhere"])
    assert some.columns == ["id", "a"]


def test_schema_without_objects_and_clashing_names(spark):
    assert X.discover_schema(docs(spark, ["[1]", None, "x"]), "j") is None
    assert X.expand_discovered(docs(spark, ["[1]", None]), "j").columns == ["id"]
    assert X.discover_schema(docs(spark, []), "j") is None
    got = X.expand_discovered(docs(spark, ['{"id": "x", "k": 1}']), "j")
    assert got.columns == ["id", "k"] and got.first().id == "x"  # the field replaces the column


# ---------------------------------------------------------------- open days


def samples(spark, rows):
    return spark.createDataFrame([(s, dt.datetime(2024, 1, d, h), v) for s, d, h, v in rows], "subject_id long, ts timestamp, hr int")


def test_late_samples_are_counted_and_closing_equals_batch(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    one = [(1, d, h, 50 + d + h) for d in range(1, 7) for h in (1, 9)] + [(2, 6, 23, 80)]
    two = [(1, 2, 5, 44), (1, 6, 3, 61), (2, 7, 1, 90), (2, 1, 1, 70)]  # days 2 and 1 were closed at day 6 23:00 less 2 days
    three = [(1, 12, 1, 60)]
    for k, part in enumerate((one, two, three)):
        OD.run_batch(spark, samples(spark, part), k, root)
    late = {(r.subject_id, r.day): r.n_late for r in OD.late_samples(spark, root).collect()}
    assert late == {(1, D(2024, 1, 2)): 1, (2, D(2024, 1, 1)): 1}
    closed = {(r.subject_id, r.day) for r in OD.daily_table(spark, root).collect()}
    assert (1, D(2024, 1, 12)) not in closed and (1, D(2024, 1, 6)) in closed
    every = samples(spark, one + two + three)
    want = every.groupBy("subject_id", F.to_date("ts").alias("day")).agg(
        F.percentile("hr", F.lit(0.05)).alias("resting_hr"), F.avg("hr").alias("hr_mean"), F.max("hr").alias("hr_max"),
        F.count(F.lit(1)).alias("n_samples"))
    cols = ["subject_id", "day", "resting_hr", "hr_mean", "hr_max", "n_samples"]

    def rows(df):
        return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*cols).collect())

    whole = OD.daily_table(spark, root, with_open=True, with_late=True)
    assert rows(whole) == rows(want)
    # a batch that runs again after a crash changes nothing
    OD.run_batch(spark, samples(spark, three), 2, root)
    assert rows(OD.daily_table(spark, root, with_open=True, with_late=True)) == rows(want)
    total = sum(r.n_samples for r in OD.daily_table(spark, root, with_open=True).collect()) + sum(late.values())
    assert total == every.count()


def test_open_days_as_a_stream(spark, tmpdir_path):
    src, root, name = (os.path.join(tmpdir_path, x) for x in ("src", "t", "n"))
    for part in ([(1, 5, 1, 60)], [(1, 1, 1, 55)]):
        samples(spark, part).coalesce(1).write.mode("append").parquet(src)
    st = lambda: spark.readStream.schema("subject_id long, ts timestamp, hr int").option("maxFilesPerTrigger", 1).parquet(src)
    name = uuid.uuid4().hex
    assert OD.open_days_stream(spark, st(), root, name=name) == 2
    assert OD.open_days_stream(spark, st(), root, name=name) == 0
    samples(spark, [(1, 9, 1, 70)]).coalesce(1).write.mode("append").parquet(src)
    assert OD.open_days_stream(spark, st(), root, name=name) == 1
    assert OD.daily_table(spark, root, with_open=True, with_late=True).agg(F.sum("n_samples")).first()[0] == 3
    assert OD.daily_table(spark, os.path.join(tmpdir_path, "none"), with_open=True, with_late=True).count() == 0


# ------------------------------------------------------------------- tables


def test_not_null_columns_and_comments(spark, tmpdir_path):
    store = UP.TableStore(spark, os.path.join(tmpdir_path, "tables"))
    assert "activity" in store.create_tables()
    assert store.create_tables() == []
    field = spark.read.parquet(store.current_path("activity")).schema["steps"]
    assert field.metadata["comment"] == "steps of the day"
    about = {(r.table_name, r.column): r for r in store.describe().collect()}
    assert about["heartrate", "resting_hr"].comment.startswith("5th percentile") and about["training", "sport"].nullable is False
    assert all(r.table_comment for r in about.values())
    good = spark.createDataFrame([(1, D(2024, 1, 1), 5, 1.0, 1.0, 1.0, 1.0)], S.ACTIVITY)
    assert store.merge_table("activity", good)["inserted"] == 1
    assert spark.read.parquet(store.current_path("activity")).schema["steps"].metadata["comment"] == "steps of the day"
    bad = good.withColumn("day", F.lit(None).cast("date"))
    with pytest.raises(Exception, match="activity.day must not be null"):
        store.merge_table("activity", bad)
    assert store.read("activity").count() == 1
    null_sport = spark.createDataFrame([(1, D(2024, 1, 1), dt.datetime(2024, 1, 1), 0, None)],
                                       "subject_id long, day date, start_ts timestamp, ordinal int, sport string")
    with pytest.raises(Exception, match="training.sport must not be null"):
        store.merge_table("training", X.typed_projection(null_sport, S.TRAINING))


def test_a_new_file_rewrites_few_buckets(spark, tmpdir_path):
    store = UP.TableStore(spark, os.path.join(tmpdir_path, "tables"))

    def log(names):
        return spark.createDataFrame([(7, n, "h", dt.datetime(2024, 1, 1), "c") for n in names], S.IMPORT_LOG)

    store.merge_table("import_log", log([f"f{i}" for i in range(2000)]))
    path = f"{store.root}/import_log/{store.BUCKETED}"

    def files():
        return {f"{b}/{f}" for b in os.listdir(path) if b.startswith("_bucket=") for f in os.listdir(f"{path}/{b}")
                if f.endswith(".parquet")}

    before = files()
    assert len(before) == 256  # the subject's rows lie in all buckets, one file each
    assert store.merge_table("import_log", log(["f1999", "f2000"]))["inserted"] == 1
    assert len(before - files()) <= 2 and store.read("import_log").count() == 2001


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


# ------------------------------------------------------------------- one pass per input


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_frame(spark, df, tmpdir_path, name):
    path = os.path.join(tmpdir_path, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_inputs_are_scanned_once(spark, tmpdir_path):
    rows = [(s, D(2024, 1, 1) + dt.timedelta(days=i), dt.datetime(2024, 1, 1) + dt.timedelta(days=i, seconds=j), j, 800 + (i * j) % 50,
             2024, "RUNNING", 1.0, 1, i % 7) for s in (0, 1) for i in range(5) for j in range(6)]
    df = stored_frame(spark, spark.createDataFrame(rows, "subject_id long, day date, ts timestamp, event_id int, ppi int, year int, "
                                                         "sport string, duration_min double, month int, weekday_no int"), tmpdir_path, "s")
    for frame in (daily.daily_hrv(df), TK.counts_per_year_top(df, "sport", 2), TK.hours_year_top(df, "sport", 2),
                  C.weekday_counts(df), C.grid_pivot(df, "duration_min"), C.monthly_profile(df, "duration_min")):
        text = plan_of(frame)
        scans, reused = text.count("FileScan parquet"), text.count("ReusedExchange")
        assert scans == 1 or scans - reused <= 2, text  # AQE shows a reused branch once more
        assert frame.count() > 0
    assert plan_of(daily.daily_hrv(df)).count("FileScan parquet") == 1
    assert plan_of(C.weekday_counts(df)).count("FileScan parquet") == 1


def test_hrv_from_carried_sums_equals_plain_aggregates(spark):
    rng = np.random.default_rng(3)
    rows = [(0, D(2024, 1, 1), dt.datetime(2024, 1, 1, 0, int(m), int(s)), i, int(v))
            for i, (m, s, v) in enumerate(zip(rng.integers(0, 9, 300), rng.integers(0, 60, 300), rng.integers(300, 2000, 300)))]
    rows += [(1, D(2024, 1, 1), dt.datetime(2024, 1, 1, 1, 0, i), i, 700) for i in range(6)]
    df = spark.createDataFrame(rows, "subject_id long, day date, ts timestamp, event_id int, ppi int")
    got = {r.subject_id: r for r in daily.daily_hrv(df, digits=None, mean_digits=None, hr_digits=None).collect()}
    want = {r.subject_id: r for r in df.groupBy("subject_id").agg(F.avg("ppi").alias("m"), F.stddev_samp("ppi").alias("s")).collect()}
    for s in (0, 1):
        assert abs(got[s].ppi_mean_ms - want[s].m) < 1e-9 and abs(got[s].sdnn - want[s].s) < 1e-9
    assert got[1].rmssd == 0.0 and got[1].sdnn == 0.0


# ------------------------------------------------------------------- payloads


def test_payloads_without_a_day_are_counted_and_kept(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landed")
    for endpoint, texts in {"activity": [{"date": "2024-01-01", "steps": 5}, {"date": "soon", "steps": 6}, {"steps": 7}],
                            "sleep": [{"nights": [{"date": "2024-01-01", "total_sleep_minutes": 400}, {"date": "?"}]}, {}]}.items():
        os.makedirs(os.path.join(root, endpoint))
        for i, t in enumerate(texts):
            with open(os.path.join(root, endpoint, f"{i}.json"), "w") as f:
                json.dump(t, f)
    store = UP.TableStore(spark, os.path.join(tmpdir_path, "tables"))
    a = J.payload_stream(spark, root, "activity", store, name=uuid.uuid4().hex)
    s = J.payload_stream(spark, root, "sleep", store, name=uuid.uuid4().hex)
    assert sum(r["undated"] for r in a) == 2 and sum(r["undated"] for r in s) == 2
    kept = sorted((r.endpoint, r.reason) for r in store.read("payload_quarantine").collect())
    assert kept == [("activity", "no day in date"), ("activity", "no day in date"), ("sleep", "no day in entry 1"),
                    ("sleep", "no entry in nights")]
    assert store.read("activity").first().sleep_hours == 6.67
