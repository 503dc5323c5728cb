"""Documents of several devices: the devices' ids travel with their document, nothing is joined to it again."""

import datetime as dt
import os

import __spark_entry__ as E


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ppi_many_devices_reads_each_document_once(spark, tmpdir_path):
    day = dt.datetime(2024, 1, 15)
    rows = [(1, 1, 7, 1, 0.0, 0.0, day), (1, 1, 7, 2, 0.01, 0.0, day), (1, 2, 7, 3, 0.02, 0.0, day),
            (2, 1, 7, 2, 0.03, 0.0, day),  # its only device is 0, in the first place of its list
            (3, 1, 8, 1, 0.04, 0.0, day), (3, 1, 8, 1, 0.04, 0.0, day),  # a line that comes twice
            (4, 1, None, 1, 0.05, 0.0, day)]  # without a person
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_discount double, "
                                "l_tax double, l_shipdate timestamp").write.parquet(os.path.join(tmpdir_path, "lineitem.parquet"))
    df = E.queries()["ppi_many_devices"](spark, tmpdir_path)
    assert {(r.subject_id, r.device, r.n, r.total, r.longest) for r in df.collect()} == {
        (2, 1, 2, 600 + 680, 680), (2, 0, 2, 640 + 720, 720), (3, 1, 2, 2 * 760, 760)}
    assert "Join" not in plan_of(df)


def test_hr_many_devices_reads_each_document_once(spark, tmpdir_path):
    at = lambda h, s: dt.datetime(2024, 1, 15, h, 0, s)
    rows = [(0, at(1, 0), 5, 60.5), (2, at(1, 9), 5, 70.0), (1, at(1, 5), 5, 80.0),
            (3, at(2, 1), 5, 90.0),  # its only device is 1, in the first place of its list
            (4, at(2, 2), 6, 19.0), (6, at(2, 3), 6, 100.0), (6, at(2, 3), 6, 100.0),  # out of range; a row that comes twice
            (8, at(3, 0), None, 50.0)]  # without a person
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, value double").write.parquet(
        os.path.join(tmpdir_path, "events.parquet"))
    df = E.queries()["hr_many_devices"](spark, tmpdir_path)
    assert {(r.subject_id, r.device, r.n, r.total, r.first_ts, r.last_ts) for r in df.collect()} == {
        (0, 0, 2, 130, at(1, 0), at(1, 9)), (0, 1, 2, 170, at(1, 5), at(2, 1)), (1, 0, 2, 200, at(2, 3), at(2, 3))}
    assert "Join" not in plan_of(df)
