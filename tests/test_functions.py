import datetime as dt

from pyspark.sql import functions as F

from cardiolake.functions import (effect_label, falsy_fallback, file_category, iso_duration_minutes,
                                  iso_duration_minutes_strict, safe_double, safe_int, sleep_band,
                                  title_case, week_end_sunday)


def one(spark, expr, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_iso_duration(spark):
    got = one(spark, iso_duration_minutes("x"),
              [("PT3600S",), ("PT1H30M",), ("PT1H30M45S",), ("",), (None,), ("garbage",), ("P1M",), ("PT0.5S",)])
    assert got == [60.0, 90.0, 90.75, 0.0, 0.0, 0.0, 0.0, 0.0083]


def test_iso_duration_strict(spark):
    got = one(spark, iso_duration_minutes_strict("x"), [("PT1H30M45S",), ("PT45M",), ("1H",), ("",)])
    assert got == [90.75, 45.0, 0.0, 0.0]


def test_safe_numbers_from_variant(spark):
    df = spark.createDataFrame([('{"a": "12"}',), ('{"a": "1.5"}',), ('{"a": 1.9}',), ('{"a": null}',),
                                ('{"a": "x"}',)], "t string")
    v = F.from_json("t", "a variant")["a"]
    got = [(r[0], r[1]) for r in df.select(safe_int(v), safe_double(v)).collect()]
    assert got == [(12, 12.0), (None, 1.5), (1, 1.9), (None, None), (None, None)]


def test_falsy_fallback(spark):
    got = one(spark, falsy_fallback("a", "b"), [(0.0, 5.0), (None, 5.0), (3.0, 5.0), (0.0, None)],
              "a double, b double")
    assert got == [5.0, 5.0, 3.0, None]


def test_title_case(spark):
    assert one(spark, title_case("x"), [("TRAIL_RUNNING",), ("RUNNING",), ("NORDIC WALKING",)]) == ["Trail_Running", "Running",
                                                                                                        "Nordic Walking"]


def test_sleep_band(spark):
    got = one(spark, sleep_band("x"), [(0.0,), (5.0,), (5.01,), (9.0,), (9.5,), (120.0,)], "x double")
    assert got == [None, "<5h", "5–6h", "8–9h", ">9h", None]


def test_effect_label(spark):
    assert one(spark, effect_label("x"), [(0.1,), (-0.45,), (0.8,), (None,)], "x double") == \
        ["weak", "moderate", "strong", None]


def test_file_category_rules(spark):
    names = {
        "activity_2024-01-15.json": "activity", "fitness-test-results_2024-01-15.json": "fitness_test",
        "training-session-2024.json": "training", "247ohr_2024_01.json": "heartrate", "ppi_samples.json": "hrv",
        "orthostatic-test-result-1.json": "orthostatic_test", "physical-info-1.json": "physical_info",
        "products-devices-1.json": "products_devices", "generic-period-1.json": "generic_exercise",
        "planned-route-1.json": "planned_exercise", "program-1.json": "programs", "season-1.json": "season",
        "jump-test-1.json": "jump_test", "account-data.json": "account", "sleep_result.json": "sleep",
        "nightly-recovery-1.json": "nightly_recovery", "favourite-1.json": "favourite",
        "calendar-1.json": "calendar", "sport-profiles.json": "sport", "x.json": "sonstige",
        "ACTIVITY-1.JSON": "activity",
    }
    got = one(spark, file_category("x"), [(n,) for n in names])
    assert got == list(names.values())


def test_week_end_sunday(spark):
    rows = [(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),), (dt.date(2024, 1, 8),)]
    assert one(spark, week_end_sunday("x"), rows, "x date") == \
        [dt.date(2024, 1, 7), dt.date(2024, 1, 7), dt.date(2024, 1, 14)]
