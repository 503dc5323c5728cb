"""Export documents generated row by row from the given tables.

Each table row becomes one JSON document shaped like a watch export file,
with the irregularities the extractors must handle: numbers sent as
strings (and decimal strings that must not become integers), list or object
roots, sport as ``{"id": ..}`` or as a padded / quoted name, missing
exercise values that fall back to session values, start times with a
``+02:00`` offset that move the UTC day. Building a document is a
projection of its own row (no grouping), so the work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardiolake.sources.json_docs import once
from cardiolake.plans.adapters import N_SUBJECTS, table as _scan


def table(spark, sf_dir, name) -> DataFrame:
    return _scan(spark, sf_dir, name)


def _spread(spark, df: DataFrame, *key: str) -> DataFrame:
    """Rows dealt over as many tasks as the session works with: a document costs far more to write and to parse
    than its row is long, so neither scan splits nor sizes in bytes tell how many tasks it takes."""
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, *key)


#: Digits of the widest bigint: ids padded to it are never cut and sort as numbers.
ID_DIGITS = 19


# FIXED VALUES (generator): sport names and ids written into training documents
DOC_SPORT_NAMES = ["RUNNING", "HIKING", "WALKING", "CYCLING", "'TRAIL_RUNNING'", " SWIMMING ", "", "YOGA"]
DOC_SPORT_IDS = ["4", "17", "1", "27", "38", "999", "15", "2"]


def _subject(col: str) -> Column:
    return F.pmod(F.col(col), F.lit(N_SUBJECTS)).cast("long").alias("subject_id")


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _q(c) -> Column:
    return F.concat(F.lit('"'), _s(c), F.lit('"'))


def hr_documents(spark, sf_dir) -> DataFrame:
    """events -> one ``247ohr_*.json`` per event; the heart rate is written as
    a quoted integer, a JSON decimal, a JSON integer or a quoted decimal."""
    e = _spread(spark, table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value"), "event_id")
    k = F.pmod("event_id", F.lit(4))
    hr_int = F.floor("value").cast("int")
    hr_txt = (F.when(k == 0, _q(hr_int)).when(k == 1, _s("value"))
              .when(k == 2, _s(hr_int)).otherwise(_q("value")))
    sec = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("int")
    content = F.concat(F.lit('{"deviceDays":[{"date":"'), F.date_format("ts", "yyyy-MM-dd"),
                       F.lit('","samples":[{"heartRate":'), hr_txt,
                       F.lit(',"secondsFromDayStart":'), _s(sec), F.lit("}]}]}"))
    name = F.concat(F.lit("247ohr_"), F.lpad(_s("event_id"), ID_DIGITS, "0"), F.lit(".json"))
    return e.select(_subject("user_id"), name.alias("file_name"), content.alias("content"))


def ppi_documents(spark, sf_dir) -> DataFrame:
    """events -> one ``ppi_*.json`` per event; even ids use a list root, odd an object root."""
    e = _spread(spark, table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value"), "event_id")
    ppi = F.floor(F.col("value") * 10).cast("int")
    obj = F.concat(F.lit('{"date":"'), F.date_format("ts", "yyyy-MM-dd"),
                   F.lit('","devicePpiSamplesList":[{"ppiSamples":[{"pulseLength":'), _s(ppi),
                   F.lit("}]}]}"))
    content = F.when(F.pmod("event_id", F.lit(2)) == 0, F.concat(F.lit("["), obj, F.lit("]"))).otherwise(obj)
    name = F.concat(F.lit("ppi_"), F.lpad(_s("event_id"), ID_DIGITS, "0"), F.lit(".json"))
    return e.select(_subject("user_id"), name.alias("file_name"), content.alias("content"))


def ppi_file_chunks() -> list[Column]:
    """Chunk levels for one-sample files: 1,000 consecutive files, then 1,000,000."""
    prefix = len("ppi_") + ID_DIGITS
    return [F.substring("file_name", 1, prefix - 3), F.substring("file_name", 1, prefix - 6)]


def training_documents(spark, sf_dir) -> DataFrame:
    """lineitem + orders -> one ``training-session-*.json`` per line."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = _spread(spark, li.join(o, li.l_orderkey == o.o_orderkey).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_tax", "l_returnflag",
        "o_custkey", "o_orderdate"), "l_orderkey", "l_linenumber")
    local = F.timestamp_add("HOUR", F.col("l_linenumber") * 3 - 2, F.col("o_orderdate"))
    start = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    names = F.array(*[F.lit(x) for x in DOC_SPORT_NAMES])
    ids = F.array(*[F.lit(x) for x in DOC_SPORT_IDS])
    top_sport = F.get(names, F.pmod("l_partkey", F.lit(len(DOC_SPORT_NAMES))).cast("int"))
    ex_id = F.when(F.pmod("l_suppkey", F.lit(7)) != 0,
                   F.get(ids, F.pmod("l_suppkey", F.lit(len(DOC_SPORT_IDS))).cast("int")))
    q = F.col("l_quantity")
    exercise = F.struct(
        F.when(ex_id.isNotNull(), F.struct(ex_id.alias("id"))).alias("sport"),
        F.when(F.pmod("l_partkey", F.lit(5)) == 0, F.lit(0.0)).otherwise(q * 60000).alias("durationMillis"),
        F.concat(F.lit("PT"), _s(q.cast("int")), F.lit("M30S")).alias("duration"),
        F.when(F.pmod("l_suppkey", F.lit(6)) != 0, F.col("l_extendedprice") / 20).alias("distanceMeters"),
        (F.col("l_tax") * 20000).alias("calories"),
        F.struct((F.lit(100) + q).alias("average"),
                 F.when(F.pmod("l_partkey", F.lit(4)) == 0, F.lit(0.0)).otherwise(F.lit(160) + q).alias("maximum"))
        .alias("heartRate"))
    doc = F.struct(
        start.alias("startTime"), top_sport.alias("sport"),
        F.when(F.col("l_returnflag") == "R", F.lit("Laufband Session")).otherwise(F.lit("Run")).alias("name"),
        F.when(F.pmod("l_partkey", F.lit(10)) == 0, F.lit(0.0)).otherwise(q * 50000).alias("durationMillis"),
        (F.col("l_extendedprice") / 25).alias("distanceMeters"),
        (F.col("l_tax") * 10000).alias("calories"),
        (F.lit(90) + F.col("l_linenumber")).alias("hrAvg"),
        (F.lit(150) + F.col("l_linenumber")).alias("hrMax"),
        F.when(F.pmod("l_linenumber", F.lit(3)) != 1, F.array(exercise))
        .otherwise(F.array().cast("array<" + _EX_TYPE + ">")).alias("exercises"))
    name = F.concat(F.lit("training-session-"), F.lpad(_s("l_orderkey"), ID_DIGITS, "0"), F.lit("-"),
                    _s("l_linenumber"), F.lit("-"), _s("l_partkey"), F.lit(".json"))
    return j.select(_subject("o_custkey"), name.alias("file_name"), F.to_json(doc).alias("content"))


_EX_TYPE = ("struct<sport:struct<id:string>,durationMillis:double,duration:string,distanceMeters:double,"
            "calories:double,heartRate:struct<average:double,maximum:double>>")


def activity_documents(spark, sf_dir) -> DataFrame:
    """orders -> one ``activity-*.json`` per order (several per subject-day)."""
    o = _spread(spark, table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"),
                "o_orderkey")
    k4 = F.pmod("o_orderkey", F.lit(4))
    n = F.floor(F.col("o_totalprice") / 10).cast("long")
    steps = (F.when(k4 == 0, _q(n)).when(k4 == 1, F.concat(F.lit('"'), _s(n), F.lit('.5"')))
             .otherwise(_s(n)))
    k6 = F.pmod("o_orderkey", F.lit(6))
    sleep = (F.when(k6 == 0, F.lit('""')).when(k6 == 1, F.lit('"PT0S"'))
             .otherwise(F.concat(F.lit('"PT'), _s(F.lit(18000) + F.pmod("o_orderkey", F.lit(20000))), F.lit('S"'))))
    content = F.concat(
        F.lit('{"date":"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('","summary":{"stepCount":'), steps,
        F.lit(',"calories":'), _s(F.col("o_totalprice") / 100), F.lit(',"sleepDuration":'), sleep,
        F.lit(',"sleepQuality":'), _s(F.pmod("o_orderkey", F.lit(10)) / 10.0),
        F.lit(',"dailyMetMinutes":'), _s(F.col("o_totalprice") / 1000), F.lit("}}"))
    name = F.concat(F.lit("activity-"), F.lpad(_s("o_orderkey"), ID_DIGITS, "0"), F.lit(".json"))
    return o.select(_subject("o_custkey"), name.alias("file_name"), content.alias("content"))


def fitness_documents(spark, sf_dir) -> DataFrame:
    """orders -> one ``fitness-test-results-*.json`` per order."""
    o = _spread(spark, table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"),
                "o_orderkey")
    own = F.when(F.pmod("o_orderkey", F.lit(11)) != 0, F.lit(20) + F.pmod("o_orderkey", F.lit(60)))
    phys = F.struct(
        F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.pmod("o_custkey", F.lit(3650)).cast("int") + 3650),
                      "yyyy-MM-dd").alias("birthday"),
        F.when(F.pmod("o_custkey", F.lit(2)) == 0, F.lit("MALE")).otherwise(F.lit("FEMALE")).alias("sex"),
        (F.lit(160) + F.pmod("o_custkey", F.lit(35))).cast("double").alias("height"),
        (F.lit(55.5) + F.pmod("o_custkey", F.lit(40))).alias("weight"),
        (F.lit(175) + F.pmod("o_custkey", F.lit(20))).cast("int").alias("maximumHeartRate"),
        (F.lit(45) + F.pmod("o_custkey", F.lit(15))).cast("int").alias("restingHeartRate"),
        F.when(F.pmod("o_orderkey", F.lit(9)) != 0, (own * 0.9)).alias("vo2Max"),
        F.lit("REGULAR").alias("trainingBackground"), F.lit("USER").alias("weightSource"),
        F.lit(28800).cast("long").alias("sleepGoal"))
    res = F.struct(own.alias("ownIndex"), (F.lit(60) + F.pmod("o_orderkey", F.lit(30))).alias("averageHeartRate"),
                   F.col("o_orderpriority").alias("fitnessClass"), F.lit(120).alias("timezoneOffsetMinutes"),
                   phys.alias("physicalInformation"))
    doc = F.struct(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("startTime"),
                   res.alias("fitnessTestResult"))
    name = F.concat(F.lit("fitness-test-results-"), F.lpad(_s("o_orderkey"), ID_DIGITS, "0"), F.lit(".json"))
    return o.select(_subject("o_custkey"), name.alias("file_name"), F.to_json(doc).alias("content"))


def other_documents(spark, sf_dir) -> DataFrame:
    """documents -> one kept-whole document per row: object with ``created``,
    object with an unparseable ``startTime`` and a ``date``, or a list root."""
    d = table(spark, sf_dir, "documents")
    m = F.pmod("doc_id", F.lit(3))
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(366)).cast("int")),
                        "yyyy-MM-dd")
    obj0 = F.to_json(F.struct(F.concat(day, F.lit("T08:15:00.000")).alias("created"), F.col("lang"),
                              F.col("n_chars")))
    obj1 = F.to_json(F.struct(F.lit("not a time").alias("startTime"), day.alias("date"), F.col("source")))
    arr = F.to_json(F.array(F.struct(day.alias("date"), F.col("lang"))))
    content = F.when(m == 0, obj0).when(m == 1, obj1).otherwise(arr)
    name = F.concat(F.lit("account-"), F.col("source"), F.lit("-"), _s("doc_id"), F.lit(".json"))
    return d.select(_subject("doc_id"), name.alias("file_name"), content.alias("text"))


# ---------------------------------------------------------------- API payloads
# FIXED VALUES (generator): API sport strings and detail strings written into payloads
API_DOC_SPORTS = ["RUNNING", "TRAIL_RUNNING", "TREADMILL_RUNNING", "WALKING", "OTHER", "INDOOR_CYCLING",
                  "HIKING", "YOGA"]
API_DOC_DETAILS = ["MOBILITY_DYNAMIC", "not_a_sport", ""]


def _payloads(df: DataFrame, text: Column, schema: str) -> DataFrame:
    return df.select(_subject("o_custkey"), text.alias("json_text")).select(
        "subject_id", "json_text", once(F.from_json("json_text", schema)).alias("p")).select("subject_id", "json_text", "p.*")


def api_activity_payloads(spark, sf_dir) -> DataFrame:
    """orders -> one activity-day payload per order (some fields absent)."""
    from cardiolake import schemas as S
    o = table(spark, sf_dir, "orders")
    doc = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                   F.when(F.pmod("o_orderkey", F.lit(7)) != 0, F.floor(F.col("o_totalprice") / 10)).alias("steps"),
                   (F.col("o_totalprice") / 100).alias("calories"),
                   F.when(F.pmod("o_orderkey", F.lit(5)) != 0, F.col("o_totalprice") / 500).alias("active-calories"))
    return _payloads(o, F.to_json(doc), S.API_ACTIVITY)


def api_sleep_payloads(spark, sf_dir) -> DataFrame:
    """orders -> one sleep payload (one night) per order."""
    from cardiolake import schemas as S
    o = table(spark, sf_dir, "orders")
    night = F.struct(F.date_format(F.date_add(F.to_date("o_orderdate"), 1), "yyyy-MM-dd").alias("date"),
                     F.when(F.pmod("o_orderkey", F.lit(9)) != 0,
                            (F.lit(300) + F.pmod("o_orderkey", F.lit(240))).cast("double")).alias("total_sleep_minutes"),
                     (F.pmod("o_orderkey", F.lit(5)) + 1).cast("double").alias("continuous_rating"))
    return _payloads(o, F.to_json(F.struct(F.array(night).alias("nights"))), S.API_SLEEP)


def api_exercise_payloads(spark, sf_dir) -> DataFrame:
    """orders -> one exercise payload per order."""
    from cardiolake import schemas as S
    o = table(spark, sf_dir, "orders")
    sports = F.array(*[F.lit(x) for x in API_DOC_SPORTS])
    details = F.array(*[F.lit(x) for x in API_DOC_DETAILS])
    k = F.col("o_orderkey")
    dur = F.concat(F.lit("PT"), _s(F.pmod(k, F.lit(3))), F.lit("H"), _s(F.pmod(k, F.lit(60))), F.lit("M"))
    doc = F.struct(
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T07:30:00")).alias("start-time"),
        F.get(sports, F.pmod(k, F.lit(len(API_DOC_SPORTS))).cast("int")).alias("sport"),
        F.get(details, F.pmod("o_custkey", F.lit(len(API_DOC_DETAILS))).cast("int")).alias("detailed-sport-info"),
        dur.alias("duration"),
        F.when(F.pmod(k, F.lit(4)) != 0, F.col("o_totalprice") / 10).alias("distance"),
        (F.col("o_totalprice") / 300).alias("calories"),
        F.struct((F.lit(120) + F.pmod(k, F.lit(40))).cast("double").alias("average"),
                 F.when(F.pmod(k, F.lit(6)) != 0, (F.lit(160) + F.pmod(k, F.lit(30))).cast("double")).alias("maximum"))
        .alias("heart-rate"))
    return _payloads(o, F.to_json(doc), S.API_EXERCISE)
