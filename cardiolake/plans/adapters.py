"""Adapters: the benchmark tables re-read as wearable inputs.

Each adapter is a projection/aggregation of one given table, so the work of
every registered query grows with the tables. Subjects are derived from a
key of the source row (``key % 5``), which spreads the rows over persons; it
is a mapping, never a filter.

* ``events``   -> second-resolution HR and pulse-interval samples (30 days)
* ``lineitem`` -> long HR / pulse-interval series (years of days)
* ``orders``   -> daily activity; ``orders`` + ``lineitem`` -> training sessions
* ``documents``-> export files with content hashes, and a previous import log
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardiolake.functions.dates import weekday_name
from cardiolake.functions.labels import file_category
from cardiolake.operators.extract import classify_training

N_SUBJECTS = 5

# FIXED VALUES (adapter): order priority -> sport of the derived training session
PRIORITY_SPORT = [("1-URGENT", "RUNNING"), ("2-HIGH", "CYCLING"), ("3-MEDIUM", "HIKING"),
                  ("4-NOT SPECIFIED", "WALKING"), ("5-LOW", "TRAIL_RUNNING")]

# FIXED VALUES (adapter): file-name prefix of the derived export file, one per rule
FILE_PREFIXES = ["activity-", "training-session-", "247ohr_", "ppi_", "fitness-test-results-",
                 "orthostatic-test-result-", "physical-info-", "products-devices-",
                 "generic-period-", "planned-route-", "program-", "season-", "jump-test-",
                 "account-", "sleep_", "nightly-recovery-", "favourite-", "calendar-",
                 "sport-profile-", "misc-"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _subject(col: str):
    return F.pmod(F.col(col), F.lit(N_SUBJECTS)).cast("long").alias("subject_id")


def hr_samples_events(spark, sf_dir) -> DataFrame:
    """events -> (subject_id, day, ts, event_id, seconds_from_day_start, hr), 20..250 bpm."""
    # floor(value) in 20..250  <=>  20 <= value < 251: a plain range on the stored
    # column that the Parquet scan can use to skip row groups (exact filter kept)
    e = table(spark, sf_dir, "events").where((F.col("value") >= 20) & (F.col("value") < 251))
    hr = F.floor("value").cast("int")
    return (e.select(_subject("user_id"), F.to_date("ts").alias("day"), "ts", "event_id",
                     (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("int")
                     .alias("seconds_from_day_start"),
                     hr.alias("hr"))
            .where(F.col("hr").between(20, 250)))


def ppi_samples_events(spark, sf_dir) -> DataFrame:
    """events -> pulse intervals in ms (300..2000), ordered by (ts, event_id)."""
    # a slightly wider range on the stored column for row-group skipping; exact filter below
    e = table(spark, sf_dir, "events").where((F.col("value") >= 29.9) & (F.col("value") < 200.2))
    ppi = F.floor(F.col("value") * 10).cast("int")
    return (e.select(_subject("user_id"), F.to_date("ts").alias("day"), "ts", "event_id",
                     ppi.alias("ppi"))
            .where(F.col("ppi").between(300, 2000)))


def hr_samples_lines(spark, sf_dir) -> DataFrame:
    """lineitem -> long daily HR series: one sample per line, day = ship date."""
    li = table(spark, sf_dir, "lineitem")
    return (li.select(_subject("l_suppkey"), F.to_date("l_shipdate").alias("day"),
                      (F.lit(40) + F.col("l_quantity").cast("int")).alias("hr"))
            .where(F.col("hr").between(20, 250)))


def ppi_samples_lines(spark, sf_dir) -> DataFrame:
    """lineitem -> pulse intervals, ordered by (l_orderkey, l_linenumber) within a day."""
    li = table(spark, sf_dir, "lineitem")
    ppi = (F.lit(600) + F.floor(F.col("l_discount") * 4000) + F.floor(F.col("l_tax") * 2500)).cast("int")
    return (li.select(_subject("l_suppkey"), F.to_date("l_shipdate").alias("day"),
                      "l_orderkey", "l_linenumber", "l_partkey", ppi.alias("ppi"))
            .where(F.col("ppi").between(300, 2000)))


def activity_orders(spark, sf_dir) -> DataFrame:
    """orders -> daily activity per subject (gaps where a subject has no orders)."""
    o = table(spark, sf_dir, "orders")
    k = F.min("o_orderkey")
    return (o.groupBy(_subject("o_custkey"), F.to_date("o_orderdate").alias("day"))
            .agg(F.when(F.pmod(k, F.lit(17)) != 0, F.count(F.lit(1)) * 1000).cast("long").alias("steps"),
                 (F.avg("o_totalprice") / 100).alias("calories"),
                 (F.lit(2.0) + F.pmod(k, F.lit(11)) + F.pmod(k, F.lit(4)) * 0.25).alias("sleep_hours"),
                 (F.pmod(k, F.lit(10)) / 10.0).alias("sleep_quality"),
                 (F.sum("o_totalprice") / 1000).alias("met_minutes")))


def training_raw_orders(spark, sf_dir) -> DataFrame:
    """orders + lineitem -> one raw session per order with lines (before relabelling)."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    lines = li.groupBy("l_orderkey").agg(F.sum("l_quantity").alias("duration_min"),
                                         (F.sum("l_extendedprice") / 50000).alias("distance_km"),
                                         (F.sum("l_tax") * 1000).alias("calories"))
    sport = None
    for k, v in PRIORITY_SPORT:
        sport = (F.when(F.col("o_orderpriority") == k, v) if sport is None
                 else sport.when(F.col("o_orderpriority") == k, v))
    return (o.join(lines, o.o_orderkey == lines.l_orderkey)
            .select(_subject("o_custkey"),
                    F.to_date("o_orderdate").alias("day"),
                    F.col("o_orderdate").cast("timestamp").alias("start_ts"),
                    F.lit(0).alias("ordinal"),
                    sport.otherwise("UNKNOWN").alias("sport_raw"),
                    F.when(F.col("o_orderstatus") == "P", "Laufband").otherwise("Session").alias("name"),
                    "duration_min", "distance_km",
                    (F.lit(100) + F.pmod("o_orderkey", F.lit(60))).cast("double").alias("hr_avg"),
                    (F.lit(130) + F.pmod("o_orderkey", F.lit(50))).cast("double").alias("hr_max"),
                    "calories"))


def training_orders(spark, sf_dir) -> DataFrame:
    """Training table (sport relabelled, category assigned) from orders + lineitem."""
    raw = training_raw_orders(spark, sf_dir)
    t = classify_training(raw, sport="sport_raw", name="name")
    return t.select("subject_id", "day", "start_ts", "ordinal", "sport", "category",
                    "duration_min", "hr_avg", "hr_max", "distance_km", "calories",
                    weekday_name("day").alias("weekday"), F.year("day").alias("year"))


def _file_name():
    prefix = F.get(F.array(*[F.lit(p) for p in FILE_PREFIXES]),
                   F.pmod("doc_id", F.lit(len(FILE_PREFIXES))).cast("int"))
    return F.concat(prefix, F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".json"))


def files_documents(spark, sf_dir) -> DataFrame:
    """documents -> export files ``(subject_id, file_name, content)``."""
    d = table(spark, sf_dir, "documents")
    return d.select(_subject("doc_id"), _file_name().alias("file_name"),
                    F.col("text").cast("binary").alias("content"))


def previous_import_log(spark, sf_dir) -> DataFrame:
    """A previous import state: a third of the files with the same hash, a third
    with an outdated hash, a third not yet imported (all files are still read
    by the change detection; this only shapes the prior state)."""
    d = table(spark, sf_dir, "documents")
    m = F.pmod("doc_id", F.lit(3))
    return (d.where(m != 2)
            .select(_subject("doc_id"), _file_name().alias("file_name"),
                    F.when(m == 0, F.md5(F.col("text").cast("binary")))
                    .otherwise(F.md5(F.concat(F.col("text"), F.lit("#old")).cast("binary")))
                    .alias("hash_md5"),
                    F.lit("2024-01-01 00:00:00").cast("timestamp").alias("imported_at"),
                    file_category(_file_name()).alias("category")))
