"""More registered queries: branches that plain inputs never reach, and operators that had no query.

Inputs are mapped, never thinned out: more sports than any top-k holds, months
without sessions (their sessions move to the next month), missing heart rates,
documents with several exercises, devices and samples, whole texts in JSON,
broken JSON, merges of every table, archives written and read again.
"""

from __future__ import annotations

import io
import uuid
import zipfile

from pyspark.sql import DataFrame, functions as F

from cardiolake import schemas as S
from cardiolake.functions.convert import null_or_default, round_to
from cardiolake.functions.dates import add_seconds, lookback_window
from cardiolake.functions.labels import label_at
from cardiolake.operators import (aggregate as AG, api_extract as AX, calendar as C, daily, extract as X, incremental as INC,
                                  stats as ST, topk as TK, upsert as UP)
from cardiolake.plans import adapters as A, datasets as DS, documents as DOC
from cardiolake.plans.catalog import (ACT, HR_DAILY_LI, HR_EV, HRV_DAILY_LI, PPI_LI, _title_sql, act_s, daily_hrv_sql,
                                      hr_daily_lines, hrv_daily_lines, parsed, register, tr_s, PPI_LI_ORDER)
from cardiolake.session import ensure_checkpoint_dir
from cardiolake.sources import archive as AR, json_docs as JD, tables as TB
from cardiolake.streaming import open_days as OD

# FIXED VALUES (adapter): sports of the wider session table, by an index that makes some frequent and some rare
WIDE_SPORTS = ["RUNNING", "CROSS_COUNTRY_SKIING", "CYCLING", "OPEN_WATER_SWIMMING", "HIKING", "YOGA", "INDOOR_ROWING",
               "E_BIKE", "WALKING", "UNIHOCKEY", "STRENGTH_TRAINING"]
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def _array_sql(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# ------------------------------------------------------------- sessions with gaps, many sports, missing values
WIDE = f"""wd AS (
  SELECT o_orderkey, o_custkey, o_totalprice,
    CAST(CASE WHEN month(o_orderdate) % 3 = 0 THEN o_orderdate + INTERVAL 1 MONTH ELSE o_orderdate END AS DATE) AS day
  FROM orders),
wide AS (
  SELECT CAST(o_custkey % 5 AS BIGINT) AS subject_id, day, CAST(year(day) AS INTEGER) AS year,
    CASE WHEN o_orderkey % 13 <> 0 THEN {_array_sql(WIDE_SPORTS)}[CAST(o_orderkey % 7 + o_custkey % 5 AS INTEGER) + 1] END AS sport,
    CAST(10 + o_orderkey % 90 AS DOUBLE) AS duration_min, o_totalprice / 10000 AS distance_km,
    CASE WHEN o_orderkey % 6 <> 0 THEN CAST(100 + o_orderkey % 60 AS DOUBLE) END AS hr_avg,
    CASE WHEN o_orderkey % 10 <> 1 THEN CAST(130 + o_orderkey % 50 AS DOUBLE) END AS hr_max
  FROM wd)"""


def wide_sessions(spark, sf) -> DataFrame:
    """orders -> sessions of eleven sports and none, quarters' last months empty, heart rates missing."""
    o = A.table(spark, sf, "orders")
    date = F.to_date("o_orderdate")
    day = F.when(F.pmod(F.month(date), F.lit(3)) == 0, F.add_months(date, 1)).otherwise(date)
    key = F.col("o_orderkey")
    sport = F.get(F.array(*map(F.lit, WIDE_SPORTS)), (F.pmod(key, F.lit(7)) + F.pmod("o_custkey", F.lit(5))).cast("int"))
    return o.select(A._subject("o_custkey"), day.alias("day"), F.year(day).alias("year"),
                    F.when(F.pmod(key, F.lit(13)) != 0, sport).alias("sport"),
                    (F.lit(10) + F.pmod(key, F.lit(90))).cast("double").alias("duration_min"),
                    (F.col("o_totalprice") / 10000).alias("distance_km"),
                    F.when(F.pmod(key, F.lit(6)) != 0, (F.lit(100) + F.pmod(key, F.lit(60))).cast("double")).alias("hr_avg"),
                    F.when(F.pmod(key, F.lit(10)) != 1, (F.lit(130) + F.pmod(key, F.lit(50))).cast("double")).alias("hr_max"))


WIDE_RANKED = f"""{WIDE},
cnt AS (SELECT subject_id, sport, count(*) AS n FROM wide WHERE sport IS NOT NULL GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY n DESC, sport ASC) AS rank FROM cnt)"""


@register("top_sports_wide", f"WITH {WIDE_RANKED} SELECT subject_id, sport, n, rank FROM rk WHERE rank <= 5")
def q_top_sports_wide(spark, sf):
    """Five of eleven sports."""
    return TK.top_k(wide_sessions(spark, sf), "sport", 5)


@register("sport_share_wide", f"""
WITH {WIDE_RANKED},
lab AS (SELECT subject_id, CASE WHEN rank <= 7 THEN sport ELSE 'Other' END AS sport,
          CASE WHEN rank <= 7 THEN rank ELSE 8 END AS rank, n FROM rk),
agg AS (SELECT subject_id, sport, CAST(rank AS INTEGER) AS rank, sum(n) AS n FROM lab GROUP BY ALL)
SELECT *, n / sum(n) OVER (PARTITION BY subject_id) AS share,
  CASE WHEN sport = 'Other' THEN sport ELSE {_title_sql('sport')} END AS label
FROM agg""", ["share"])
def q_sport_share_wide(spark, sf):
    """Seven sports and what is left, labels of names with underscores."""
    return DS.sport_share(wide_sessions(spark, sf)).withColumn("rank", F.col("rank").cast("int"))


@register("trainings_by_year_wide", f"""
WITH {WIDE_RANKED},
top AS (SELECT subject_id, sport FROM rk WHERE rank <= 5)
SELECT t.subject_id, t.year, CASE WHEN top.sport IS NOT NULL THEN t.sport ELSE 'Other' END AS sport, count(*) AS n
FROM wide t LEFT JOIN top ON t.subject_id = top.subject_id AND t.sport = top.sport GROUP BY ALL""")
def q_trainings_by_year_wide(spark, sf):
    """Sessions per year of five sports, all others (and none) as Other."""
    return DS.trainings_by_year(wide_sessions(spark, sf))


@register("hours_year_wide", f"""
WITH {WIDE_RANKED},
top AS (SELECT subject_id, sport, rank FROM rk WHERE rank <= 5),
h AS (SELECT t.subject_id, t.year, top.rank, sum(t.duration_min) / 60.0 AS hours
      FROM wide t JOIN top ON t.subject_id = top.subject_id AND t.sport = top.sport GROUP BY ALL)
SELECT subject_id, year, {", ".join(f"coalesce(max(CASE WHEN rank = {i} THEN hours END), 0.0) AS top{i}_hours" for i in range(1, 6))}
FROM h GROUP BY subject_id, year""", [f"top{i}_hours" for i in range(1, 6)])
def q_hours_year_wide(spark, sf):
    """Hours per year of each of the five most frequent sports, all of them filled."""
    return TK.hours_year_top(wide_sessions(spark, sf), "sport", 5)


@register("sessions_beside_top", f"""
WITH {WIDE_RANKED},
top AS (SELECT subject_id, sport FROM rk WHERE rank <= 3)
SELECT t.subject_id, t.year, count(*) FILTER (WHERE top.sport IS NOT NULL) AS n_top,
  count(*) FILTER (WHERE top.sport IS NULL) AS n_beside
FROM wide t LEFT JOIN top ON t.subject_id = top.subject_id AND t.sport = top.sport GROUP BY ALL""")
def q_sessions_beside_top(spark, sf):
    """Semi and anti join against the top list, both sides counted."""
    w = wide_sessions(spark, sf)
    part = lambda keep, name: (TK.restrict_to_top(w, "sport", 3, keep=keep)
                               .groupBy("subject_id", "year").agg(F.count(F.lit(1)).alias(name)))
    both = part(True, "n_top").join(part(False, "n_beside"), ["subject_id", "year"], "full_outer")
    return both.na.fill(0)


@register("monthly_sums_with_gaps", f"""
WITH {WIDE},
m AS (SELECT subject_id, last_day(day) AS period, sum(duration_min) AS duration_min, avg(hr_avg) AS hr_avg FROM wide GROUP BY ALL),
sp AS (SELECT subject_id, last_day(CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE)) AS period
       FROM (SELECT subject_id, date_trunc('month', min(period)) AS lo, date_trunc('month', max(period)) AS hi FROM m GROUP BY subject_id))
SELECT s.subject_id, s.period, CAST(coalesce(m.duration_min, 0) AS DOUBLE) AS duration_min, m.hr_avg
FROM sp s LEFT JOIN m USING (subject_id, period)""", ["duration_min", "hr_avg"])
def q_monthly_sums_with_gaps(spark, sf):
    """Every third month is empty: sums are 0 there, means NULL."""
    return C.resample(wide_sessions(spark, sf), "month", sums=["duration_min"], means=["hr_avg"])


@register("hr_duration_pairs_wide", f"""
WITH {WIDE}
SELECT subject_id, day, sport, duration_min, hr_avg, hr_max FROM wide WHERE hr_avg IS NOT NULL AND hr_max IS NOT NULL""",
          ["duration_min", "hr_avg", "hr_max"])
def q_hr_duration_pairs_wide(spark, sf):
    """Sessions that lack a heart rate go."""
    return X.hr_duration_pairs(wide_sessions(spark, sf))


@register("kpi_cards_with_gaps", f"""
WITH {ACT}, {WIDE}, {HRV_DAILY_LI},
h7 AS (SELECT subject_id + 3 AS subject_id, sdnn FROM hrvl_d),
a AS (SELECT subject_id, datediff('day', min(day), max(day)) / 365.25 AS years, avg(steps) AS steps_avg,
        avg(sleep_hours) AS sleep_avg FROM act GROUP BY subject_id),
h AS (SELECT subject_id, avg(sdnn) AS resting_hr_avg FROM h7 GROUP BY subject_id),
t AS (SELECT subject_id + 1 AS subject_id, count(*) AS sessions, count(*) FILTER (WHERE sport = 'RUNNING') AS runs FROM wide GROUP BY ALL)
SELECT subject_id, coalesce(years, 0) AS years, coalesce(steps_avg, 0) AS steps_avg, coalesce(sleep_avg, 0) AS sleep_avg,
  coalesce(resting_hr_avg, -1) AS resting_hr_avg, coalesce(sessions, 0) AS sessions, coalesce(runs, 0) AS runs
FROM a FULL JOIN h USING (subject_id) FULL JOIN t USING (subject_id)""", ["years", "steps_avg", "sleep_avg", "resting_hr_avg"])
def q_kpi_cards_with_gaps(spark, sf):
    """Subjects that lack a part; counts become 0, the heart rate a stated default."""
    hr = hrv_daily_lines(spark, sf).select((F.col("subject_id") + 3).alias("subject_id"), "day", F.col("sdnn").alias("resting_hr"))
    tr = wide_sessions(spark, sf).withColumn("subject_id", F.col("subject_id") + 1)
    k = AG.kpis(act_s(spark, sf), hr.where("resting_hr IS NOT NULL"), tr)
    absent = hr.where("resting_hr IS NOT NULL").select("subject_id").distinct().withColumn("_has", F.lit(True))
    k = k.join(absent, "subject_id", "left")
    return k.withColumn("resting_hr_avg", null_or_default(F.when(F.col("_has"), F.col("resting_hr_avg")), -1.0)).drop("_has")


# ------------------------------------------------------------------- documents with several parts, broken JSON
@register("training_many_exercises", f"""
WITH ex AS (
  SELECT CAST(o_custkey % 5 AS BIGINT) AS subject_id, l_orderkey, o_orderdate,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice) - 1 AS INTEGER) AS ordinal,
    {_array_sql(WIDE_SPORTS)}[CAST(l_partkey % 11 AS INTEGER) + 1] AS sport, l_quantity, l_extendedprice
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT subject_id, l_orderkey AS session, ordinal,
  CASE WHEN sport IN ('HIKING', 'WALKING') AND l_quantity / (l_extendedprice / 1000) < 10 THEN 'RUNNING' ELSE sport END AS sport,
  CAST(l_quantity AS DOUBLE) AS duration_min, l_extendedprice / 1000 AS distance_km
FROM ex""", ["duration_min", "distance_km"])
def q_training_many_exercises(spark, sf):
    """One document per order, one exercise per line of it (up to seven)."""
    li = A.table(spark, sf, "lineitem")
    o = A.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    ex = F.struct("l_linenumber", "l_partkey", "l_extendedprice",
                  F.get(F.array(*map(F.lit, WIDE_SPORTS)), F.pmod("l_partkey", F.lit(11)).cast("int")).alias("sport"),
                  (F.col("l_quantity") * 60000).alias("durationMillis"), F.col("l_extendedprice").alias("distanceMeters"))
    j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    docs = (j.groupBy("l_orderkey", "o_custkey", "o_orderdate").agg(F.array_sort(F.collect_list(ex)).alias("exercises"))
            .select(A._subject("o_custkey"), F.concat(F.lit("training-session-"), F.col("l_orderkey").cast("string"),
                                                      F.lit(".json")).alias("file_name"),
                    F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("startTime"),
                                       F.col("exercises"))).alias("content")))
    t = X.explode_training(parsed(docs, S.TRAINING_DOC), round_values=False)
    return t.select("subject_id", F.regexp_extract("file_name", r"-(\d+)\.json", 1).cast("long").alias("session"), "ordinal",
                    "sport", "duration_min", "distance_km")


@register("hr_many_devices", f"""
WITH {HR_EV}
SELECT subject_id, day, CAST(event_id % 2 AS INTEGER) AS device, count(*) AS n, CAST(sum(hr) AS BIGINT) AS total,
  min(ts) AS first_ts, max(ts) AS last_ts
FROM (SELECT subject_id, day, event_id, hr, date_trunc('second', ts) AS ts FROM hr_s) GROUP BY ALL""")
def q_hr_many_devices(spark, sf):
    """One document per subject and hour, two device days with all samples of the hour; the
    samples' times come from the day and the seconds."""
    e = A.table(spark, sf, "events")
    sec = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")).cast("int")
    e = e.select(A._subject("user_id"), "user_id", F.to_date("ts").alias("day"), F.hour("ts").alias("h"),
                 F.pmod("event_id", F.lit(2)).alias("device"), F.floor("value").cast("int").alias("hr"), sec.alias("sec"))
    sample = F.struct(F.col("hr").alias("heartRate"), F.col("sec").alias("secondsFromDayStart"))
    device = F.struct(F.col("device"), F.date_format("day", "yyyy-MM-dd").alias("date"), F.col("samples"))
    per = e.groupBy("subject_id", "user_id", "day", "h", "device").agg(F.collect_list(sample).alias("samples"))
    docs = (per.groupBy("subject_id", "user_id", "day", "h").agg(F.array_sort(F.collect_list(device)).alias("deviceDays"))
            .select("subject_id", F.concat_ws("_", F.lit("247ohr"), "user_id", "day", "h").alias("file_name"),
                    F.to_json(F.struct("deviceDays")).alias("content"), F.transform("deviceDays", lambda d: d["device"]).alias("ids")))
    # the devices' ids travel with their document: joined to it again, all documents would be built twice
    s = X.explode_hr_samples(parsed(docs, S.HR_DOC), keep=("ids",)).where("subject_id IS NOT NULL")
    at = add_seconds(F.col("day").cast("timestamp"), F.col("seconds_from_day_start"))
    return (s.select("subject_id", "day", F.get("ids", F.col("day_idx")).cast("int").alias("device"), "hr", at.alias("ts"))
            .groupBy("subject_id", "day", "device").agg(F.count(F.lit(1)).alias("n"), F.sum("hr").alias("total"),
                                                        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))


@register("ppi_many_devices", f"""
WITH {PPI_LI}
SELECT subject_id, day, CAST(l_linenumber % 2 AS INTEGER) AS device, count(*) AS n, CAST(sum(ppi) AS BIGINT) AS total,
  CAST(max(ppi) AS INTEGER) AS longest
FROM ppil_s GROUP BY ALL""")
def q_ppi_many_devices(spark, sf):
    """One document per order, two devices with its pulse intervals."""
    s = A.ppi_samples_lines(spark, sf)
    per = (s.groupBy("subject_id", "day", "l_orderkey", F.pmod("l_linenumber", F.lit(2)).alias("device"))
           .agg(F.collect_list(F.struct(F.col("ppi").alias("pulseLength"))).alias("ppiSamples")))
    docs = (per.groupBy("subject_id", "day", "l_orderkey")
            .agg(F.array_sort(F.collect_list(F.struct("device", "ppiSamples"))).alias("devices"))
            .select("subject_id", F.concat_ws("_", F.lit("ppi"), F.col("l_orderkey"), "subject_id", "day").alias("file_name"),
                    F.to_json(F.array(F.struct(F.date_format("day", "yyyy-MM-dd").alias("date"),
                                               F.col("devices").alias("devicePpiSamplesList")))).alias("content"),
                    F.transform("devices", lambda d: d["device"]).alias("ids")))
    found = X.explode_ppi_samples(parsed(docs, S.PPI_DOC), keep=("ids",)).where("subject_id IS NOT NULL")
    return (found.groupBy("subject_id", "day", F.get("ids", F.col("device")).cast("int").alias("device"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("ppi").alias("total"), F.max("ppi").alias("longest")))


def _text_files(spark, sf) -> DataFrame:
    """documents -> JSON files with the whole text; every fourth is cut in the middle, every ninth is not UTF-8."""
    d = DOC._spread(spark, A.table(spark, sf, "documents").select("doc_id", "source", "text"), "doc_id")
    text = F.to_json(F.struct(F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(300)).cast("int")),
                                            "yyyy-MM-dd").alias("date"), F.coalesce("text", F.lit("")).alias("text")))
    whole = F.col("j").cast("binary")
    content = (F.when(F.pmod("doc_id", F.lit(9)) == 4, F.concat(F.unhex(F.lit("FF")), whole))
               .when(F.pmod("doc_id", F.lit(4)) == 1, F.expr("substring(cast(j AS binary), 1, length(cast(j AS binary)) - 2)"))
               .otherwise(whole))
    return d.withColumn("j", text).select(
        A._subject("doc_id"), F.concat(F.lit("account-"), F.col("doc_id").cast("string"), F.lit(".json")).alias("file_name"),
        content.alias("content"), "doc_id")


@register("whole_texts_kept", """
SELECT CAST(doc_id % 5 AS BIGINT) AS subject_id, doc_id, 'account' AS category,
  CASE WHEN doc_id % 9 = 4 THEN 'invalid_utf8' WHEN doc_id % 4 = 1 THEN 'malformed_json' END AS parse_error,
  CASE WHEN doc_id % 9 <> 4 AND doc_id % 4 <> 1 THEN CAST(DATE '2024-01-01' + CAST(doc_id % 300 AS INTEGER) AS DATE) END AS day,
  CASE WHEN doc_id % 9 <> 4 AND doc_id % 4 <> 1 THEN sha256(coalesce(text, '')) END AS text_sha256
FROM documents""")
def q_whole_texts_kept(spark, sf):
    """X10 + S03: whole texts travel through JSON; broken files are told apart by their reason."""
    files = INC.with_category(_text_files(spark, sf))
    marked = JD.with_parse_error(files)
    kept = X.keep_document(JD.good(marked).withColumn("text", JD.decode_text("content")))
    kept = kept.select("file_name", "day", F.sha2(F.get_json_object("json_data", "$.text"), 256).alias("text_sha256"))
    return marked.select("subject_id", "doc_id", "file_name", "category", "parse_error").join(kept, "file_name", "left").drop("file_name")


@register("parse_errors_mixed", """
SELECT 'account' AS category, count(*) AS n_files, count(*) FILTER (WHERE doc_id % 9 = 4) AS n_invalid_utf8,
  count(*) FILTER (WHERE doc_id % 9 <> 4 AND doc_id % 4 = 1) AS n_malformed
FROM documents HAVING count(*) > 0""")
def q_parse_errors_mixed(spark, sf):
    """Files of one category that are fine, not UTF-8, or not JSON."""
    return JD.error_counts(_text_files(spark, sf))


# ------------------------------------------------------------------------------------- archives written and read
def _zip_group(folder: str):
    def pack(key, pdf):
        import pandas as pd

        path = f"{folder}/subject_id={int(key[0])}"
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in zip(pdf["file_name"], pdf["content"]):
                z.writestr(name, text)
        return pd.DataFrame([(int(key[0]), int(key[1]), f"{path}/part-{int(key[1])}.zip", buffer.getvalue(), len(pdf))],
                            columns=["subject_id", "part", "path", "content", "n"])
    return pack


@register("archive_entries", """
SELECT CAST(doc_id % 5 AS BIGINT) AS subject_id, 'training-session-' || CAST(doc_id AS VARCHAR) || '.json' AS file_name,
  'training' AS category, md5(coalesce(text, '')) AS hash_md5, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes
FROM documents""")
def q_archive_entries(spark, sf):
    """S01 + S02 + U01 + L02 + L03: documents packed into ZIP archives (some hundred entries each), which the
    unzipper reads back; entries are routed by name and hashed."""
    d = A.table(spark, sf, "documents")
    # an archive holds the documents of a run of ids, so their number grows with the table
    files = d.select(A._subject("doc_id"), F.floor(F.col("doc_id") / 2000).cast("long").alias("part"),
                     F.concat(F.lit("training-session-"), F.col("doc_id").cast("string"), F.lit(".json")).alias("file_name"),
                     F.coalesce("text", F.lit("")).alias("content"))
    packed = files.groupBy("subject_id", "part").applyInPandas(
        _zip_group("archives"), "subject_id long, part long, path string, content binary, n long")
    entries = AR.unzip_entries(packed.withColumn("modificationTime", F.lit("2024-01-01").cast("timestamp")))
    routed = AR.route_by_name(entries, "training")
    return INC.with_category(INC.with_hash(routed)).select(
        "subject_id", "file_name", "category", "hash_md5", F.octet_length("content").cast("long").alias("n_bytes"))


# ------------------------------------------------------------------------------------------------ scans, reports
@register("scan_activity_range", f"""
WITH {ACT} SELECT * FROM act WHERE day BETWEEN DATE '1994-03-01' AND DATE '1996-09-30'""",
          ["calories", "sleep_hours", "sleep_quality", "met_minutes"])
def q_scan_activity_range(spark, sf):
    """S06 / F17 / O01."""
    return TB.scan_activity(act_s(spark, sf), "1994-03-01", "1996-09-30")


@register("scan_hrv_range", f"""
WITH {HRV_DAILY_LI} SELECT * FROM hrvl_d WHERE day <= DATE '1995-06-30' AND subject_id IN (1, 3)""",
          ["rmssd", "sdnn", "ppi_mean_ms", "hr_from_ppi"])
def q_scan_hrv_range(spark, sf):
    """Open lower bound, two subjects."""
    return TB.scan_hrv(hrv_daily_lines(spark, sf), None, "1995-06-30", subjects=[1, 3])


@register("scan_fitness_all", f"""
WITH f AS (
  SELECT CAST(o_custkey % 5 AS BIGINT) AS subject_id, CAST(o_orderdate AS DATE) AS day, 20 + o_orderkey % 60 AS own_index FROM orders)
SELECT subject_id, day, CAST(max(own_index) AS DOUBLE) AS own_index FROM f GROUP BY ALL""", ["own_index"])
def q_scan_fitness_all(spark, sf):
    """All fitness tests in order."""
    o = A.table(spark, sf, "orders")
    best = o.groupBy(A._subject("o_custkey"), F.to_date("o_orderdate").alias("day")).agg(
        F.max(F.lit(20) + F.pmod("o_orderkey", F.lit(60))).cast("double").alias("own_index"))
    return TB.scan_fitness(best)


@register("adhoc_sql", f"""
WITH {ACT} SELECT subject_id, count(*) AS n, max(steps) AS steps FROM act WHERE steps >= 2000 GROUP BY subject_id""")
def q_adhoc_sql(spark, sf):
    """SQL with a named parameter over a view."""
    view = f"act_{uuid.uuid4().hex}"
    return TB.adhoc_sql(spark, f"SELECT subject_id, count(*) AS n, max(steps) AS steps FROM {view} WHERE steps >= :least "
                               "GROUP BY subject_id", {"least": 2000}, **{view: act_s(spark, sf)})


@register("table_overview", f"""
WITH {ACT}, {WIDE}, {HR_DAILY_LI}
SELECT 'activity' AS table_name, count(*) AS n_rows, min(day) AS min_day, max(day) AS max_day FROM act
UNION ALL SELECT 'training', count(*), min(day), max(day) FROM wide
UNION ALL SELECT 'heartrate', count(*), min(day), max(day) FROM hrl_d""")
def q_table_overview(spark, sf):
    """Rows and days of every table."""
    return AG.table_overview({"activity": act_s(spark, sf), "training": wide_sessions(spark, sf),
                              "heartrate": hr_daily_lines(spark, sf)})


@register("fitted_lines", f"""
WITH {HRV_DAILY_LI}, {HR_DAILY_LI},
j AS (SELECT v.subject_id, rmssd AS x, resting_hr AS y FROM hrvl_d v JOIN hrl_d h ON v.subject_id = h.subject_id AND v.day = h.day
      WHERE rmssd IS NOT NULL AND resting_hr IS NOT NULL),
s AS (SELECT subject_id, regr_slope(y, x) AS a, regr_intercept(y, x) AS b, min(x) AS lo, max(x) AS hi FROM j GROUP BY subject_id),
p AS (SELECT *, CAST(unnest(range(0, 100)) AS INTEGER) AS i FROM s)
SELECT subject_id, i, lo + (hi - lo) * i / 99 AS x, a * (lo + (hi - lo) * i / 99) + b AS y FROM p""", ["x", "y"])
def q_fitted_lines(spark, sf):
    """A hundred points of each subject's fitted line."""
    j = hrv_daily_lines(spark, sf).join(hr_daily_lines(spark, sf), ["subject_id", "day"]).dropna(subset=["rmssd", "resting_hr"])
    ends = j.groupBy("subject_id").agg(F.min("rmssd").alias("lo"), F.max("rmssd").alias("hi"))
    return ST.fit_line(ST.pearson(j, "rmssd", "resting_hr").join(ends, "subject_id"), "lo", "hi")


def _box_sql(cte: str, group: str, value: str, source: str) -> str:
    return f"""WITH {cte},
v AS (SELECT subject_id, {group} AS grp, {value} AS v FROM {source} WHERE {value} IS NOT NULL),
q AS (SELECT subject_id, grp, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3
      FROM v GROUP BY ALL)
SELECT v.subject_id, v.grp, q1, median, q3,
  min(CASE WHEN round(v, 9) >= round(q1 - 1.5 * (q3 - q1), 9) THEN v END) AS whisker_lo,
  max(CASE WHEN round(v, 9) <= round(q3 + 1.5 * (q3 - q1), 9) THEN v END) AS whisker_hi,
  count(*) FILTER (WHERE round(v, 9) < round(q1 - 1.5 * (q3 - q1), 9) OR round(v, 9) > round(q3 + 1.5 * (q3 - q1), 9)) AS n_outliers,
  count(*) AS n
FROM v JOIN q USING (subject_id, grp) GROUP BY ALL"""


BOX_D = ["q1", "median", "q3", "whisker_lo", "whisker_hi"]


@register("box_stats_by_weekday", _box_sql(HR_DAILY_LI, f"{_array_sql(WEEKDAYS)}[weekday_no + 1]", "resting_hr", "hrl_d"), BOX_D)
def q_box_stats_by_weekday(spark, sf):
    """A32 + F09: resting HR by weekday, labelled."""
    return AG.box_stats(hr_daily_lines(spark, sf), "resting_hr", label_at(WEEKDAYS, "weekday_no"))


@register("activity_last_weeks", f"""
WITH {ACT} SELECT subject_id, day, steps FROM act WHERE day BETWEEN DATE '1998-06-03' AND DATE '1998-07-01'""")
def q_activity_last_weeks(spark, sf):
    """the 28 days up to a stated day."""
    return act_s(spark, sf).where(lookback_window("day", "1998-07-01", 28)).select("subject_id", "day", "steps")


@register("rounded_means", f"""
WITH {ACT}
SELECT subject_id, CAST(year(day) AS INTEGER) AS year, round(avg(sleep_hours) + 1e-9, 1) AS sleep, round(avg(steps) + 1e-9, 0) AS steps,
  round(avg(calories) + 1e-9, 3) AS calories
FROM act GROUP BY ALL""", ["sleep", "steps", "calories"])
def q_rounded_means(spark, sf):
    """stated digits."""
    a = act_s(spark, sf).groupBy("subject_id", F.year("day").alias("year")).agg(
        F.avg("sleep_hours").alias("s"), F.avg("steps").alias("t"), F.avg("calories").alias("c"))
    tie = F.lit(1e-9)
    return a.select("subject_id", "year", round_to(F.col("s") + tie, 1).alias("sleep"), round_to(F.col("t") + tie, 0).alias("steps"),
                    round_to(F.col("c") + tie, 3).alias("calories"))


@register("renamed_projection", f"""
WITH {ACT}
SELECT day, subject_id, CAST(steps AS INTEGER) AS schritte, CAST(floor(sleep_hours) AS BIGINT) AS sleep_hours, CAST(NULL AS VARCHAR) AS note
FROM act""")
def q_renamed_projection(spark, sf):
    """X19 + X20: renamed, dropped, reordered; cast to a schema with a column that is not there."""
    from pyspark.sql.types import StructType

    a = act_s(spark, sf).withColumn("sleep_hours", F.floor("sleep_hours"))
    r = X.rename_drop(a, {"steps": "schritte"}, drop=("calories", "met_minutes", "sleep_quality"), order=["day", "subject_id", "schritte", "sleep_hours"])
    return X.typed_projection(r, StructType.fromDDL("day date, subject_id long, schritte int, sleep_hours long, note string"))


@register("latest_sessions", f"""
WITH {WIDE} SELECT subject_id, day, duration_min, distance_km FROM wide
ORDER BY day DESC, subject_id, duration_min DESC, distance_km LIMIT 25""", ["duration_min", "distance_km"])
def q_latest_sessions(spark, sf):
    """The first 25 sessions in a stated order (the limit is the feature)."""
    w = wide_sessions(spark, sf).select("subject_id", "day", "duration_min", "distance_km")
    return TK.preview(w, 25, [F.desc("day"), "subject_id", F.desc("duration_min"), "distance_km"])


@register("sports_present", f"WITH {WIDE} SELECT DISTINCT year, sport FROM wide")
def q_sports_present(spark, sf):
    """Years and sports that occur."""
    return TK.distinct_values(wide_sessions(spark, sf), ["year", "sport"])


@register("hrv_new_days", f"""
WITH {PPI_LI},
{daily_hrv_sql('hrvl_d', 'ppil_s', PPI_LI_ORDER)}
SELECT subject_id, day, rmssd, n_samples FROM hrvl_d WHERE NOT (day(day) <= 10 AND year(day) < 1997)""", ["rmssd"])
def q_hrv_new_days(spark, sf):
    """A03 + J07: days that the table knows are left out before anything is computed."""
    s = A.ppi_samples_lines(spark, sf)
    known = s.select("subject_id", "day").where((F.dayofmonth("day") <= 10) & (F.year("day") < 1997)).distinct()
    rows = INC.known_days_removed(s, known)
    order = ["l_orderkey", "l_linenumber", "l_partkey", "ppi"]
    chunk = [F.floor(F.col("l_orderkey") / 1024), F.floor(F.col("l_orderkey") / (1 << 20))]
    return daily.daily_hrv(rows, order=order, chunk=chunk, digits=None, mean_digits=None, hr_digits=None).select(
        "subject_id", "day", "rmssd", "n_samples")


# ------------------------------------------------------------------------------------------------------- API rows
@register("api_physical_info", """
WITH p AS (
  SELECT CAST(o_custkey % 5 AS BIGINT) AS subject_id,
    CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) ELSE DATE '2024-05-05' END AS day, o_orderkey % 50 + 50 AS w
  FROM orders)
SELECT subject_id, day, CAST(min(CAST(w AS VARCHAR)) AS VARCHAR) AS least FROM p GROUP BY ALL""")
def q_api_physical_info(spark, sf):
    """The day of ``created``, else the stated ingest day; one payload a day (the first text)."""
    o = A.table(spark, sf, "orders")
    w = (F.pmod("o_orderkey", F.lit(50)) + 50).cast("string")
    doc = F.to_json(F.struct(w.alias("a_weight"), F.when(F.pmod("o_orderkey", F.lit(7)) != 0,
                                                         F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("created")))
    p = o.select(A._subject("o_custkey"), doc.alias("json_text")).select(
        "subject_id", "json_text", JD.once(F.from_json("json_text", S.API_PHYSICAL)).alias("p")).select("subject_id", "json_text", "p.*")
    return AX.api_physical_info(p, "2024-05-05").select("subject_id", "day", F.get_json_object("json_data", "$.a_weight").alias("least"))


@register("api_recharge", """
WITH r AS (
  SELECT CAST(o_custkey % 5 AS BIGINT) AS subject_id, CAST(o_orderdate AS DATE) AS day, CAST(o_orderkey % 9 AS DOUBLE) AS ans FROM orders)
SELECT subject_id, 'nightly_recharge_' || CAST(day AS VARCHAR) AS file_name, 'nightly_recharge' AS category, day, min(ans) AS ans
FROM r GROUP BY ALL""", ["ans"])
def q_api_recharge(spark, sf):
    """One raw document per night."""
    o = A.table(spark, sf, "orders")
    night = F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
                     F.pmod("o_orderkey", F.lit(9)).cast("double").alias("ans-charge"))
    p = o.select(A._subject("o_custkey"), F.to_json(F.struct(F.array(night).alias("recharges"))).alias("json_text")).select(
        "subject_id", JD.once(F.from_json("json_text", S.API_RECHARGE)).alias("p")).select("subject_id", "p.*")
    return AX.api_recharge(p).select("subject_id", "file_name", "category", "day",
                                     F.get_json_object("json_data", "$.ans-charge").cast("double").alias("ans"))


# --------------------------------------------------------------------------------------------------------- merges
def _first_sql(name: str, source: str, keys: list[str], others: list[str]) -> str:
    """One row per key: the first by the other columns, nulls last."""
    order = ", ".join(f"{c} ASC NULLS LAST" for c in others)
    return f"""{name} AS (SELECT * FROM {source} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) = 1)"""


def merge_sql(ctes: str, target: str, source: str, keys: list[str], others: list[str], watched: list[str] | None) -> str:
    """Plain SQL of a merge: insert what is new, replace what differs, keep the rest, with the action."""
    differs = "TRUE" if watched is None else " OR ".join(f"coalesce(t.{c} <> s.{c}, FALSE)" for c in watched) or "FALSE"
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    picks = ", ".join(f"CASE WHEN _action IN ('inserted', 'updated') THEN s_{c} ELSE t_{c} END AS {c}" for c in others)
    return f"""WITH {ctes},
{_first_sql('_t', target, keys, others)},
{_first_sql('_s', source, keys, others)},
_j AS (SELECT {', '.join(f'coalesce(t.{k}, s.{k}) AS {k}' for k in keys)},
  CASE WHEN t.{keys[0]} IS NULL THEN 'inserted' WHEN s.{keys[0]} IS NULL THEN 'kept' WHEN {differs} THEN 'updated' ELSE 'unchanged' END AS _action,
  {', '.join(f't.{c} AS t_{c}, s.{c} AS s_{c}' for c in others)}
  FROM _t t FULL JOIN _s s ON {on})
SELECT {', '.join(keys)}, {picks}, _action AS action FROM _j"""


# every row stands in the table, in the source or in both, so that each action occurs


def _merged(spark, table: str, target: DataFrame, source: DataFrame, **how) -> DataFrame:
    """The merge of a known table with its keys and watched columns."""
    _schema, keys, watched = S.TABLES[table]
    how = {"watched": watched, **how}
    return UP.merge_plan(UP.dedupe_source(target, keys), source, keys, **how).withColumnRenamed("_action", "action")


TRAIN_KEYS = ["subject_id", "start_ts", "ordinal"]
TRAIN_OTHERS = ["sport", "duration_min"]
TRAIN_MERGE = f"""o AS (
  SELECT CAST(o_custkey % 5 AS BIGINT) AS subject_id, o_orderdate + to_seconds(o_orderkey % 86400) AS start_ts,
    CAST(o_orderkey % 3 AS INTEGER) AS ordinal, {_array_sql(WIDE_SPORTS)}[CAST(o_orderkey % 7 AS INTEGER) + 1] AS sport,
    CAST(10 + o_orderkey % 90 AS DOUBLE) AS duration_min, o_orderkey FROM orders),
tg AS (SELECT subject_id, start_ts, ordinal, sport, duration_min FROM o WHERE o_orderkey % 4 <> 0),
sr AS (SELECT subject_id, start_ts, ordinal, sport, duration_min + o_orderkey % 2 AS duration_min FROM o WHERE o_orderkey % 4 <> 1)"""


def _train(spark, sf):
    o = A.table(spark, sf, "orders")
    key = F.col("o_orderkey")
    rows = o.select(A._subject("o_custkey"), add_seconds(F.col("o_orderdate").cast("timestamp"), F.pmod(key, F.lit(86400)).cast("int")).alias("start_ts"),
                    F.pmod(key, F.lit(3)).cast("int").alias("ordinal"),
                    F.get(F.array(*map(F.lit, WIDE_SPORTS)), F.pmod(key, F.lit(7)).cast("int")).alias("sport"),
                    (F.lit(10) + F.pmod(key, F.lit(90))).cast("double").alias("duration_min"), key.alias("k"))
    cols = [*TRAIN_KEYS, *TRAIN_OTHERS]
    return (rows.where(F.pmod("k", F.lit(4)) != 0).select(*cols),
            rows.withColumn("duration_min", F.col("duration_min") + F.pmod("k", F.lit(2))).where(F.pmod("k", F.lit(4)) != 1).select(*cols))


@register("merge_training", merge_sql(TRAIN_MERGE, "tg", "sr", TRAIN_KEYS, TRAIN_OTHERS, None), ["duration_min"])
def q_merge_training(spark, sf):
    """Sessions by (subject, start, ordinal); a match is replaced."""
    return _merged(spark, "training", *_train(spark, sf))


@register("append_new_sessions", f"""WITH {TRAIN_MERGE}
SELECT sr.subject_id, count(*) AS n FROM sr WHERE NOT EXISTS (SELECT 1 FROM tg WHERE tg.subject_id = sr.subject_id
  AND tg.start_ts = sr.start_ts AND tg.ordinal = sr.ordinal) GROUP BY sr.subject_id""")
def q_append_new_sessions(spark, sf):
    """Only what the table lacks."""
    target, source = _train(spark, sf)
    return UP.insert_only(target, source, TRAIN_KEYS).groupBy("subject_id").agg(F.count(F.lit(1)).alias("n"))


HR_MERGE = f"""{HR_DAILY_LI},
tg AS (SELECT subject_id, day, CASE WHEN day(day) % 3 = 0 THEN resting_hr + 1 WHEN day(day) % 7 = 0 THEN NULL ELSE resting_hr END AS resting_hr, hr_mean
       FROM hrl_d WHERE day(day) <> 5),
sr AS (SELECT subject_id, day, resting_hr, hr_mean FROM hrl_d WHERE day(day) <> 6)"""


@register("merge_heartrate", merge_sql(HR_MERGE, "tg", "sr", ["subject_id", "day"], ["resting_hr", "hr_mean"], ["resting_hr"]),
          ["resting_hr", "hr_mean"])
def q_merge_heartrate(spark, sf):
    """Daily heart rates; a day is replaced when its resting HR differs."""
    hr = hr_daily_lines(spark, sf).select("subject_id", "day", "resting_hr", "hr_mean")
    d = F.dayofmonth("day")
    target = hr.where(d != 5).withColumn("resting_hr", F.when(d % 3 == 0, F.col("resting_hr") + 1)
                                         .when(d % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("resting_hr")))
    return _merged(spark, "heartrate", target, hr.where(d != 6))


HRV_MERGE = f"""{HRV_DAILY_LI},
tg AS (SELECT subject_id, day, CASE WHEN day(day) % 4 = 0 THEN rmssd + 1 ELSE rmssd END AS rmssd, n_samples FROM hrvl_d WHERE day(day) <> 9),
sr AS (SELECT subject_id, day, rmssd, n_samples + 1 AS n_samples FROM hrvl_d WHERE day(day) <> 10)"""


@register("merge_hrv", merge_sql(HRV_MERGE, "tg", "sr", ["subject_id", "day"], ["rmssd", "n_samples"], ["rmssd"]), ["rmssd"])
def q_merge_hrv(spark, sf):
    """Daily HRV; a day is replaced when its RMSSD differs."""
    v = hrv_daily_lines(spark, sf).select("subject_id", "day", "rmssd", "n_samples").persist()
    d = F.dayofmonth("day")
    target = v.where(d != 9).withColumn("rmssd", F.when(d % 4 == 0, F.col("rmssd") + 1).otherwise(F.col("rmssd")))
    return _merged(spark, "hrv", target, v.where(d != 10).withColumn("n_samples", F.col("n_samples") + 1))


FIT_MERGE = """f AS (SELECT CAST(o_custkey % 5 AS BIGINT) AS subject_id, CAST(o_orderdate AS DATE) AS day,
  CAST(20 + o_orderkey % 60 AS DOUBLE) AS own_index, o_orderpriority AS fitness_class, o_orderkey FROM orders),
tg AS (SELECT subject_id, day, own_index, fitness_class FROM f WHERE o_orderkey % 3 <> 0),
sr AS (SELECT subject_id, day, own_index, fitness_class FROM f WHERE o_orderkey % 3 <> 1)"""


@register("merge_fitness", merge_sql(FIT_MERGE, "tg", "sr", ["subject_id", "day"], ["own_index", "fitness_class"], None), ["own_index"])
def q_merge_fitness(spark, sf):
    """L11 + L20: fitness tests by day, repeated source rows reduced to one."""
    o = A.table(spark, sf, "orders")
    rows = o.select(A._subject("o_custkey"), F.to_date("o_orderdate").alias("day"),
                    (F.lit(20) + F.pmod("o_orderkey", F.lit(60))).cast("double").alias("own_index"),
                    F.col("o_orderpriority").alias("fitness_class"), "o_orderkey")
    return _merged(spark, "fitness_tests", rows.where(F.pmod("o_orderkey", F.lit(3)) != 0).drop("o_orderkey"),
                   rows.where(F.pmod("o_orderkey", F.lit(3)) != 1).drop("o_orderkey"))


JSON_MERGE = """d AS (SELECT CAST(doc_id % 5 AS BIGINT) AS subject_id, DATE '2020-01-01' + CAST(doc_id AS INTEGER) AS day, text AS json_data, doc_id FROM documents),
tg AS (SELECT subject_id, CAST(day AS DATE) AS day, md5(coalesce(json_data, '')) AS json_data FROM d WHERE doc_id % 3 <> 0),
sr AS (SELECT subject_id, CAST(day AS DATE) AS day, md5(coalesce(json_data, '') || 'x') AS json_data FROM d WHERE doc_id % 3 <> 1)"""


@register("merge_daily_json", merge_sql(JSON_MERGE, "tg", "sr", ["subject_id", "day"], ["json_data"], None))
def q_merge_daily_json(spark, sf):
    """A day's JSON, replaced on a match."""
    d = A.table(spark, sf, "documents").select(
        A._subject("doc_id"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("doc_id").cast("int")).alias("day"),
        F.coalesce("text", F.lit("")).alias("t"), "doc_id")
    pick = lambda out, tail: (d.where(F.pmod("doc_id", F.lit(3)) != out)
                            .select("subject_id", "day", F.md5(F.concat("t", F.lit(tail))).alias("json_data")))
    return _merged(spark, "physical_info", pick(0, ""), pick(1, "x"))


DOC_KEYS, DOC_OTHERS = ["subject_id", "file_name"], ["category", "json_data"]
DOC_MERGE = """d AS (SELECT CAST(doc_id % 5 AS BIGINT) AS subject_id, source || '-' || CAST(doc_id AS VARCHAR) AS file_name,
  lang AS category, coalesce(text, '') AS t, doc_id FROM documents),
tg AS (SELECT subject_id, file_name, category, sha256(t) AS json_data FROM d WHERE doc_id % 3 <> 0),
sr AS (SELECT subject_id, file_name, category, sha256(CASE WHEN doc_id % 2 = 0 THEN t || '!' ELSE t END) AS json_data FROM d WHERE doc_id % 3 <> 1)"""


@register("merge_documents", merge_sql(DOC_MERGE, "tg", "sr", DOC_KEYS, DOC_OTHERS, None))
def q_merge_documents(spark, sf):
    """Whole documents by file name."""
    d = A.table(spark, sf, "documents").select(
        A._subject("doc_id"), F.concat(F.col("source"), F.lit("-"), F.col("doc_id").cast("string")).alias("file_name"),
        F.col("lang").alias("category"), F.coalesce("text", F.lit("")).alias("t"), "doc_id")
    target = d.where(F.pmod("doc_id", F.lit(3)) != 0).select("subject_id", "file_name", "category", F.sha2("t", 256).alias("json_data"))
    text = F.when(F.pmod("doc_id", F.lit(2)) == 0, F.concat("t", F.lit("!"))).otherwise(F.col("t"))
    source = d.where(F.pmod("doc_id", F.lit(3)) != 1).select("subject_id", "file_name", "category", F.sha2(text, 256).alias("json_data"))
    return _merged(spark, "raw_documents", target, source)


LOG_MERGE = """d AS (SELECT CAST(doc_id % 5 AS BIGINT) AS subject_id, 'f-' || CAST(doc_id AS VARCHAR) AS file_name, md5(coalesce(text, '')) AS hash_md5, doc_id FROM documents),
tg AS (SELECT subject_id, file_name, hash_md5, 'old' AS category FROM d WHERE doc_id % 3 <> 0),
sr AS (SELECT subject_id, file_name, hash_md5, 'new' AS category FROM d WHERE doc_id % 3 <> 1)"""


@register("merge_import_log", merge_sql(LOG_MERGE, "tg", "sr", DOC_KEYS, ["hash_md5", "category"], None))
def q_merge_import_log(spark, sf):
    """The import log, a file's newest entry wins."""
    d = A.table(spark, sf, "documents").select(
        A._subject("doc_id"), F.concat(F.lit("f-"), F.col("doc_id").cast("string")).alias("file_name"),
        F.md5(F.coalesce("text", F.lit(""))).alias("hash_md5"), "doc_id")
    return _merged(spark, "import_log", d.where(F.pmod("doc_id", F.lit(3)) != 0).drop("doc_id").withColumn("category", F.lit("old")),
                   d.where(F.pmod("doc_id", F.lit(3)) != 1).drop("doc_id").withColumn("category", F.lit("new")))


# ---------------------------------------------------------------------------------------------- late samples
PARTS = 4


@register("streaming_late_samples", f"""
WITH {HR_EV},
p AS (SELECT *, event_id % {PARTS} AS part FROM hr_s),
seen AS (SELECT q AS part, (SELECT max(ts) FROM p WHERE p.part < q) AS high FROM range(0, {PARTS}) r(q)),
l AS (SELECT p.subject_id, p.day, count(*) AS n_late FROM p JOIN seen USING (part)
      WHERE p.day + INTERVAL 1 DAY <= seen.high - INTERVAL 2 DAY GROUP BY ALL),
b AS (SELECT subject_id, day, quantile_cont(hr, 0.05) AS resting_hr, avg(hr) AS hr_mean, CAST(max(hr) AS INTEGER) AS hr_max,
        count(*) AS n_samples FROM hr_s GROUP BY ALL)
SELECT b.*, CAST(coalesce(l.n_late, 0) AS BIGINT) AS n_late FROM b LEFT JOIN l USING (subject_id, day)""", ["resting_hr", "hr_mean"])
def q_streaming_late_samples(spark, sf):
    """Samples arrive in four files out of order; late ones are counted, and the closing run with
    them gives the table of a batch over all samples."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/results/open_days/{uuid.uuid4().hex}"
    hr = A.hr_samples_events(spark, sf)
    for k in range(PARTS):  # arrival order: one file after the other
        (hr.where(F.pmod("event_id", F.lit(PARTS)) == k).select("subject_id", "ts", "hr").coalesce(1)
         .write.mode("append").parquet(f"{root}/arrivals"))
    st = (spark.readStream.schema("subject_id long, ts timestamp, hr int").option("maxFilesPerTrigger", 1)
          .parquet(f"{root}/arrivals"))
    OD.open_days_stream(spark, st, f"{root}/tables", name=f"open_days_{uuid.uuid4().hex}")
    table = OD.daily_table(spark, f"{root}/tables", with_open=True, with_late=True)
    return (table.join(OD.late_samples(spark, f"{root}/tables"), ["subject_id", "day"], "left")
            .withColumn("n_late", F.coalesce("n_late", F.lit(0)).cast("long")))
