"""Rows from web-API payloads.

The API's sport vocabulary and category default differ from the file
export (kept as two separate fixed tables); rows carry ``source='api'``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardiolake.dims import API_CATEGORY, API_SPORT, map_expr
from cardiolake.functions.convert import safe_double, safe_long
from cardiolake.functions.dates import utc_timestamp
from cardiolake.functions.durations import iso_duration_minutes_strict
from cardiolake.operators.windows import best_per_key, first_per_key


def _day10(c: Column) -> Column:
    return F.substring(c, 1, 10).try_cast("date")


def api_activity(p: DataFrame) -> DataFrame:
    """X11: steps / calories / active calories default 0; sleep columns NULL."""
    rows = p.select(
        "subject_id", _day10(F.col("date")).alias("day"),
        F.coalesce(safe_long("steps"), F.lit(0)).alias("steps"),
        F.coalesce(safe_double("calories"), F.lit(0.0)).alias("calories"),
        F.lit(None).cast("double").alias("sleep_hours"),
        F.lit(None).cast("double").alias("sleep_quality"),
        F.coalesce(safe_double("`active-calories`"), F.lit(0.0)).alias("met_minutes"),
    ).where(F.col("day").isNotNull())
    # one row per day; deterministic choice among repeated payloads of a day
    return first_per_key(rows, ["subject_id", "day"],
                         [("steps", True, True), ("calories", True, True), ("met_minutes", True, True)])


def api_sleep(p: DataFrame, digits: int | None = 2) -> DataFrame:
    """Nights -> hours (``digits``) and rating (1-5 scale)."""
    n = p.select("subject_id", F.inline("nights"))
    mins = safe_double("total_sleep_minutes")
    hours = mins / 60.0 if digits is None else F.round(mins / 60.0, digits)
    rows = n.select("subject_id", _day10(F.col("date")).alias("day"),
                    F.when(F.coalesce(mins, F.lit(0.0)) != 0, hours).alias("sleep_hours"),
                    safe_double("continuous_rating").alias("sleep_quality")).where(F.col("day").isNotNull())
    return first_per_key(rows, ["subject_id", "day"], [("sleep_hours", True, True), ("sleep_quality", True, True)])


def activity_with_sleep(activity: DataFrame, sleep: DataFrame) -> DataFrame:
    """API activity left join sleep on (subject, day); sleep columns replaced."""
    a = activity.drop("sleep_hours", "sleep_quality")
    j = a.join(sleep.select("subject_id", "day", "sleep_hours", "sleep_quality"), ["subject_id", "day"], "left")
    return j.select("subject_id", "day", "steps", "calories", "sleep_hours", "sleep_quality", "met_minutes")


def api_sport(sport_raw: Column, detail: Column) -> tuple[Column, Column]:
    """(sport, category) from the API's sport and detailed sport info."""
    raw = F.coalesce(sport_raw, F.lit("OTHER"))
    det = F.upper(F.coalesce(detail, F.lit("")))
    known = map_expr(API_SPORT, det).isNotNull()
    eff = F.when((raw == "OTHER") & (det != "") & known, det).otherwise(raw)
    sport = F.coalesce(map_expr(API_SPORT, eff), eff)
    cat = F.coalesce(map_expr(API_CATEGORY, eff), F.lit("OUTDOOR"))
    return sport, cat


def api_exercise(p: DataFrame, round_values: bool = True, with_start: bool = False) -> DataFrame:
    """One training row per exercise payload (X06 + X05 + F01b). Numbers may come as text.

    ``with_start`` adds ``start_ts``, the table's key beside the subject; it is
    midnight of the day where the payload names no readable time."""
    sport, cat = api_sport(F.col("sport"), F.col("`detailed-sport-info`"))
    dur = iso_duration_minutes_strict(F.coalesce(F.col("duration"), F.lit("")))
    dist = safe_double("distance")
    hr = F.col("`heart-rate`")
    hr_avg, hr_max = safe_double(hr["average"]), safe_double(hr["maximum"])
    start = F.coalesce(utc_timestamp("`start-time`"), _day10(F.col("`start-time`")).cast("timestamp"))
    base = p.select("subject_id", _day10(F.col("`start-time`")).alias("day"),
                    sport.alias("_s"), cat.alias("_c"), dur.alias("_dur"), dist.alias("_dist"),
                    F.when(F.coalesce(hr_avg, F.lit(0.0)) != 0, hr_avg).alias("hr_avg"),
                    F.when(F.coalesce(hr_max, F.lit(0.0)) != 0, hr_max).alias("hr_max"),
                    F.coalesce(safe_double("calories"), F.lit(0.0)).alias("calories"),
                    start.alias("start_ts")).where(F.col("day").isNotNull())
    fast = (F.col("_s").isin("WALKING", "HIKING") & (F.coalesce(F.col("_dist"), F.lit(0.0)) != 0)
            & (F.col("_dur") > 0) & (F.col("_dur") / (F.col("_dist") / 1000.0) < 10))
    r1 = (lambda c: F.round(c, 1)) if round_values else (lambda c: c)
    r3 = (lambda c: F.round(c, 3)) if round_values else (lambda c: c)
    return base.select(
        "subject_id", "day",
        F.when(fast, F.lit("RUNNING")).otherwise(F.col("_s")).alias("sport"),
        F.when(fast, F.lit("OUTDOOR")).otherwise(F.col("_c")).alias("category"),
        r1(F.col("_dur")).alias("duration_min"), "hr_avg", "hr_max",
        F.when(F.coalesce(F.col("_dist"), F.lit(0.0)) != 0, r3(F.col("_dist") / 1000.0)).alias("distance_km"),
        "calories", F.date_format("day", "EEEE").alias("weekday"), F.year("day").alias("year"),
        F.lit("api").alias("source"), *(["start_ts"] if with_start else []))


def api_physical_info(p: DataFrame, ingest_date: str) -> DataFrame:
    """day = first 10 chars of ``created`` (else the explicit ingest date); JSON kept."""
    day = F.coalesce(_day10(F.col("created")), F.lit(ingest_date).cast("date"))
    rows = p.select("subject_id", day.alias("day"), F.col("json_text").alias("json_data"))
    return best_per_key(rows, ["subject_id", "day"], [F.col("json_data")])


def undated(p: DataFrame, endpoint: str) -> DataFrame:
    """Payloads, or nights of one, that no row is made of because their day cannot be read:
    (subject_id, endpoint, hash_md5, reason, json_text). ``p`` carries ``json_text``."""
    if endpoint == "physical_info":  # these fall back to the day of the load
        bad = p.where(F.lit(False)).select("subject_id", "json_text", F.lit("").alias("reason"))
    elif endpoint in ("sleep", "nightly_recharge"):
        field = "nights" if endpoint == "sleep" else "recharges"
        entry = p.select("subject_id", "json_text", F.posexplode_outer(field).alias("_at", "_e"))
        reason = F.when(F.col("_e").isNull(), F.lit(f"no entry in {field}")).otherwise(
            F.concat(F.lit("no day in entry "), F.col("_at").cast("string")))
        bad = entry.where(F.col("_e").isNull() | _day10(F.col("_e")["date"]).isNull()).select("subject_id", "json_text", reason.alias("reason"))
    else:
        day = "start-time" if endpoint == "exercise" else "date"
        bad = p.where(_day10(F.col(f"`{day}`")).isNull()).select("subject_id", "json_text", F.lit(f"no day in {day}").alias("reason"))
    return bad.select("subject_id", F.lit(endpoint).alias("endpoint"), F.md5(F.col("json_text")).alias("hash_md5"), "reason", "json_text")


def api_recharge(p: DataFrame) -> DataFrame:
    """One raw document per night: ``nightly_recharge_<date>``."""
    r = p.select("subject_id", F.explode("recharges").alias("r"))
    rows = r.select("subject_id",
                    F.concat(F.lit("nightly_recharge_"), F.col("r.date")).alias("file_name"),
                    F.lit("nightly_recharge").alias("category"),
                    _day10(F.col("r.date")).alias("day"),
                    F.to_json("r").alias("json_data")).where(F.col("day").isNotNull())
    return best_per_key(rows, ["subject_id", "file_name"], [F.col("json_data")])
