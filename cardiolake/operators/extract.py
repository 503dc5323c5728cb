"""Flatten parsed export documents into table rows.

Inputs are the output of ``sources.json_docs.parse_documents``: one row per
file with ``subject_id, file_name, doc`` (the typed document). Every step is
a projection or an ``explode`` of a row's own arrays, so the work is
row-local and partitions like the files do.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructType

from cardiolake.dims import (PACE_LIMIT_MIN_PER_KM, PACE_RELABEL_SPORTS, SPORT_CATEGORY,
                             SPORT_IDS, TREADMILL_MARKERS, map_expr)
from cardiolake.functions.convert import falsy_fallback, round_to, safe_double, safe_int, safe_long
from cardiolake.functions.dates import add_seconds, utc_timestamp, weekday_name
from cardiolake.functions.durations import iso_duration_minutes, time_part, time_part_minutes
from cardiolake.operators.windows import first_per_key


def _day_of(text: Column) -> Column:
    return F.to_date(utc_timestamp(text))


def decode_sport(s: Column) -> Column:
    """Sport given as a name or as ``{"id": ..}`` -> sport name.

    The field is read as text: an object arrives as its JSON text. Ids map
    through the fixed id table, unknown ids become ``ID_<id>``; a name has
    blanks and single quotes stripped; empty or absent -> UNKNOWN.
    """
    sid = F.coalesce(F.get_json_object(s, "$.id"), F.get_json_object(s, "$.ID"), F.lit(""))
    name = F.replace(F.trim(s), F.lit("'"), F.lit(""))
    return (F.when(s.isNull(), F.lit("UNKNOWN"))
            .when(F.startswith(s, F.lit("{")),
                  F.coalesce(map_expr(SPORT_IDS, sid), F.concat(F.lit("ID_"), sid)))
            .when(name == "", F.lit("UNKNOWN"))
            .otherwise(name))


def classify_training(df: DataFrame, sport: str = "sport_raw", name: str = "name",
                      duration: str = "duration_min", distance: str = "distance_km") -> DataFrame:
    """Pace relabel (X05) and category (X04), applied to every session row.

    HIKING/WALKING slower than 10 min/km stays, faster becomes RUNNING;
    a treadmill name wins the category; TRAIL_RUNNING becomes RUNNING/TRAIL;
    RUNNING is OUTDOOR; the rest comes from the fixed category table.
    The relabelled sport is a named column so the CASE is generated once.
    """
    s0, dur, dist = F.col(sport), F.col(duration), F.col(distance)
    fast = (s0.isin(*PACE_RELABEL_SPORTS) & (dist != 0) & (dur != 0)
            & (F.try_divide(dur, dist) < PACE_LIMIT_MIN_PER_KM))
    nm = F.col("_nm")
    tread = None
    for m in TREADMILL_MARKERS:
        tread = nm.contains(m) if tread is None else (tread | nm.contains(m))
    staged = (df.withColumn("_nm", F.lower(F.trim(F.coalesce(F.col(name), F.lit("")))))
              .withColumn("_s1", F.when(fast, F.lit("RUNNING")).otherwise(s0)).withColumn("_tread", tread))
    s1 = F.col("_s1")
    cat = (F.when(F.col("_tread"), F.lit("TREADMILL"))
           .when(s1 == "TRAIL_RUNNING", F.lit("TRAIL"))
           .when(s1 == "RUNNING", F.lit("OUTDOOR"))
           .otherwise(map_expr(SPORT_CATEGORY, s1)))
    out = F.when(s1 == "TRAIL_RUNNING", F.lit("RUNNING")).otherwise(s1)
    return staged.withColumn("category", cat).withColumn("sport", out).drop("_s1", "_tread", "_nm")


def _r(c: Column, digits: int, on: bool) -> Column:
    return F.round(c, digits) if on else c


def flatten_activity(docs: DataFrame, round_values: bool = True) -> DataFrame:
    """One activity row per file with a date; one row kept per subject-day
    (first file name). Sleep ``PT..S`` -> hours; zero or empty sleep -> NULL."""
    d = F.col("doc")
    sleep_min = iso_duration_minutes(d["summary"]["sleepDuration"], 4 if round_values else None)
    rows = docs.select(
        "subject_id", "file_name",
        _day_of(d["date"]).alias("day"),
        safe_int(d["summary"]["stepCount"]).cast("long").alias("steps"),
        safe_double(d["summary"]["calories"]).alias("calories"),
        F.when(sleep_min != 0, _r(sleep_min / 60.0, 2, round_values)).alias("sleep_hours"),
        safe_double(d["summary"]["sleepQuality"]).alias("sleep_quality"),
        safe_double(d["summary"]["dailyMetMinutes"]).alias("met_minutes"),
    ).where(F.col("day").isNotNull())
    return first_per_key(rows, ["subject_id", "day"], [("file_name", False, False)]).drop("file_name")


def explode_training(docs: DataFrame, round_values: bool = True) -> DataFrame:
    """One row per exercise; a session without exercises gives one row
    from its own fields. Exercise values of 0/NULL fall back to the session's."""
    d = F.col("doc")
    start = utc_timestamp(d["startTime"])
    base = docs.select(
        "subject_id", "file_name", "doc",
        start.alias("start_ts"),
        F.coalesce(falsy_fallback(safe_double(d["durationMillis"]), F.lit(0.0)), F.lit(0.0)).alias("_dur_top"),
        F.coalesce(falsy_fallback(safe_double(d["distanceMeters"]), F.lit(0.0)), F.lit(0.0)).alias("_dist_top"),
        safe_double(d["calories"]).alias("_kcal_top"),
        safe_double(d["hrAvg"]).alias("_hra_top"),
        safe_double(d["hrMax"]).alias("_hrm_top"),
        d["sport"].alias("_sport_top"),
    ).where(F.col("start_ts").isNotNull())
    ex_rows = base.select("*", F.posexplode_outer(F.col("doc")["exercises"]).alias("_pos", "_ex"))
    ex = F.col("_ex")
    rv = round_values
    # stage 1: per-exercise values after the session fallback, each computed once (without an exercise its fields
    # are NULL and the session's stay). The steps after the explode make one generated method, which the JVM leaves
    # uncompiled above 8,000 bytes: conversions that are written once keep it below
    st1 = ex_rows.select(
        "subject_id", "file_name", "start_ts", "_pos", ex.isNull().alias("_no_ex"),
        F.col("doc")["name"].alias("name"),
        falsy_fallback(safe_double(F.coalesce(ex["distanceMeters"], ex["distance"])), F.col("_dist_top")).alias("_dist_m"),
        falsy_fallback(safe_double(ex["durationMillis"]), F.col("_dur_top")).alias("_dur_ms"),
        time_part(ex["duration"]).alias("_iso"),
        decode_sport(F.coalesce(ex["sport"], F.col("_sport_top"))).alias("sport_raw"),
        falsy_fallback(safe_double(ex["heartRate"]["average"]), F.col("_hra_top")).alias("hr_avg"),
        falsy_fallback(safe_double(ex["heartRate"]["maximum"]), F.col("_hrm_top")).alias("hr_max"),
        falsy_fallback(safe_double(ex["calories"]), F.col("_kcal_top")).alias("calories"),
    )
    dur_ms, dist_m = F.col("_dur_ms"), F.col("_dist_m")
    dur_min = (F.when(dur_ms != 0, _r(dur_ms / 60000.0, 2, rv))
               .when(F.col("_no_ex"), F.lit(None).cast("double"))
               .otherwise(time_part_minutes(F.col("_iso"), 4 if rv else None)))
    rows = st1.select(
        "subject_id", "file_name", "start_ts",
        F.to_date("start_ts").alias("day"),
        F.coalesce(F.col("_pos"), F.lit(0)).alias("ordinal"),
        "sport_raw", "name",
        dur_min.alias("duration_min"),
        "hr_avg", "hr_max",
        F.when(F.coalesce(dist_m, F.lit(0.0)) != 0, _r(dist_m / 1000.0, 3, rv)).alias("distance_km"),
        "calories",
    )
    t = classify_training(rows)
    return t.select("subject_id", "day", "start_ts", "ordinal", "sport", "category", "duration_min",
                    "hr_avg", "hr_max", "distance_km", "calories",
                    weekday_name("day").alias("weekday"), F.year("day").alias("year"), "file_name")


def explode_hr_samples(docs: DataFrame, lo: int = 20, hi: int = 250, keep: tuple[str, ...] = ()) -> DataFrame:
    """``deviceDays[].samples[]`` -> one row per sample within ``lo..hi`` bpm, with the document's ``keep`` columns."""
    days = docs.select("subject_id", "file_name", *keep,
                       F.posexplode(F.col("doc")["deviceDays"]).alias("day_idx", "dd"))
    s = days.select("subject_id", "file_name", "day_idx", *keep,
                    F.to_date(utc_timestamp(F.col("dd")["date"])).alias("day"),
                    F.posexplode(F.col("dd")["samples"]).alias("pos", "s"))
    hr = safe_int(F.col("s")["heartRate"])
    seconds = F.floor(safe_double(F.col("s")["secondsFromDayStart"])).try_cast("int")
    return (s.select("subject_id", "day", "file_name", "day_idx", "pos", seconds.alias("seconds_from_day_start"), hr.alias("hr"),
                     *keep)
            .withColumn("ts", add_seconds(F.col("day").cast("timestamp"), "seconds_from_day_start"))
            .where(F.col("day").isNotNull() & F.col("hr").between(lo, hi)))


def explode_ppi_samples(docs: DataFrame, lo: int = 300, hi: int = 2000, keep: tuple[str, ...] = ()) -> DataFrame:
    """``[entry].devicePpiSamplesList[].ppiSamples[]`` with ordinals kept
    (``file_name, entry, device, pos`` is the sample order used for RMSSD), and the document's ``keep`` columns."""
    e = docs.select("subject_id", "file_name", *keep, F.posexplode(F.col("doc")).alias("entry", "en"))
    dv = e.select("subject_id", "file_name", "entry", *keep,
                  F.to_date(utc_timestamp(F.col("en")["date"])).alias("day"),
                  F.posexplode(F.col("en")["devicePpiSamplesList"]).alias("device", "dev"))
    s = dv.select("subject_id", "file_name", "entry", "day", "device", *keep,
                  F.posexplode(F.col("dev")["ppiSamples"]).alias("pos", "p"))
    ppi = safe_int(F.col("p")["pulseLength"])
    return (s.select("subject_id", "day", "file_name", "entry", "device", "pos", ppi.alias("ppi"), *keep)
            .where(F.col("day").isNotNull() & F.col("ppi").between(lo, hi)))


def ppi_chunk(block: int = 4096) -> list[Column]:
    """Chunk levels for document-ordered pulse intervals (monotone in sample order):
    blocks of positions within a device list, then whole files."""
    return [F.struct("file_name", "entry", "device", F.floor(F.col("pos") / block).alias("blk")),
            F.col("file_name")]


def flatten_fitness(docs: DataFrame) -> DataFrame:
    """Fitness test -> 17 typed columns; best own index kept per day."""
    d = F.col("doc")
    r = d["fitnessTestResult"]
    p = r["physicalInformation"]
    rows = docs.select(
        "subject_id",
        F.to_date(utc_timestamp(d["startTime"])).alias("day"),
        safe_double(r["ownIndex"]).alias("own_index"),
        safe_double(r["averageHeartRate"]).alias("avg_hr"),
        F.coalesce(r["fitnessClass"], F.lit("")).alias("fitness_class"),
        safe_int(r["timezoneOffsetMinutes"]).alias("timezone_offset"),
        F.to_date(utc_timestamp(p["birthday"])).alias("birthday"),
        F.coalesce(p["sex"], F.lit("")).alias("sex"),
        safe_double(p["height"]).alias("height"),
        safe_double(p["weight"]).alias("weight"),
        safe_int(p["maximumHeartRate"]).alias("max_hr"),
        safe_int(p["restingHeartRate"]).alias("resting_hr"),
        safe_int(p["aerobicThreshold"]).alias("aerobic_threshold"),
        safe_int(p["anaerobicThreshold"]).alias("anaerobic_threshold"),
        safe_double(p["vo2Max"]).alias("vo2max"),
        F.coalesce(p["trainingBackground"], F.lit("")).alias("training_background"),
        F.coalesce(p["weightSource"], F.lit("")).alias("weight_source"),
        safe_long(p["sleepGoal"]).alias("sleep_goal"),
        "file_name",
    ).where(F.col("day").isNotNull())
    best = first_per_key(rows, ["subject_id", "day"], [("own_index", True, True), ("file_name", False, False)])
    return best.drop("file_name")


def keep_document(files: DataFrame, text: str = "text", category: str = "category") -> DataFrame:
    """Keep a document whole; day = first parseable of startTime, created, date."""
    v = F.try_parse_json(F.col(text))
    day = F.to_date(F.coalesce(*[utc_timestamp(F.try_variant_get(v, f"$.{k}", "string"))
                                 for k in ("startTime", "created", "date")]))
    return files.select("subject_id", "file_name", category, day.alias("day"),
                        F.col(text).alias("json_data"))


def expand_json_column(df: DataFrame, col: str, schema: str, keep: list[str] | None = None) -> DataFrame:
    """JSON text column -> flat columns (absent fields are NULL)."""
    parsed = F.from_json(F.col(col), schema)
    rest = keep if keep is not None else [c for c in df.columns if c != col]
    return df.select(*rest, parsed.alias("_j")).select(*rest, "_j.*")


def _ddl(variant_schema: str) -> str:
    """Schema as ``schema_of_variant_agg`` writes it -> DDL: objects are structs, whole and decimal numbers
    longs and doubles; what has no single type (conflicts, only nulls) stays text."""
    def swap(m: re.Match) -> str:
        if m.group("name"):
            return m.group(0)
        word = m.group("type")
        return {"OBJECT": "STRUCT", "VARIANT": "STRING", "VOID": "STRING"}.get(word, "DOUBLE" if m.group("size") else word)

    return re.sub(r"(?P<name>`(?:[^`]|``)*`\s*:|\w+\s*:)|(?P<type>\b[A-Z]+\b)(?P<size>\(\d+,\s*\d+\))?", swap, variant_schema)


def discover_schema(df: DataFrame, col: str) -> StructType | None:
    """The one schema that holds the JSON objects of all rows, or None if there is no object.

    An aggregate merges the types of the rows of a task, then those of the tasks; the driver sees the
    schema alone. Text that is no JSON is passed over.
    """
    v = F.try_parse_json(F.col(col))
    found = df.agg(F.schema_of_variant_agg(F.when(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), v)).alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT"):
        return None
    kind = DataType.fromDDL(_ddl(found))
    return kind if isinstance(kind, StructType) and kind.fields else None


def expand_discovered(df: DataFrame, col: str, wanted: list[str] | None = None, nested: bool = False,
                      joint: str = ".") -> DataFrame:
    """JSON text column -> one column for each field that occurs (of ``wanted``, those that do).

    Columns of the same name as a field are replaced by it. A field whose types conflict keeps its
    JSON text. With ``nested`` the fields of objects become columns ``a.b`` (``joint`` between the names).
    """
    schema = discover_schema(df, col)
    if schema is None:
        return df.drop(col)
    flat: list[tuple[str, Column]] = []

    def walk(fields, base: Column, prefix: str):
        for f in fields:
            if nested and isinstance(f.dataType, StructType):
                walk(f.dataType.fields, base.getField(f.name), f"{prefix}{f.name}{joint}")
            else:
                flat.append((f"{prefix}{f.name}", base.getField(f.name)))

    walk(schema.fields, F.col("_j"), "")
    if wanted is not None:
        flat = [(n, c) for n, c in flat if n in wanted]
    names = {n for n, _ in flat}
    rest = [c for c in df.columns if c != col and c not in names]
    return df.withColumn("_j", F.from_json(F.col(col), schema)).select(
        *[F.col(f"`{c}`") for c in rest], *[c.alias(n) for n, c in flat])


def hr_duration_pairs(training: DataFrame) -> DataFrame:
    """Sessions with both heart-rate values present."""
    return training.dropna(subset=["hr_avg", "hr_max"]).select(
        "subject_id", "day", "sport", "duration_min", "hr_avg", "hr_max")


def date_span(df: DataFrame, day: str = "day", group=("subject_id",)) -> DataFrame:
    """first/last day and the span in days, per subject."""
    return df.groupBy(*group).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day")) \
        .withColumn("span_days", F.datediff("last_day", "first_day"))


def rename_drop(df: DataFrame, rename: dict[str, str] | None = None, drop=(), order=None) -> DataFrame:
    """Rename, drop and reorder columns."""
    for a, b in (rename or {}).items():
        df = df.withColumnRenamed(a, b)
    df = df.drop(*drop)
    return df.select(*order) if order else df


def typed_projection(df: DataFrame, schema) -> DataFrame:
    """project/cast to a table schema; absent columns are NULL."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.try_cast(f.dataType).alias(f.name) if f.name in df.columns
                    else c.cast(f.dataType).alias(f.name))
    return df.select(*cols)
