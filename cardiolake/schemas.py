"""Schemas of the incoming JSON documents and of the target tables.

Document schemas read float-valued fields as JSON text (``string``: a number
or a numeric string both arrive as text and ``try_cast`` to double; an object
in a string field arrives as its JSON text, which is how ``sport`` -- a name or
``{"id": ..}`` -- is read). ``variant`` is used only where the JSON type
decides the value: integer fields (``1.9`` -> 1 but ``"1.9"`` -> NULL).
Variant extraction costs far more per value than a string cast.
Every table carries ``subject_id`` so that all work partitions by person.
"""

from pyspark.sql import types as T

# --- documents (schema-on-read, narrow: only fields the extractors use) ---

ACTIVITY_DOC = (
    "date string, summary struct<stepCount: variant, calories: string, "
    "sleepDuration: string, sleepQuality: string, dailyMetMinutes: string>"
)

TRAINING_DOC = (
    "startTime string, sport string, name string, durationMillis string, "
    "distanceMeters string, calories string, hrAvg string, hrMax string, "
    "exercises array<struct<sport: string, durationMillis: string, duration: string, "
    "distanceMeters: string, distance: string, calories: string, "
    "heartRate: struct<average: string, maximum: string>>>"
)

HR_DOC = (
    "deviceDays array<struct<date: string, "
    "samples: array<struct<heartRate: variant, secondsFromDayStart: string>>>>"
)

# array root: an object root becomes a one-element array in from_json
PPI_DOC = (
    "array<struct<date: string, devicePpiSamplesList: array<struct<"
    "ppiSamples: array<struct<pulseLength: variant>>>>>>"
)

FITNESS_DOC = (
    "startTime string, fitnessTestResult struct<ownIndex: string, averageHeartRate: string, "
    "fitnessClass: string, timezoneOffsetMinutes: variant, physicalInformation: struct<"
    "birthday: string, sex: string, height: string, weight: string, maximumHeartRate: variant, "
    "restingHeartRate: variant, aerobicThreshold: variant, anaerobicThreshold: variant, vo2Max: string, "
    "trainingBackground: string, weightSource: string, sleepGoal: variant>>"
)

# --- API payloads (landed JSON) ---

API_ACTIVITY = "date string, steps variant, calories variant, `active-calories` variant"
API_SLEEP = "nights array<struct<date: string, total_sleep_minutes: string, continuous_rating: string>>"
API_EXERCISE = (
    "`start-time` string, sport string, `detailed-sport-info` string, duration string, "
    "distance string, calories string, `heart-rate` struct<average: string, maximum: string>"
)
API_PHYSICAL = "created string"
API_RECHARGE = (
    "recharges array<struct<date: string, `ans-charge`: double, `hrv-avg`: double, "
    "`hrv-diff-from-long-term-avg`: double>>"
)

# --- tables ---

_S, _D, _L, _I, _F, _DT, _TS = (T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(),
                                T.DoubleType(), T.DateType(), T.TimestampType())


def _st(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


ACTIVITY = _st(("subject_id", _L, False), ("day", _DT, False), ("steps", _L, True),
               ("calories", _D, True), ("sleep_hours", _D, True), ("sleep_quality", _D, True),
               ("met_minutes", _D, True))

TRAINING = _st(("subject_id", _L, False), ("day", _DT, False), ("start_ts", _TS, True),
               ("ordinal", _I, True), ("sport", _S, False), ("category", _S, True),
               ("duration_min", _D, True), ("hr_avg", _D, True), ("hr_max", _D, True),
               ("distance_km", _D, True), ("calories", _D, True), ("weekday", _S, True),
               ("year", _I, True))

HEARTRATE = _st(("subject_id", _L, False), ("day", _DT, False), ("resting_hr", _D, True),
                ("hr_mean", _D, True), ("hr_max", _I, True), ("weekday_no", _I, True),
                ("month", _I, True))

HRV = _st(("subject_id", _L, False), ("day", _DT, False), ("rmssd", _D, True),
          ("sdnn", _D, True), ("ppi_mean_ms", _D, True), ("hr_from_ppi", _D, True),
          ("n_samples", _L, True))

FITNESS_TESTS = _st(("subject_id", _L, False), ("day", _DT, False), ("own_index", _D, True),
                    ("avg_hr", _D, True), ("fitness_class", _S, True), ("timezone_offset", _I, True),
                    ("birthday", _DT, True), ("sex", _S, True), ("height", _D, True),
                    ("weight", _D, True), ("max_hr", _I, True), ("resting_hr", _I, True),
                    ("aerobic_threshold", _I, True), ("anaerobic_threshold", _I, True),
                    ("vo2max", _D, True), ("training_background", _S, True),
                    ("weight_source", _S, True), ("sleep_goal", _L, True))

DAILY_JSON = _st(("subject_id", _L, False), ("day", _DT, False), ("json_data", _S, True))

RAW_DOCUMENTS = _st(("subject_id", _L, False), ("file_name", _S, False), ("category", _S, False),
                    ("day", _DT, True), ("json_data", _S, True))

IMPORT_LOG = _st(("subject_id", _L, False), ("file_name", _S, False), ("hash_md5", _S, False),
                 ("imported_at", _TS, True), ("category", _S, True))

QUARANTINE = _st(("subject_id", _L, False), ("file_name", _S, False), ("category", _S, True),
                 ("hash_md5", _S, False), ("parse_error", _S, False), ("imported_at", _TS, True))

IMPORT_RUNS = _st(("imported_at", _TS, True), ("seconds", _D, True), ("n_new", _L, True), ("n_changed", _L, True),
                  ("n_unchanged", _L, True), ("n_errors", _L, True))

IMPORT_ARCHIVES = _st(("imported_at", _TS, True), ("archive", _S, True), ("seconds", _D, True), ("new_files", _L, True),
                      ("changed_files", _L, True), ("unchanged_files", _L, True), ("errors", _L, True))

HR_SAMPLES = _st(("subject_id", _L, False), ("day", _DT, False), ("ts", _TS, True),
                 ("seconds_from_day_start", _I, True), ("hr", _I, False))

# tables that grow with the number of files/sessions: bucketed, partition-scoped merges
BUCKETED_TABLES = {"training", "raw_documents", "import_log"}
# columns that deal their rows into buckets: the merge key, but for sessions, which are given whole
BUCKET_BY = {"training": ("subject_id", "start_ts"), "raw_documents": ("subject_id", "file_name"),
             "import_log": ("subject_id", "file_name")}

# what tables and columns hold (written into the Parquet schema)
TABLE_COMMENTS = {
    "activity": "daily steps, calories and sleep", "training": "training sessions, one row per exercise",
    "heartrate": "daily heart-rate metrics", "hrv": "daily heart-rate variability from pulse intervals",
    "fitness_tests": "fitness tests, the best of a day", "orthostatic_tests": "orthostatic tests as JSON",
    "physical_info": "physical data as JSON", "products_devices": "devices as JSON",
    "raw_documents": "documents kept whole", "import_log": "files loaded, with their hash",
}
COLUMN_COMMENTS = {
    "subject_id": "person", "day": "calendar day (UTC)", "steps": "steps of the day", "calories": "energy in kcal",
    "sleep_hours": "hours asleep", "sleep_quality": "sleep quality as exported", "met_minutes": "metabolic equivalent minutes",
    "start_ts": "start of the session (UTC)", "ordinal": "place of the exercise in its session", "sport": "sport, e.g. RUNNING",
    "category": "category of the sport or file", "duration_min": "minutes", "distance_km": "kilometres",
    "hr_avg": "mean heart rate (bpm)", "hr_max": "highest heart rate (bpm)", "weekday": "Monday .. Sunday", "year": "year of the day",
    "resting_hr": "5th percentile of the day's heart rates (bpm)", "hr_mean": "mean heart rate of the day (bpm)",
    "weekday_no": "0 = Monday .. 6 = Sunday", "month": "1 .. 12", "rmssd": "root mean square of successive differences (ms)",
    "sdnn": "standard deviation of pulse intervals (ms)", "ppi_mean_ms": "mean pulse interval (ms)",
    "hr_from_ppi": "heart rate from the mean pulse interval (bpm)", "n_samples": "pulse intervals of the day",
    "own_index": "fitness index", "vo2max": "VO2max (ml/kg/min)", "json_data": "the document's JSON text",
    "file_name": "name of the export file", "hash_md5": "MD5 of the file's bytes", "imported_at": "time of the load",
}

# table name -> (schema, merge keys, watched columns or None = unconditional update)
TABLES = {
    "activity": (ACTIVITY, ["subject_id", "day"], ["steps", "calories", "sleep_hours"]),
    "training": (TRAINING, ["subject_id", "start_ts", "ordinal"], None),
    "heartrate": (HEARTRATE, ["subject_id", "day"], ["resting_hr"]),
    "hrv": (HRV, ["subject_id", "day"], ["rmssd"]),
    "fitness_tests": (FITNESS_TESTS, ["subject_id", "day"], None),
    "orthostatic_tests": (DAILY_JSON, ["subject_id", "day"], None),
    "physical_info": (DAILY_JSON, ["subject_id", "day"], None),
    "products_devices": (DAILY_JSON, ["subject_id", "day"], None),
    "raw_documents": (RAW_DOCUMENTS, ["subject_id", "file_name"], None),
    "import_log": (IMPORT_LOG, ["subject_id", "file_name"], None),
}
