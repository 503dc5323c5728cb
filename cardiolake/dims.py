"""Small, fixed lookup tables and their DataFrame forms.

The lists below are FIXED VALUES that must equal the source export's
vocabulary for the results to be right. They are tiny (< 50 rows) and of
fixed size, so joining them with ``F.broadcast`` is always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES: numeric sport id of the file export -> sport name
# (the export lists id 36 twice with the same value; kept once)
SPORT_IDS = [
    ("1", "RUNNING"), ("27", "TRAIL_RUNNING"),
    ("2", "CYCLING"), ("3", "MOUNTAIN_BIKING"), ("38", "INDOOR_CYCLING"), ("113", "E_BIKE"),
    ("4", "HIKING"), ("5", "HIKING"), ("17", "WALKING"), ("94", "WALKING"),
    ("6", "DOWNHILL_SKIING"), ("7", "CROSS_COUNTRY_SKIING"), ("8", "INDOOR_ROWING"), ("58", "BOOTCAMP"),
    ("11", "SWIMMING"), ("23", "SWIMMING"), ("83", "OPEN_WATER_SWIMMING"), ("103", "SWIMMING"),
    ("105", "OPEN_WATER_SWIMMING"),
    ("15", "FITNESS_TRAINING"), ("117", "INDOOR_ROWING"), ("24", "CROSS_COUNTRY_SKIING"),
    ("16", "OUTDOOR_OTHER"), ("111", "MOBILITY_DYNAMIC"), ("126", "CORE"), ("127", "MOBILITY_STATIC"),
    ("18", "INDOOR_CYCLING"), ("51", "UNIHOCKEY"), ("55", "VOLLEYBALL"), ("177", "E_BIKE"),
    ("36", "RUNNING"), ("61", "AEROBIC"), ("92", "TRAIL_RUNNING"),
]

# FIXED VALUES: sport name (file export) -> category
SPORT_CATEGORY = [
    ("OUTDOOR_OTHER", "OUTDOOR"), ("CYCLING", "OUTDOOR"), ("MOUNTAIN_BIKING", "OUTDOOR"),
    ("E_BIKE", "OUTDOOR"), ("HIKING", "OUTDOOR"), ("WALKING", "OUTDOOR"),
    ("CROSS_COUNTRY_SKIING", "OUTDOOR"), ("DOWNHILL_SKIING", "OUTDOOR"),
    ("OPEN_WATER_SWIMMING", "OUTDOOR"), ("VOLLEYBALL", "OUTDOOR"),
    ("SWIMMING", "INDOOR"), ("INDOOR_CYCLING", "INDOOR"), ("INDOOR_ROWING", "INDOOR"),
    ("STRENGTH_TRAINING", "INDOOR"), ("FITNESS_TRAINING", "INDOOR"), ("CORE", "INDOOR"),
    ("MOBILITY_DYNAMIC", "INDOOR"), ("MOBILITY_STATIC", "INDOOR"), ("YOGA", "INDOOR"),
    ("PILATES", "INDOOR"), ("AEROBIC", "INDOOR"), ("BOOTCAMP", "INDOOR"), ("UNIHOCKEY", "INDOOR"),
]

# FIXED VALUES: sport string of the web API -> normalised sport
API_SPORT = [
    ("RUNNING", "RUNNING"), ("TRAIL_RUNNING", "RUNNING"), ("TREADMILL_RUNNING", "RUNNING"),
    ("CYCLING", "CYCLING"), ("INDOOR_CYCLING", "CYCLING"), ("SPINNING", "CYCLING"),
    ("SWIMMING", "SWIMMING"), ("WALKING", "WALKING"), ("HIKING", "HIKING"),
    ("STRENGTH_TRAINING", "STRENGTH"), ("FUNCTIONAL_TRAINING", "STRENGTH"),
    ("FLOOR_GYMNASTICS", "STRENGTH"), ("CORE", "STRENGTH"),
    ("YOGA", "YOGA"), ("PILATES", "PILATES"), ("MOBILITY_DYNAMIC", "MOBILITY_DYNAMIC"),
    ("MOBILITY_STATIC", "MOBILITY_STATIC"), ("STRETCHING", "MOBILITY_STATIC"),
    ("FITNESS_CLASS", "FITNESS"), ("AEROBICS", "FITNESS"), ("STEP_AEROBICS", "FITNESS"),
    ("GROUP_EXERCISE", "FITNESS"), ("CROSS_TRAINING", "FITNESS"), ("ELLIPTICAL_TRAINING", "FITNESS"),
    ("SKI_CLASSIC", "SKI"), ("SKI_FREESTYLE", "SKI"), ("CROSS_COUNTRY_SKIING", "SKI"),
    ("DOWNHILL_SKIING", "SKI"), ("SNOWBOARDING", "SKI"),
    ("ROWING", "ROWING"), ("TRIATHLON", "TRIATHLON"), ("BOXING", "BOXING"), ("CLIMBING", "CLIMBING"),
    ("DANCING", "DANCING"), ("GOLF", "GOLF"), ("TENNIS", "TENNIS"), ("BADMINTON", "BADMINTON"),
    ("FOOTBALL", "SOCCER"), ("BASKETBALL", "BASKETBALL"), ("VOLLEYBALL", "VOLLEYBALL"),
    ("ICE_SKATING", "ICE_SKATING"), ("PADDLING", "PADDLING"), ("MARTIAL_ARTS", "MARTIAL_ARTS"),
    ("OTHER", "OTHER"),
]

# FIXED VALUES: raw sport string of the web API -> category (default OUTDOOR)
API_CATEGORY = [
    ("RUNNING", "OUTDOOR"), ("CYCLING", "OUTDOOR"), ("SWIMMING", "OUTDOOR"), ("HIKING", "OUTDOOR"),
    ("WALKING", "OUTDOOR"), ("TRAIL_RUNNING", "TRAIL"), ("TREADMILL_RUNNING", "TREADMILL"),
    ("INDOOR_CYCLING", "INDOOR"), ("SPINNING", "INDOOR"), ("STRENGTH_TRAINING", "INDOOR"),
    ("FUNCTIONAL_TRAINING", "INDOOR"), ("FLOOR_GYMNASTICS", "INDOOR"), ("YOGA", "INDOOR"),
    ("PILATES", "INDOOR"), ("FITNESS_CLASS", "INDOOR"), ("AEROBICS", "INDOOR"),
    ("STEP_AEROBICS", "INDOOR"), ("GROUP_EXERCISE", "INDOOR"), ("CROSS_TRAINING", "INDOOR"),
    ("ELLIPTICAL_TRAINING", "INDOOR"), ("CORE", "INDOOR"), ("MOBILITY_DYNAMIC", "INDOOR"),
    ("MOBILITY_STATIC", "INDOOR"), ("STRETCHING", "INDOOR"),
]

# FIXED VALUES: file-name rules, first match on the lower-cased name wins
FILE_CATEGORY_RULES = [
    (("activity-", "activity_"), "activity"),
    (("training-session", "training-", "training_"), "training"),
    (("247ohr-", "247ohr_"), "heartrate"),
    (("ppi-", "ppi_"), "hrv"),
    (("fitness-test-results",), "fitness_test"),
    (("orthostatic-test-result",), "orthostatic_test"),
    (("physical-test-rr", "physical-info"), "physical_info"),
    (("products-devices",), "products_devices"),
    (("generic-exercise", "generic-period"), "generic_exercise"),
    (("planned-exercise", "planned-route"), "planned_exercise"),
    (("programs", "program-"), "programs"),
    (("season",), "season"),
    (("jump-test",), "jump_test"),
    (("account",), "account"),
    (("sleep_", "sleep-"), "sleep"),
    (("nightly_recovery", "nightly-recovery"), "nightly_recovery"),
    (("favourite",), "favourite"),
    (("calendar",), "calendar"),
    (("sport",), "sport"),
]
OTHER_CATEGORY = "sonstige"

# FIXED VALUES: training-name markers for treadmill sessions
TREADMILL_MARKERS = ("laufband", "laufb.", "treadmill")

# FIXED VALUES: sports relabelled to RUNNING when pace (min/km) is below the limit
PACE_RELABEL_SPORTS = ("HIKING", "WALKING")
PACE_LIMIT_MIN_PER_KM = 10.0

# FIXED VALUES: display labels
WEEKDAY_SHORT = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
WEEKDAY_DE = ["Mo", "Di", "Mi", "Do", "Fr", "Sa", "So"]
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
# ---------------------------------------------------------------------------


def pairs_df(spark: SparkSession, pairs, key: str, value: str) -> DataFrame:
    return spark.createDataFrame(list(pairs), f"{key} string, {value} string")


def sport_id_dim(spark: SparkSession) -> DataFrame:
    return pairs_df(spark, SPORT_IDS, "sport_id", "sport_name")


def sport_category_dim(spark: SparkSession) -> DataFrame:
    return pairs_df(spark, SPORT_CATEGORY, "sport", "dim_category")


def map_expr(pairs, col, default=None):
    """Fixed mapping as a literal map lookup (one lookup per row, JVM-side).

    A literal map is folded to a constant, so the key expression is
    evaluated once, unlike a CASE chain that Catalyst may expand per branch.
    """
    c = F.col(col) if isinstance(col, str) else col
    m = F.create_map(*[F.lit(x) for kv in pairs for x in kv])
    e = F.try_element_at(m, c)
    return e if default is None else F.coalesce(e, F.lit(default))


def values_sql(pairs, key: str, value: str, alias: str = "t") -> str:
    """The same fixed mapping as an SQL ``VALUES`` relation (used by oracles)."""
    rows = ", ".join(f"('{k}', '{v}')" for k, v in pairs)
    return f"(VALUES {rows}) AS {alias}({key}, {value})"
