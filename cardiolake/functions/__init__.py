"""Column -> Column scalar functions (all JVM-side, codegen friendly)."""

from cardiolake.functions.convert import (  # noqa: F401
    falsy_fallback, null_or_default, round_to, safe_double, safe_int, safe_long, safe_string,
    ms_to_minutes, m_to_km, minutes_to_hours, ppi_to_bpm,
)
from cardiolake.functions.dates import (  # noqa: F401
    add_seconds, date_parts, date_range_predicate, lookback_window, month_start_key,
    utc_timestamp, week_end_sunday, weekday_name, weekday_no,
)
from cardiolake.functions.durations import iso_duration_minutes, iso_duration_minutes_strict  # noqa: F401
from cardiolake.functions.labels import (  # noqa: F401
    effect_label, file_category, label_at, sleep_band, title_case,
)
