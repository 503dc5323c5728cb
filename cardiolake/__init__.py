"""cardiolake: wearable health time series as Spark plans.

Daily heart-rate / HRV / activity / training tables keyed by
``(subject_id, day)``, built from nested JSON exports and analysed with
DataFrame operators that Catalyst can optimise and distribute.

The most used entry points are re-exported here; everything else lives in
``functions``, ``sources``, ``operators``, ``plans`` and ``streaming``.
"""

__version__ = "0.1.0"

from cardiolake.operators.aggregate import (  # noqa: E402,F401
    box_stats, describe, histogram, kpis, monthly_activity, monthly_mean_sem, quality_report,
    season_contrast_of_days, season_contrast_of_monthly_means, trainings_per_year, yearly_stats,
)
from cardiolake.operators.calendar import coverage, grid_pivot, missing_days, resample  # noqa: E402,F401
from cardiolake.operators.daily import daily_hr, daily_hrv, daily_hrv_new_days  # noqa: E402,F401
from cardiolake.operators.stats import correlation_report, pearson, spearman, with_p_values  # noqa: E402,F401
from cardiolake.operators.topk import top_k, top_k_plus_rest  # noqa: E402,F401
from cardiolake.operators.upsert import TableStore, merge_plan  # noqa: E402,F401
from cardiolake.operators.windows import lead_one, rolling_mean, rolling_quantile  # noqa: E402,F401
from cardiolake.plans.ingest import Ingest  # noqa: E402,F401
from cardiolake.sources.archive import archive_source, folder_source  # noqa: E402,F401
