"""DataFrame operators. Each takes DataFrames and settings and returns a DataFrame."""

from .anomaly import category_stats, detect_anomalies, with_anomaly_flags, with_z_score
from .cleanse import cleanse_bank, cleanse_gl, cleanse_sales, per_reference, roll_up, tidy_sales
from .quality import (
    QualityError,
    assert_no_nulls,
    date_range_check,
    duplicate_report,
    duplicate_summary,
    enforce,
    full_check,
    full_report,
    null_report,
    numeric_profile,
    quality_gate,
    quality_scorecard,
    value_range_check,
)
from .reconcile import (
    join_gl,
    join_ledgers,
    status_counts,
    three_way_reconciliation,
    with_lags,
    with_status,
    with_variances,
)
from .summary import monthly_summary
from .versions import latest_version, number_versions

__all__ = [
    "QualityError", "assert_no_nulls", "category_stats", "cleanse_bank", "cleanse_gl", "cleanse_sales",
    "date_range_check", "detect_anomalies", "duplicate_report", "duplicate_summary", "enforce", "full_check",
    "full_report", "join_gl", "join_ledgers", "latest_version", "monthly_summary", "null_report", "number_versions",
    "numeric_profile", "per_reference", "quality_gate", "quality_scorecard", "roll_up", "status_counts",
    "three_way_reconciliation", "tidy_sales", "value_range_check", "with_anomaly_flags", "with_lags",
    "with_status", "with_variances", "with_z_score",
]
