"""Column-level functions (pure expressions, no actions)."""

from fleetlens.functions.casts import (clean_text, failure_flag, finite_or, is_finite, narrow_double,
                                       safe_cast, safe_date, safe_double, safe_int)
from fleetlens.functions.dates import (age_days, clamped_age_days, day_label, iso_day, partition_month,
                                       partition_year, utc_day)
from fleetlens.functions.risk import (bucket_order, capacity_tb, percent_1dp, risk_bucket, safe_ratio,
                                      sigmoid)

__all__ = [
    "clean_text", "failure_flag", "finite_or", "is_finite", "narrow_double", "safe_cast", "safe_date",
    "safe_double", "safe_int", "age_days", "clamped_age_days", "day_label", "iso_day", "partition_month",
    "partition_year", "utc_day", "bucket_order", "capacity_tb", "percent_1dp", "risk_bucket", "safe_ratio",
    "sigmoid",
]
