"""Column lists, canonical schema and table contracts."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Must equal the reference for identical results.
# Canonical warehouse columns with their type and the header aliases accepted
# for each, in priority order (first alias present wins, case-insensitive).
CANONICAL_COLUMNS: list[tuple[str, str, list[str]]] = [
    ("date", "date", ["date", "day"]),
    ("serial_number", "string", ["serial_number", "serial"]),
    ("model", "string", ["model", "model_name"]),
    ("failure", "int", ["failure", "is_failed_today"]),
    ("capacity_bytes", "bigint", ["capacity_bytes"]),
    ("smart_5_raw", "double", ["smart_5_raw", "smart_5"]),
    ("smart_187_raw", "double", ["smart_187_raw", "smart_187"]),
    ("smart_188_raw", "double", ["smart_188_raw", "smart_188"]),
    ("smart_197_raw", "double", ["smart_197_raw", "smart_197"]),
    ("smart_198_raw", "double", ["smart_198_raw", "smart_198"]),
    ("smart_199_raw", "double", ["smart_199_raw", "smart_199"]),
    ("smart_241_raw", "double", ["smart_241_raw", "smart_241"]),
    ("smart_242_raw", "double", ["smart_242_raw", "smart_242"]),
    ("temperature", "double", ["temperature", "temperature_raw", "smart_194_raw", "smart_194"]),
]

# The nine telemetry metrics that get rolling statistics.
METRICS: list[str] = [
    "smart_5_raw", "smart_187_raw", "smart_188_raw", "smart_197_raw", "smart_198_raw",
    "smart_199_raw", "smart_241_raw", "smart_242_raw", "temperature",
]

# Per-metric statistics, in the order the offline table lays them out (stat-major).
STATS: list[str] = ["mean_7d", "mean_30d", "std_30d", "delta_vs_7d", "is_increasing"]

# Columns never used as model inputs.
IGNORED_COLUMNS: set[str] = {"as_of_date", "serial_number", "model", "label_30d", "year", "month"}

# Online telemetry has no columns for these two metrics; they are always null there.
ONLINE_MISSING_METRICS: set[str] = {"smart_241_raw", "smart_242_raw"}

# Legacy columns a stored feature row falls back to when its vector lacks the key.
VECTOR_FALLBACK_KEYS: list[str] = ["age_days", "smart_5_raw_mean_7d", "smart_197_raw_mean_7d"]

# Risk thresholds: score >= 0.75 HIGH, >= 0.4 MED, else LOW.
HIGH_THRESHOLD = 0.75
MED_THRESHOLD = 0.4
RISK_BUCKETS = ["LOW", "MED", "HIGH"]

# Rank fallback score ranges per bucket: (max, min), linear inside the bucket.
FALLBACK_SCORE_RANGES = {"HIGH": (0.95, 0.75), "MED": (0.74, 0.40), "LOW": (0.39, 0.02)}
FALLBACK_HIGH_SHARE = 0.05
FALLBACK_MED_SHARE = 0.15
FALLBACK_HIGH_MIN_N = 20
FALLBACK_MED_MIN_N = 10

AUDIT_ACTIONS = ["FEATURE_RUN", "SCORE_RUN", "INGESTION"]
TOP_REASONS = 5
MAX_PAGE_SIZE = 200
# ---------------------------------------------------------------------------


def metric_feature_names(metrics: list[str] = METRICS, order: str = "stat") -> list[str]:
    """Feature names for the metric statistics; ``stat``-major (offline) or ``metric``-major (online)."""
    if order == "stat":
        return [f"{m}_{s}" for s in STATS for m in metrics]
    return [f"{m}_{s}" for m in metrics for s in STATS]


def model_feature_names(metrics: list[str] = METRICS) -> list[str]:
    """The 47 model inputs in the online (metric-major) order."""
    return ["capacity_bytes", "age_days"] + metric_feature_names(metrics, order="metric")


SPARK_TYPES = {
    "date": T.DateType(), "string": T.StringType(), "int": T.IntegerType(),
    "bigint": T.LongType(), "double": T.DoubleType(),
}

#: The warehouse columns, as every scan reads them.
WAREHOUSE_SCHEMA = T.StructType([T.StructField(name, SPARK_TYPES[kind]) for name, kind, _ in CANONICAL_COLUMNS])

REASON_STRUCT = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("contribution", T.DoubleType()),
    T.StructField("direction", T.StringType()),
])
FEATURE_MAP_TYPE = T.MapType(T.StringType(), T.DoubleType(), valueContainsNull=True)

PREDICTIONS_KEY = ["drive_id", "day", "model_version"]
TELEMETRY_KEY = ["drive_id", "day"]
FEATURES_KEY = ["drive_id", "day"]
