"""Feature vectors: stored rows, map encode/decode, projection, fallback, schema checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.functions.casts import finite_or
from fleetlens.schema import FEATURE_MAP_TYPE, VECTOR_FALLBACK_KEYS, model_feature_names


def to_vector(df: DataFrame, names: list[str], nonfinite: str = "null") -> Column:
    """Feature columns -> map<string,double>; non-finite -> null (before encode) or 0."""
    kv = []
    for n in names:
        c = F.col(n).cast("double")
        kv += [F.lit(n), finite_or(c, None) if nonfinite == "null" else finite_or(c, 0.0)]
    return F.create_map(*kv)


def vector_json(vector: Column) -> Column:
    """Encode a feature map as JSON text (clean non-finite values first)."""
    return F.to_json(vector)


def vector_from_json(text: Column) -> Column:
    return F.from_json(text, FEATURE_MAP_TYPE)


def explode_vector(df: DataFrame, key: list[str], vector: str = "features") -> DataFrame:
    """Long form (key..., name, value) of a map column."""
    return df.select(*key, F.explode(vector).alias("name", "value"))


def features_daily_row(features: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Stored feature row with the application's legacy columns plus the JSON vector.

    The legacy names are kept as the reference stores them (a 'slope' column
    holds the 7-row delta, a 'max' column holds the 30-row mean, the missing
    flag means a 30-row mean of exactly 0); the label is always false here.
    """
    names = names or model_feature_names()
    return features.select(
        "drive_id", "day",
        F.lit(False).alias("label_fail_within_14d"),
        F.col("age_days").cast("int").alias("age_days"),
        F.col("smart_5_raw_mean_7d").alias("smart5_mean_7d"),
        F.col("smart_5_raw_delta_vs_7d").alias("smart5_slope_14d"),
        F.col("smart_197_raw_mean_30d").alias("smart197_max_30d"),
        F.col("smart_197_raw_mean_7d").alias("smart197_mean_7d"),
        F.col("smart_198_raw_delta_vs_7d").alias("smart198_delta_7d"),
        F.col("smart_199_raw_std_30d").alias("smart199_volatility_30d"),
        F.col("temperature_mean_7d").alias("temperature_mean_7d"),
        F.lit(None).cast("double").alias("read_latency_mean_7d"),
        F.lit(None).cast("double").alias("write_latency_mean_7d"),
        (F.col("smart_197_raw_mean_30d") == 0).alias("missing_smart_197_30d"),
        vector_json(to_vector(features, names, "null")).alias("feature_vector"),
    )


LEGACY_COLUMN = {"age_days": "age_days", "smart_5_raw_mean_7d": "smart5_mean_7d",
                 "smart_197_raw_mean_7d": "smart197_mean_7d"}


def vector_fallback(rows: DataFrame, names: list[str] | None = None, vector_col: str = "feature_vector",
                    key: list[str] = ("drive_id", "day")) -> DataFrame:
    """Stored row -> model features: finite values from the vector, else 0; for the three
    legacy keys an *absent* key (not a null value) falls back to the legacy column."""
    names = names or model_feature_names()
    m = vector_from_json(F.col(vector_col)) if dict(rows.dtypes)[vector_col] == "string" else F.col(vector_col)
    with_map = rows.withColumn("_vec", m)
    cols = []
    for n in names:
        v = finite_or(F.try_element_at(F.col("_vec"), F.lit(n)), 0.0)
        if n in VECTOR_FALLBACK_KEYS:
            legacy = F.col(LEGACY_COLUMN[n]).cast("double")
            absent = ~F.coalesce(F.map_contains_key(F.col("_vec"), F.lit(n)), F.lit(False))
            v = F.when(absent & legacy.isNotNull(), legacy).otherwise(v)
        cols.append(v.alias(n))
    return with_map.select(*key, *cols)


def normalize_features(df: DataFrame, names: list[str], key: list[str] = ("drive_id", "day")) -> DataFrame:
    """Project to exactly the model's features: absent -> null, extra dropped, non-finite -> null."""
    have = set(df.columns)
    return df.select(*key, *[(finite_or(F.col(n).cast("double"), None) if n in have
                              else F.lit(None).cast("double")).alias(n) for n in names])


def normalize_vector(vector: Column, names: list[str]) -> Column:
    """Map version of ``normalize_features``."""
    kv = []
    for n in names:
        kv += [F.lit(n), finite_or(F.try_element_at(vector, F.lit(n)), None)]
    return F.create_map(*kv)


def _py_list(arr: Column) -> Column:
    return F.when(F.size(arr) == 0, F.lit("none")).otherwise(
        F.concat(F.lit("['"), F.array_join(arr, "', '"), F.lit("']")))


def schema_mismatch(df: DataFrame, expected: list[str], vector: str = "features",
                    key: list[str] = ("drive_id", "day")) -> DataFrame:
    """Per row: missing and unexpected feature names (sorted) and the rejection message; only rows that differ."""
    exp = F.array(*[F.lit(n) for n in expected])
    keys = F.map_keys(F.col(vector))
    missing = F.array_sort(F.array_except(exp, keys))
    extra = F.array_sort(F.array_except(keys, exp))
    out = df.select(*key, missing.alias("missing"), extra.alias("unexpected"))
    out = out.where((F.size("missing") > 0) | (F.size("unexpected") > 0))
    return out.select(*key, "missing", "unexpected", F.concat(
        F.lit("Feature schema mismatch. Missing keys: "), _py_list(F.col("missing")),
        F.lit(". Unexpected keys: "), _py_list(F.col("unexpected")), F.lit(".")).alias("message"))


def columns_mismatch(columns: list[str], expected: list[str]) -> tuple[list[str], list[str]]:
    """Driver-side check for a wide frame: (missing, unexpected), both sorted."""
    return sorted(set(expected) - set(columns)), sorted(set(columns) - set(expected))
