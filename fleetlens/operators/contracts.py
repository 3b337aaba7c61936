"""Data contracts as one-pass rule counts, key uniqueness and referential integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.functions.casts import clean_text
from fleetlens.schema import RISK_BUCKETS


def _rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row: total rows and, per rule, how many rows break it (one scan)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.coalesce(bad, F.lit(True))).alias(name) for name, bad in rules.items()])


def validate_features(df: DataFrame, vector: str = "features") -> DataFrame:
    """Scoring input rows: drive id text present, day a date, a feature map present."""
    return _rule_counts(df, {
        "bad_drive_id": clean_text(F.col("drive_id").cast("string")).isNull(),
        "bad_day": F.col("day").cast("date").isNull(),
        "bad_features": F.col(vector).isNull(),
    })


def validate_predictions(df: DataFrame, reasons: str | None = "top_reasons") -> DataFrame:
    """Score output: 0 <= score <= 1, bucket in enum, reason direction UP/DOWN, version and time present."""
    s = F.col("risk_score")
    rules = {
        "bad_score": s.isNull() | F.isnan(s) | (s < 0) | (s > 1),
        "bad_bucket": ~F.col("risk_bucket").isin(*RISK_BUCKETS),
        "bad_version": clean_text("model_version").isNull(),
        "bad_scored_at": F.col("scored_at").isNull(),
    }
    if reasons and reasons in df.columns:
        rules["bad_direction"] = ~F.forall(F.coalesce(F.col(reasons), F.array()),
                                           lambda r: r["direction"].isin("UP", "DOWN"))
    return _rule_counts(df, rules)


def validate_drives(df: DataFrame) -> DataFrame:
    """Drive rows: id and model present, capacity an integer >= 0 when given."""
    cap = F.col("capacity_bytes")
    return _rule_counts(df, {
        "bad_drive_id": clean_text("drive_id").isNull(),
        "bad_model": clean_text("model").isNull(),
        "bad_capacity": cap.isNotNull() & ((cap < 0) | (cap.cast("double") != F.floor(cap.cast("double")))),
    })


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count (partial aggregation before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphan_rows(child: DataFrame, parent: DataFrame, key: str = "drive_id") -> DataFrame:
    """Child rows whose key has no parent row."""
    return child.join(parent.select(key), key, "left_anti")


def cascade_delete(child: DataFrame, deleted_ids: DataFrame, key: str = "drive_id") -> DataFrame:
    """Child rows that survive deleting ``deleted_ids`` from the parent."""
    return child.join(deleted_ids.select(key), key, "left_anti")


def null_parent_on_delete(child: DataFrame, deleted_ids: DataFrame, key: str = "drive_id") -> DataFrame:
    """Audit rows keep existing but lose the reference to a deleted drive (SET NULL)."""
    d = deleted_ids.select(F.col(key).alias("_del")).distinct()
    j = child.join(d, F.col(key) == F.col("_del"), "left")
    return j.withColumn(key, F.when(F.col("_del").isNull(), F.col(key))).drop("_del")
