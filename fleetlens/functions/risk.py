"""Risk score helpers: sigmoid, bucket thresholds, percent formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fleetlens.schema import HIGH_THRESHOLD, MED_THRESHOLD


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(z) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_col(z)))


def risk_bucket(score) -> Column:
    """score >= 0.75 HIGH, >= 0.4 MED, else LOW."""
    s = _col(score)
    return (F.when(s >= F.lit(HIGH_THRESHOLD), "HIGH")
            .when(s >= F.lit(MED_THRESHOLD), "MED")
            .otherwise("LOW"))


def bucket_order(bucket) -> Column:
    """LOW < MED < HIGH as 0/1/2."""
    b = _col(bucket)
    return F.when(b == "LOW", 0).when(b == "MED", 1).when(b == "HIGH", 2)


def safe_ratio(num, den) -> Column:
    """num / den with a zero (or null) denominator giving 0."""
    d = _col(den).cast("double")
    return F.when(d.isNull() | (d == 0), F.lit(0.0)).otherwise(_col(num).cast("double") / d)


def percent_1dp(ratio) -> Column:
    """Ratio -> percent rounded to one digit (dashboard rate and score formats)."""
    return F.round(_col(ratio) * 100.0, 1)


def capacity_tb(bytes_col) -> Column:
    """Bytes -> TB (decimal, 1e12), null -> 0."""
    return F.coalesce(_col(bytes_col), F.lit(0)).cast("double") / F.lit(1e12)
