"""Registered queries: one per operator of the inventory.

Each entry is ``(spark, sf_dir) -> DataFrame`` over the driver tables shaped by
the adapters, calling the library operator and aliasing the result so its
columns match the DuckDB oracle (``fleetlens.plans.oracle``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, FloatType

from fleetlens.operators import features as FE
from fleetlens.operators import windows as W
from fleetlens.plans import adapters as AD
from fleetlens.schema import METRICS

Query = Callable[[SparkSession, str], DataFrame]


def rounded(x: str, digits: int = 6) -> str:
    """``round(x, digits)`` of a double as SQL text, the same double without decimals in most rows.

    Spark rounds by way of a BigDecimal, which for a wide table takes longer than all else.
    A double under four million that is not within a hundredth of a unit of a tie has one
    candidate, and an integer over a power of ten is its nearest double; others are left to ``round``.
    """
    unit = f"1e{digits}"
    return (f"CASE WHEN abs({x}) < 4e{12 - digits} AND abs(abs({x} * {unit} - rint({x} * {unit})) - 0.5D) > 0.01D "
            f"THEN rint({x} * {unit}) / {unit} + 0.0D ELSE round({x}, {digits}) END")


def round6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column to ``digits`` (comparison rule shared with the oracle)."""
    return df.selectExpr(*[
        f"{rounded(f'`{f.name}`', digits)} AS `{f.name}`" if isinstance(f.dataType, DoubleType)
        else f"round(`{f.name}`, {digits}) AS `{f.name}`" if isinstance(f.dataType, FloatType)
        else f"`{f.name}`" for f in df.schema.fields])


def q_build_features(spark, d):
    return round6(FE.build_features(AD.telemetry_ship(spark, d), METRICS, horizon_days=30,
                                    source=AD.source_rows(AD.telemetry_ship, spark, d)))


def q_build_features_events(spark, d):
    return round6(FE.build_features(AD.telemetry_events(spark, d), METRICS, horizon_days=7,
                                    source=AD.source_rows(AD.telemetry_events, spark, d)))


def _stat_query(adapter, stat):
    def run(spark, d):
        # the feature table's plan without the columns that are not asked for, its treatment of hot drives included
        features = FE.build_features(adapter(spark, d), METRICS, source=AD.source_rows(adapter, spark, d))
        return round6(features.select("serial_number", "as_of_date", *[f"{m}_{stat}" for m in METRICS]))
    return run


def q_first_seen(spark, d):
    return W.with_first_days(AD.telemetry_ship(spark, d)).select("serial_number", "as_of_date", "first_seen")


def q_first_failure(spark, d):
    return W.with_first_days(AD.telemetry_ship(spark, d)).select("serial_number", "as_of_date", "first_failure")


def q_label_horizon(spark, d):
    return W.with_first_days(AD.telemetry_events(spark, d)).select(
        "serial_number", "as_of_date", W.label_within(F.col("as_of_date"), F.col("first_failure"), 7).alias("label_30d"))


def q_age_days(spark, d):
    from fleetlens.functions.dates import age_days
    return W.with_first_days(AD.telemetry_ship(spark, d)).select(
        "serial_number", "as_of_date", age_days(F.col("first_seen"), "as_of_date").alias("age_days"))


def queries() -> dict[str, Query]:
    from fleetlens.plans import catalog_more
    q: dict[str, Query] = {
        "build_features": q_build_features,
        "build_features_events": q_build_features_events,
        "rolling_mean_7": _stat_query(AD.telemetry_ship, "mean_7d"),
        "rolling_mean_30": _stat_query(AD.telemetry_ship, "mean_30d"),
        "rolling_std_30": _stat_query(AD.telemetry_ship, "std_30d"),
        "delta_vs_7": _stat_query(AD.telemetry_ship, "delta_vs_7d"),
        "is_increasing": _stat_query(AD.telemetry_events, "is_increasing"),
        "first_seen": q_first_seen,
        "first_failure": q_first_failure,
        "label_horizon": q_label_horizon,
        "age_days": q_age_days,
    }
    q.update(catalog_more.queries())
    return q
