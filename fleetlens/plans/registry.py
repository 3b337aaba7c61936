"""Audit log rows and the model registry."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlens.schema import AUDIT_ACTIONS

MISSING_MANIFEST = "manifest_missing"

REGISTRY_SCHEMA = ("model_version string, artifact_uri string, metrics string, feature_schema string, "
                   "trained_data_window string, train_date timestamp, horizon_days int, status string")


def audit_from_counts(counts: DataFrame, action: str, payload: dict[str, Column],
                      drive_id: str | None = None) -> DataFrame:
    """One audit row whose JSON payload is built from aggregate columns of ``counts``.

    ``counts`` is an aggregate (one row), so the payload numbers come from the
    same plan that produced the data: no second scan.
    """
    if action not in AUDIT_ACTIONS:
        raise ValueError(f"unknown audit action {action}")
    return counts.select(
        F.expr("uuid()").alias("id"), F.lit(drive_id).cast("string").alias("drive_id"),
        F.lit(action).alias("action"),
        F.to_json(F.struct(*[v.alias(k) for k, v in payload.items()])).alias("payload"),
        F.current_timestamp().alias("created_at"))


def registry_row(spark: SparkSession, version: str, artifact_uri: str, metrics: dict, features: list[str],
                 window: dict, horizon_days: int, status: str = "complete",
                 train_date: dt.datetime | None = None) -> DataFrame:
    # the window says which data the model saw: its days, and the hash of the manifest they came from
    window = {"manifest_hash": MISSING_MANIFEST} | window
    schema = {"ordered_features": [{"name": n, "dtype": "float"} for n in features],
              "label_column": "label_30d", "horizon_days": horizon_days}
    td = train_date or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return spark.createDataFrame(
        [(version, artifact_uri, json.dumps(metrics, default=float), json.dumps(schema), json.dumps(window, default=str),
          td, horizon_days, status)], REGISTRY_SCHEMA)


def active_model(registry: DataFrame, version: str | None = None) -> DataFrame:
    """The requested version (must be complete) or else the newest complete one by train date.

    Returns one row; raises if nothing qualifies (a lookup by contract).
    """
    if version and version != "latest":
        r = registry.where(F.col("model_version") == version)
        rows = r.select("status").limit(2).collect()
        if not rows:
            raise FileNotFoundError(f"the registry has no model {version}")
        if rows[0]["status"] != "complete":
            raise FileNotFoundError(f"Model version {version} is incomplete")
        return r.limit(1)
    c = registry.where(F.col("status") == "complete").orderBy(F.col("train_date").desc(),
                                                              F.col("model_version").desc()).limit(1)
    if c.isEmpty():
        raise FileNotFoundError("No complete model in the registry; train a model first")
    return c


def model_info(row) -> dict:
    """What a caller may ask of a model: version, type, horizon, ordered features, metrics, lineage."""
    window = json.loads(row["trained_data_window"] or "{}")
    return {"model_version": row["model_version"], "model_type": "logistic_regression", "horizon_days": row["horizon_days"],
            "features": [f["name"] for f in json.loads(row["feature_schema"] or "{}").get("ordered_features", [])],
            "metrics": json.loads(row["metrics"] or "{}"), "manifest_hash": window.get("manifest_hash", MISSING_MANIFEST)}


def model_card(row) -> str:
    """Human-readable card text from one registry row."""
    m = json.loads(row["metrics"] or "{}")
    w = json.loads(row["trained_data_window"] or "{}")

    def f(x):
        return f"{float(x):.4f}" if isinstance(x, (int, float)) else "n/a"

    lines = [f"Model version: {row['model_version']}",
             f"Task: failure within {row['horizon_days']} days, logistic regression",
             f"Fitted on days {w.get('train_start')} .. {w.get('train_end')}, tested on {w.get('test_start')} .. {w.get('test_end')}",
             "Test results:"]
    lines += [f"  {name} = {f(m.get(name))}" for name in ("pr_auc", "recall_at_top_1pct", "recall_at_top_5pct", "brier_score")]
    return "\n".join(lines) + "\n"
