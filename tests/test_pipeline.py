"""End-to-end: ZIP archives -> warehouse -> features -> model -> registry (C6-C8), and feature discovery."""

import tempfile

from pyspark.sql import functions as F

from fleetlens.operators import model as MO
from fleetlens.plans import adapters as AD
from fleetlens.plans import jobs as JB
from fleetlens.plans import registry as RG
from fleetlens.sources import zipcsv as ZC


def test_numeric_features(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 3, 4)], "capacity_bytes bigint, f double, model string, year int, label_30d int")
    assert MO.numeric_features(df) == ["capacity_bytes", "f"]


def test_run_pipeline(spark, smoke_dir):
    tel = AD.telemetry_ship(spark, smoke_dir)
    text = tel.select(F.col("as_of_date").cast("string").alias("date"), "serial_number", "model",
                      F.col("failure").cast("string").alias("failure"),
                      F.col("smart_5_raw").cast("string").alias("smart_5"),
                      F.col("temperature").cast("string").alias("temperature_raw"))
    src = tempfile.mkdtemp(prefix="fl-pipe-zip-")
    ZC.write_zip_csv(text.repartition(3), src).collect()
    root = tempfile.mkdtemp(prefix="fl-pipe-")
    out = JB.run_pipeline(spark, src, kind="zip", horizon_days=30, test_months=9, root=root + "/run")
    assert out["warehouse_rows"] == tel.count()
    reg = spark.read.parquet(out["registry"])
    row = RG.active_model(reg).first()
    assert row["status"] == "complete" and row["horizon_days"] == 30
    model = JB.load_model(spark, out["model"])
    assert len(model.features) == 47 and all(abs(w) < 1e6 for w in model.weights.values())
    assert 0.0 <= out["metrics"]["pr_auc"] <= 1.0 and out["metrics"]["test_rows"] > 0
    card = RG.model_card(row)
    assert "pr_auc" in card and "failure within" in card


def test_scoring_run_persisted(spark, smoke_dir, tmp_path):
    from fleetlens.schema import model_feature_names
    tel = AD.telemetry_events(spark, smoke_dir)
    app = AD.telemetry_daily(tel)
    run = JB.run_scoring(app, AD.drives(tel), None, MO.fixed_model(model_feature_names()), mode="compat")
    assert run.status == "completed"
    out = JB.persist_scoring_run(run, str(tmp_path / "pred"), str(tmp_path / "feat"), str(tmp_path / "audit"))
    assert out["partitions_rewritten"] == 1
    preds = spark.read.parquet(str(tmp_path / "pred"))
    assert preds.count() == run.predictions.count() > 0
    assert spark.read.parquet(str(tmp_path / "audit")).first()["action"] == "SCORE_RUN"
    empty = JB.run_scoring(app.limit(0), AD.drives(tel), None, MO.fixed_model(model_feature_names()))
    assert empty.status == "skipped"


def test_run_pipeline_query_zips_on_all_cores(spark, smoke_dir, monkeypatch):
    from fleetlens.plans import catalog_io
    parts, write = [], catalog_io.ZC.write_zip_csv

    def watched(df, *args):
        parts.append(df.rdd.getNumPartitions())
        return write(df, *args)

    monkeypatch.setattr(catalog_io.ZC, "write_zip_csv", watched)
    row, = catalog_io.q_run_pipeline(spark, smoke_dir).collect()
    assert parts == [max(4, spark.sparkContext.defaultParallelism)] and row.warehouse_rows == row.feature_rows > 0
