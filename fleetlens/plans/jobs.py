"""Composite jobs (C4-C8): each is a few lazy plans and one or two writes."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from fleetlens.operators import cohort as CO
from fleetlens.operators import evaluate as EV
from fleetlens.operators import features as FE
from fleetlens.operators import fleet as FL
from fleetlens.operators import merge as MG
from fleetlens.operators import model as MO
from fleetlens.operators import risk as RK
from fleetlens.operators import vectors as VE
from fleetlens.plans import registry as RG
from fleetlens.operators.canonical import dataset_hash
from fleetlens.schema import FEATURES_KEY, METRICS, PREDICTIONS_KEY, TELEMETRY_KEY, model_feature_names
from fleetlens.session import scratch_path
from fleetlens.sources import csv as CSV
from fleetlens.sources import links as LK
from fleetlens.sources import warehouse as WH
from fleetlens.sources import zipcsv as ZC
from fleetlens.sources.snapshots import SnapshotLog


# The reasons that a skipped scoring run reports.
NO_TELEMETRY = "No telemetry available"
NO_FEATURES = "No feature rows generated"


# -- C6: warehouse build ---------------------------------------------------------
def build_warehouse(spark: SparkSession, source: str, dest: str, kind: str = "zip",
                    max_files: int | None = None, mode: str = "append") -> int:
    """Raw daily CSVs (inside ZIPs or plain) -> canonical, partitioned ZSTD Parquet. Returns rows written."""
    df = ZC.read_zip_csv(spark, source, max_files) if kind == "zip" else CSV.ingest_csv(spark, source)
    written = Observation()
    WH.write_partitioned(df.observe(written, F.count(F.lit(1)).alias("rows")), dest, mode=mode, date_col="date")
    return written.get["rows"]


# -- C7: training -------------------------------------------------------------------
@dataclass
class ModelRun:
    model: MO.LinearModel
    split: MO.Split
    metrics: dict = field(default_factory=dict)


def evaluate(scored: DataFrame, y: str = "y", score: str = "score", key: list[str] | None = None) -> dict:
    """All test metrics; each is a distributed aggregate returning one small row."""
    ap = EV.average_precision(scored, y, score).first()[0]
    brier = EV.brier_score(scored, y, score).first()[0]
    (r1, _), (r5, _) = EV.recalls_at_top(scored, [0.01, 0.05], y, score, key)
    summ = EV.eval_summary(scored, y).first()
    cal = [r.asDict() for r in EV.calibration_bins(scored, y, score).orderBy("bin").collect()]
    return {"pr_auc": float(ap or 0.0), "brier_score": float(brier or 0.0), "recall_at_top_1pct": float(r1),
            "recall_at_top_5pct": float(r5), "test_rows": int(summ["test_rows"]),
            "positive_rate_test": float(summ["positive_rate_test"]), "calibration": cal}


def train(features: DataFrame, horizon_days: int = 30, test_months: int = 9, version: str | None = None,
          reg_param: float = 1e-5, max_iter: int = 100, embargo_days: int = 0) -> ModelRun:
    """Time split -> population-std scaling -> balanced L2 logistic fit -> distributed evaluation."""
    names = MO.numeric_features(features)
    train_df, test_df, split = MO.time_split(features, test_months, embargo_days=embargo_days)
    version = version or f"h{horizon_days}_{dt.datetime.now(dt.timezone.utc).strftime('%Y%m%d%H%M%S')}"
    model = MO.fit_logistic(train_df, names, "label_30d", version, horizon_days, reg_param, max_iter)
    # the scaler's means are the training matrix means (nulls as 0); those are the fill values
    eval_df = test_df if not test_df.isEmpty() else train_df
    m = MO.training_matrix(eval_df, names, keep=["serial_number", "as_of_date"])
    zero_fill = MO.LinearModel(**{**model.__dict__, "fills": {n: 0.0 for n in names}})
    scored = m.select("serial_number", "as_of_date", F.col("label_30d").alias("y"),
                      MO.sigmoid(MO.linear_score(zero_fill)).alias("score"))
    # several small aggregates read the scored test set: compute it once (spills to disk if large)
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        metrics = evaluate(scored, key=["serial_number", "as_of_date"])
    finally:
        scored.unpersist()
    model.metrics = metrics
    return ModelRun(model=model, split=split, metrics=metrics)


def register(spark: SparkSession, run: ModelRun, artifact_uri: str, manifest: DataFrame | None = None) -> DataFrame:
    """The registry row of a run; ``manifest`` (the dataset manifest) adds its hash to the lineage."""
    s = run.split
    window = {"train_start": s.min_date, "train_end": s.cutoff_date, "test_start": s.cutoff_date,
              "test_end": s.max_date}
    if manifest is not None:
        window["manifest_hash"] = dataset_hash(manifest, ["dataset_id", "url"]).first()[0]
    metrics = {k: v for k, v in run.metrics.items()}
    return RG.registry_row(spark, run.model.version, artifact_uri, metrics, run.model.features, window,
                           run.model.horizon_days)


def save_model(spark: SparkSession, model: MO.LinearModel, path: str) -> str:
    """Persist the coefficient table (one row per feature) as Parquet."""
    model.coefficients(spark).withColumn("intercept", F.lit(model.intercept)).withColumn(
        "model_version", F.lit(model.version)).withColumn("horizon_days", F.lit(model.horizon_days)).coalesce(
        1).write.mode("errorifexists").parquet(path)
    return path


def load_model(spark: SparkSession, path: str) -> MO.LinearModel:
    rows = sorted(spark.read.parquet(path).collect(), key=lambda r: r["position"])
    if not rows:
        raise FileNotFoundError(f"empty model at {path}")
    names = [r["feature"] for r in rows]
    return MO.LinearModel(features=names, weights={r["feature"]: r["weight"] for r in rows},
                          intercept=rows[0]["intercept"], means={r["feature"]: r["mean"] for r in rows},
                          scales={r["feature"]: r["scale"] for r in rows},
                          fills={r["feature"]: r["fill"] for r in rows}, version=rows[0]["model_version"],
                          horizon_days=rows[0]["horizon_days"])


# -- C5: cohort backfill -----------------------------------------------------------
@dataclass
class BackfillResult:
    drives: DataFrame
    telemetry: DataFrame
    audit: DataFrame
    latest_day: dt.date
    start_day: dt.date
    held: DataFrame | None = None

    def release(self) -> None:
        """Let go of the cached cohort, once the tables are written."""
        if self.held is not None:
            self.held.unpersist()


def backfill_fleet(warehouse: DataFrame, current_drives: DataFrame | None = None, lookback_days: int = 45,
                   min_history_days: int = 14, max_drives: int | None = 5000, latest_day=None,
                   date_col: str = "date", source: str = "warehouse") -> BackfillResult:
    """Cohort of recently active drives -> drive rows (upserted), their telemetry, one INGESTION audit row.

    The window slice of the warehouse is read once; cohort, summary and
    telemetry all derive from it.  Errors when no drive qualifies.
    """
    last = latest_day or CO.latest_day(warehouse, date_col)
    start = last - dt.timedelta(days=lookback_days)
    window = warehouse.where(F.col(date_col).cast("date").between(F.lit(start), F.lit(last)))
    cohort = CO.select_cohort(window, last, lookback_days, min_history_days, max_drives, date_col).persist()
    if cohort.isEmpty():
        cohort.unpersist()
        raise RuntimeError(f"the cohort is empty: no drive has {min_history_days} days up to {last}")
    summary = CO.drive_summary(window, cohort, start, last, max_drives, date_col)
    drives = summary if current_drives is None else MG.merge_drives(current_drives, summary)
    tel = CO.cohort_telemetry(window, cohort, start, last, max_drives, date_col)
    counts = tel.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("drive_id").alias("drives"))
    audit = RG.audit_from_counts(counts, "INGESTION", {
        "latest_day": F.lit(str(last)), "start_day": F.lit(str(start)), "selected_drives": F.col("drives"),
        "min_history_days": F.lit(min_history_days), "inserted_telemetry_rows": F.col("rows"),
        "source": F.lit(source), "loaded_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")})
    return BackfillResult(drives=drives, telemetry=tel, audit=audit, latest_day=last, start_day=start, held=cohort)


def load_backfill(result: BackfillResult, root: str, clear: bool = True) -> dict:
    """Write a backfill's tables under ``root``: drives, telemetry by day, and the audit row.

    ``clear`` replaces the telemetry; otherwise it is upserted by its key.  Drives are those
    of the result, which a merge with the current ones has already made whole.  Audit rows
    append.
    """
    spark = result.drives.sparkSession
    # the drives may derive from the table that is replaced: stage them first
    staged = spark.read.parquet(MG.write_snapshot(result.drives, "backfill-drives"))
    staged.write.mode("overwrite").parquet(f"{root}/drives")
    if clear:
        WH.load_telemetry(result.telemetry, f"{root}/telemetry", clear=True)
    else:
        by_day = result.telemetry.withColumn("day", F.col("day").cast("string"))
        MG.upsert_partitions(by_day, f"{root}/telemetry", TELEMETRY_KEY, "day")
    result.audit.write.mode("append").parquet(f"{root}/audit")
    return {"drives": f"{root}/drives", "telemetry": f"{root}/telemetry", "audit": f"{root}/audit"}


# -- C4: scoring run --------------------------------------------------------------------
@dataclass
class ScoreRun:
    status: str
    day: dt.date | None
    features: DataFrame | None = None
    predictions: DataFrame | None = None
    audit: DataFrame | None = None
    reason: str | None = None
    held: DataFrame | None = None

    def release(self) -> None:
        """Let go of the cached features, once the tables are written."""
        if self.held is not None:
            self.held.unpersist()


def run_scoring(telemetry: DataFrame, drives: DataFrame, predictions: DataFrame | None, model: MO.LinearModel,
                day=None, features_store: DataFrame | None = None, mode: str = "consistent") -> ScoreRun:
    """Features for the day -> (merge into the feature store) -> score -> rank fallback -> merge predictions.

    Returns lazily built tables plus an audit row built from their aggregates;
    writing them is the caller's single action per table, then ``release()`` frees the
    day's cached features (the ``publish_`` and ``persist_`` functions do both).
    """
    day = FL.validate_day(day)
    if day is None:
        try:
            day = CO.latest_day(telemetry, "day")
        except RuntimeError:
            return ScoreRun("skipped", None, reason=NO_TELEMETRY)
    # one row per drive for one day: bounded by the fleet size, reused by every step below
    feats = FE.features_for_day(telemetry, drives, day, METRICS, mode=mode).persist()
    if feats.isEmpty():
        feats.unpersist()
        return ScoreRun("skipped", day, reason=NO_FEATURES)
    names = model.features
    stored = VE.features_daily_row(feats, model_feature_names())
    store = stored if features_store is None else MG.merge_by_key(features_store, stored, FEATURES_KEY)
    vec_rows = VE.vector_fallback(stored, names)
    scored = MO.score_batch(vec_rows, model, ["drive_id", "day"])
    final = RK.rank_fallback(scored.withColumnRenamed("top_reasons", "reason_codes"))
    out = final.select("drive_id", "day", "model_version", "risk_score", "risk_bucket", "reason_codes",
                       "scored_at", "model_score", "bucket_mode")
    merged = out if predictions is None else MG.merge_by_key(
        predictions, out.select(*predictions.columns), PREDICTIONS_KEY)
    b = F.col("risk_bucket")
    counts = out.agg(F.count(F.lit(1)).alias("n"), F.max("bucket_mode").alias("mode"),
                     F.count_if(b == "LOW").alias("LOW"), F.count_if(b == "MED").alias("MED"),
                     F.count_if(b == "HIGH").alias("HIGH"))
    audit = RG.audit_from_counts(counts, "SCORE_RUN", {
        "day": F.lit(str(day)), "generatedFeatures": F.col("n"), "storedPredictions": F.col("n"),
        "modelVersion": F.lit(model.version), "bucketMode": F.col("mode"),
        "riskDistribution": F.struct("LOW", "MED", "HIGH")})
    return ScoreRun("completed", day, features=store, predictions=merged, audit=audit, held=feats)


def score_run_summary(run: ScoreRun) -> DataFrame:
    """The run result as one row (status, day, counts, version, bucket mode, distribution)."""
    p = run.predictions.where(F.col("day") == F.lit(run.day)).where(F.col("bucket_mode").isNotNull()) \
        if "bucket_mode" in run.predictions.columns else run.predictions.where(F.col("day") == F.lit(run.day))
    b = F.col("risk_bucket")
    return p.agg(F.lit(run.status).alias("status"), F.lit(run.day).alias("day"),
                 F.count(F.lit(1)).alias("stored_predictions"), F.max("model_version").alias("model_version"),
                 F.max("bucket_mode").alias("bucket_mode"), F.count_if(b == "LOW").alias("low"),
                 F.count_if(b == "MED").alias("med"), F.count_if(b == "HIGH").alias("high"))


# -- C8: end-to-end -------------------------------------------------------------------------
def archive_manifest(spark: SparkSession, source: str) -> DataFrame:
    """A manifest of the archives of a run, for sources that come without one: id, year, period, name, place."""
    entries = ZC.zip_entries(spark, source).select("archive").distinct()
    name = LK.file_name(F.col("archive"))
    year, period = LK.year_period(name)
    return entries.select(F.concat_ws("_", year.cast("string"), period, name).alias("dataset_id"), year.alias("year"),
                          period.alias("period"), name.alias("file_name"), F.col("archive").alias("url"))


def run_pipeline(spark: SparkSession, source: str, kind: str = "zip", horizon_days: int = 30,
                 test_months: int = 9, root: str | None = None, manifest: DataFrame | None = None) -> dict:
    """manifest -> raw files -> warehouse -> features -> model -> registry; every hand-off is a Parquet path.

    ``manifest`` is the dataset manifest that the files came by (``dataset_manifest`` of the
    vendor's pages); without one the archives themselves are listed.  It is written beside the
    other tables and its hash goes into the registry row, so a model names the data it saw.
    """
    root = root or scratch_path(spark, "pipeline")
    if manifest is None and kind == "zip":
        manifest = archive_manifest(spark, source)
    if manifest is not None:
        manifest.write.parquet(f"{root}/manifest")
        manifest = spark.read.schema(manifest.schema).parquet(f"{root}/manifest")
    wh = f"{root}/warehouse"
    rows = build_warehouse(spark, source, wh, kind)
    feats_path = f"{root}/features"
    feats = FE.build_features(WH.scan_warehouse(spark, wh), METRICS, horizon_days, date_col="date")
    WH.write_partitioned(feats.drop("year", "month"), feats_path, mode="overwrite", date_col="as_of_date")
    features = WH.scan_warehouse(spark, feats_path, schema=feats.schema)
    run = train(features.drop("year", "month"), horizon_days, test_months)
    model_path = save_model(spark, run.model, f"{root}/models/{run.model.version}")
    reg = register(spark, run, model_path, manifest)
    reg.write.mode("append").parquet(f"{root}/registry")
    return {"warehouse_rows": rows, "warehouse": wh, "features": feats_path, "model": model_path,
            "registry": f"{root}/registry", "manifest": f"{root}/manifest" if manifest is not None else None, "metrics": run.metrics}


def publish_scoring_run(run: ScoreRun, log: SnapshotLog, run_id: str) -> dict:
    """A completed run as one commit: predictions, latest predictions, features and the audit row show together.

    Predictions and features are upserted in the scored day's partition, the latest
    predictions keep the greatest of each drive.  A run that dies before the commit changes
    nothing, a repeated ``run_id`` is not done again, and a commit that came between is
    merged with (``SnapshotLog.publish``).
    """
    if run.status != "completed":
        return {"status": run.status, "reason": run.reason}
    day = F.lit(run.day)
    preds = run.predictions.where(F.col("day") == day)

    def build(work) -> None:
        work.upsert("predictions", preds, PREDICTIONS_KEY, "day", order=["scored_at"])
        work.fold_latest("latest_predictions", preds, "drive_id", FL.LATEST_ORDER)
        work.upsert("features", run.features.where(F.col("day") == day), FEATURES_KEY, "day")
        work.append("audit", run.audit)

    try:
        version = log.publish(run_id, build)
    finally:
        run.release()
    return {"status": run.status, "day": str(run.day), "version": version}


def publish_features(features: DataFrame, log: SnapshotLog, run_id: str, table: str = "features_offline",
                     placed: bool = False) -> int:
    """The feature table (or the months that ``features`` has) replaced in one commit; readers never see half of it.

    ``placed``: the rows were read from a table with the same months as partitions and aren't shuffled again."""
    return log.publish(run_id, lambda work: work.replace(table, features, ["year", "month"], placed=placed))


def persist_scoring_run(run: ScoreRun, predictions_path: str, features_path: str | None = None,
                        audit_path: str | None = None) -> dict:
    """Write a completed run to plain tables: predictions and features upserted into their day-partitioned
    tables (only the scored day's partition is rewritten), the audit row appended.  Three writes:
    ``publish_scoring_run`` is the one that shows them together."""
    if run.status != "completed":
        return {"status": run.status, "reason": run.reason}
    day = F.lit(run.day)
    preds = run.predictions.where(F.col("day") == day).withColumn("day", F.col("day").cast("string"))
    n = MG.upsert_partitions(preds, predictions_path, PREDICTIONS_KEY, "day")
    if features_path and run.features is not None:
        feats = run.features.where(F.col("day") == day).withColumn("day", F.col("day").cast("string"))
        MG.upsert_partitions(feats, features_path, FEATURES_KEY, "day")
    if audit_path and run.audit is not None:
        run.audit.write.mode("append").parquet(audit_path)
    run.release()
    return {"status": run.status, "day": str(run.day), "partitions_rewritten": n}
