"""Registered queries for online features, vectors, scoring, ranking, evaluation and contracts."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions.risk import risk_bucket
from fleetlens.operators import contracts as CT
from fleetlens.operators import evaluate as EV
from fleetlens.operators import features as FE
from fleetlens.operators import model as MO
from fleetlens.operators import risk as RK
from fleetlens.operators import vectors as VE
from fleetlens.operators import windows as W
from fleetlens.operators.cohort import latest_day
from fleetlens.plans import adapters as AD
from fleetlens.plans.catalog import round6
from fleetlens.schema import METRICS, model_feature_names

FEATURES = model_feature_names()


def _ffd(spark, d):
    """Online features of the latest telemetry day (events telemetry, drives table for capacity)."""
    tel = AD.telemetry_events(spark, d)
    app = AD.telemetry_daily(tel)
    day = latest_day(app, "day")
    return FE.features_for_day(app, AD.drives(tel), day, METRICS, mode="compat")


def q_features_for_day(spark, d):
    return round6(_ffd(spark, d))


def q_features_for_day_consistent(spark, d):
    tel = AD.telemetry_events(spark, d)
    day = latest_day(tel, "as_of_date")
    return round6(FE.features_for_day(tel, None, day, METRICS, mode="consistent", horizon_days=30))


def q_features_daily_row(spark, d):
    return round6(VE.features_daily_row(_ffd(spark, d)).drop("feature_vector"))


def q_vector_json(spark, d):
    rows = VE.features_daily_row(_ffd(spark, d))
    back = rows.select("drive_id", "day", VE.vector_from_json(F.col("feature_vector")).alias("features"))
    return round6(VE.explode_vector(back, ["drive_id", "day"]))


def q_vector_fallback(spark, d):
    rows = VE.features_daily_row(_ffd(spark, d))
    strip = F.substring("drive_id", 7, 1) == "1"
    vec = VE.vector_from_json(F.col("feature_vector"))
    stripped = F.map_filter(vec, lambda k, v: ~k.isin("age_days", "smart_5_raw_mean_7d"))
    rows = rows.withColumns({
        "feature_vector": F.to_json(F.when(strip, stripped).otherwise(vec)),
        "age_days": F.when(strip, F.col("age_days") + 1000).otherwise(F.col("age_days")),
    })
    out = VE.vector_fallback(rows, FEATURES)
    return round6(out.select("drive_id", "day", "age_days", "smart_5_raw_mean_7d", "smart_197_raw_mean_7d",
                             "temperature_mean_30d"))


def q_normalize_features(spark, d):
    f = _ffd(spark, d).drop("temperature_is_increasing").withColumn("bogus", F.lit(1.0))
    return round6(VE.normalize_features(f, FEATURES))


def q_schema_mismatch(spark, d):
    f = _ffd(spark, d)
    vec = VE.to_vector(f, FEATURES)
    last = F.substring("drive_id", 7, 1)
    drop = F.map_filter(vec, lambda k, v: k != "age_days")
    vec = F.when(last.isin("2", "6"), drop).otherwise(vec)
    vec = F.when(last.isin("4", "6"), F.map_concat(vec, F.create_map(F.lit("extra_feature"), F.lit(1.0)))
                 ).otherwise(vec)
    m = VE.schema_mismatch(f.select("drive_id", "day", vec.alias("features")), FEATURES)
    return m.select("drive_id", "day", F.array_join("missing", ",").alias("missing"),
                    F.array_join("unexpected", ",").alias("unexpected"), "message")


def _offline(spark, d, adapter=AD.telemetry_events, horizon=7):
    return FE.build_features(adapter(spark, d), METRICS, horizon_days=horizon)


def q_feature_moments(spark, d):
    f = _offline(spark, d)
    names = MO.numeric_features(f)
    # bytes are compared in units of 10^12, so that six digits are within a double's precision
    unit = F.when(F.col("feature") == "capacity_bytes", 1e12).otherwise(1.0)
    moments = MO.feature_moments(MO.training_matrix(f, names), names)
    return round6(moments.withColumns({c: F.col(c) / unit for c in ("mean", "std")}))


def q_scale_features(spark, d):
    f = _offline(spark, d)
    names = MO.numeric_features(f)
    m = MO.training_matrix(f, names, keep=["serial_number", "as_of_date"])
    mom = MO.collect_moments(MO.feature_moments(m, names))
    return round6(MO.scale_features(m.drop("label_30d"), names, mom))


def q_impute_mean(spark, d):
    f = _offline(spark, d)
    names = MO.numeric_features(f)
    mom = MO.collect_moments(MO.feature_moments(MO.training_matrix(f, names), names))
    cols = [f"{m}_mean_7d" for m in METRICS]
    return round6(MO.impute(f.select("serial_number", "as_of_date", *cols), cols, {c: mom[c][0] for c in cols}))


def q_class_weights(spark, d):
    return round6(MO.class_weights(_offline(spark, d, AD.telemetry_ship, 30)))


def _split_query(adapter, horizon):
    def run(spark, d):
        f = _offline(spark, d, adapter, horizon)
        train, test, split = MO.time_split(f, test_months=9)
        parts = [p.groupBy().agg(F.count(F.lit(1)).alias("rows"), F.sum("label_30d").cast("bigint")
                                 .alias("positives")).select(F.lit(name).alias("part"), "rows", "positives")
                 for name, p in (("train", train), ("test", test))]
        return parts[0].unionByName(parts[1]).withColumn("cutoff_date", F.lit(split.cutoff_date))
    return run


def _scored(spark, d):
    f = _ffd(spark, d)
    return MO.score_batch(f, MO.fixed_model(FEATURES), ["drive_id", "day"])


def q_score_linear(spark, d):
    f = _ffd(spark, d)
    model = MO.fixed_model(FEATURES)
    return round6(f.select("drive_id", "day", MO.linear_score(model).alias("z"),
                           F.round(MO.sigmoid(MO.linear_score(model)), 6).alias("risk_score")))


def q_score_batch(spark, d):
    return round6(_scored(spark, d).select("drive_id", "day", "risk_score", "risk_bucket", "model_version"))


def q_top_reasons(spark, d):
    s = _scored(spark, d)
    e = s.select("drive_id", "day", F.posexplode("top_reasons").alias("pos", "r"))
    return round6(e.select("drive_id", "day", (F.col("pos") + 1).alias("rank"), "r.code", "r.contribution",
                           "r.direction"))


def q_risk_bucket(spark, d):
    t = AD.telemetry_events(spark, d)
    a = F.col("smart_187_raw") / 4.0
    b = F.col("smart_188_raw") / 5.0
    return round6(t.select("serial_number", "as_of_date", a.alias("score_a"), risk_bucket(a).alias("bucket_a"),
                           b.alias("score_b"), risk_bucket(b).alias("bucket_b")))


def q_risk_rank(spark, d):
    p = AD.predictions(AD.telemetry_events(spark, d)).where(F.col("model_version") == "v2")
    return round6(RK.risk_rank(p).select("drive_id", "day", "risk_score", "risk_rank"))


def q_rank_fallback(spark, d):
    p = AD.predictions_low(AD.telemetry_events(spark, d))
    # some rows have no day: they are a batch of their own; one day keeps the model's buckets
    p = p.withColumns({"day": F.when(F.substring("drive_id", 7, 1) != "9", F.col("day")),
                       "risk_bucket": F.when((F.col("day") == F.lit("2024-01-15").cast("date")) & (F.substring("drive_id", 7, 1) == "1"), "MED")
                       .otherwise(F.col("risk_bucket"))})
    return round6(RK.rank_fallback(p).drop("scored_at"))


def _eval_input(spark, d):
    t = W.with_first_days(AD.telemetry_events(spark, d))
    return t.select(F.col("serial_number").alias("k"), "as_of_date",
                    W.label_within(F.col("as_of_date"), F.col("first_failure"), 7).alias("y"),
                    (F.col("smart_5_raw") / (F.col("smart_5_raw") + 100)).alias("score"))


def q_average_precision(spark, d):
    return round6(EV.average_precision(_eval_input(spark, d)))


def q_brier_score(spark, d):
    return round6(EV.brier_score(_eval_input(spark, d)))


def q_recall_at_top(spark, d):
    (r1, k1), (r5, k5) = EV.recalls_at_top(_eval_input(spark, d), [0.01, 0.05], key=["k", "as_of_date"])
    return round6(spark.range(1).select(F.lit(r1).alias("recall_at_top_1pct"), F.lit(k1).cast("bigint").alias("k_1pct"),
                                        F.lit(r5).alias("recall_at_top_5pct"), F.lit(k5).cast("bigint").alias("k_5pct")))


def q_recall_ties(spark, d):
    """The same over a score with very heavy ties (tenths), cut inside a tie."""
    e = _eval_input(spark, d).withColumn("score", F.floor(F.col("score") * 10) / 10)
    (r, k), = EV.recalls_at_top(e, [0.03], key=["k", "as_of_date"])
    return round6(spark.range(1).select(F.lit(r).alias("recall"), F.lit(k).cast("bigint").alias("k")))


def q_calibration_bins(spark, d):
    return round6(EV.calibration_bins(_eval_input(spark, d)))


def q_eval_summary(spark, d):
    return round6(EV.eval_summary(_eval_input(spark, d)))


# -- contracts ----------------------------------------------------------------
def q_validate_features(spark, d):
    f = _ffd(spark, d)
    last = F.substring("drive_id", 7, 1)
    v = f.select(F.when(last == "8", F.lit(" ")).otherwise(F.col("drive_id")).alias("drive_id"), "day",
                 F.when(last == "3", F.lit(None)).otherwise(VE.to_vector(f, FEATURES)).alias("features"))
    return CT.validate_features(v)


def _bad_predictions(spark, d):
    p = AD.predictions(AD.telemetry_events(spark, d))
    last = F.substring("drive_id", 7, 1)
    return p.select(
        "drive_id", "day",
        F.when(last == "9", F.col("risk_score") + 1).otherwise(F.col("risk_score")).alias("risk_score"),
        F.when(last == "4", F.lower("risk_bucket")).otherwise(F.col("risk_bucket")).alias("risk_bucket"),
        F.when(last == "6", F.lit("")).otherwise(F.col("model_version")).alias("model_version"),
        F.when(last == "8", F.lit(None)).otherwise(F.col("scored_at")).alias("scored_at"),
        F.array(F.struct(F.when(last == "3", "SIDEWAYS").otherwise("UP").alias("direction"))).alias("top_reasons"))


def q_validate_predictions(spark, d):
    return CT.validate_predictions(_bad_predictions(spark, d))


def q_validate_drives(spark, d):
    dr = AD.drives(AD.telemetry_events(spark, d))
    last = F.substring("drive_id", 7, 1)
    dr = dr.withColumns({
        "capacity_bytes": F.when(last == "5", -F.col("capacity_bytes")).otherwise(F.col("capacity_bytes")),
        "model": F.when(last == "2", F.lit(None)).otherwise(F.col("model"))})
    return CT.validate_drives(dr)


def q_duplicate_keys(spark, d):
    t = AD.telemetry_daily(AD.telemetry_events(spark, d))
    again = t.where(F.substring("drive_id", 7, 1) == "3")
    return CT.duplicate_keys(t.unionByName(again), ["drive_id", "day"])


def q_orphan_rows(spark, d):
    tel = AD.telemetry_events(spark, d)
    dr = AD.drives(tel).where(F.substring("drive_id", 7, 1) != "4")
    return CT.orphan_rows(AD.predictions(tel), dr).select("drive_id", "day", "model_version")


def q_cascade_delete(spark, d):
    tel = AD.telemetry_events(spark, d)
    gone = AD.drives(tel).where(F.substring("drive_id", 7, 1) == "1")
    return CT.cascade_delete(AD.predictions(tel), gone).select("drive_id", "day", "model_version")


def queries() -> dict:
    from fleetlens.plans import catalog_io
    q = {
        "features_for_day": q_features_for_day,
        "features_for_day_consistent": q_features_for_day_consistent,
        "features_daily_row": q_features_daily_row, "vector_json": q_vector_json,
        "vector_fallback": q_vector_fallback, "normalize_features": q_normalize_features,
        "schema_mismatch": q_schema_mismatch, "feature_moments": q_feature_moments,
        "scale_features": q_scale_features, "impute_mean": q_impute_mean, "class_weights": q_class_weights,
        "time_split": _split_query(AD.telemetry_events, 7), "time_split_ship": _split_query(AD.telemetry_ship, 30),
        "score_linear": q_score_linear, "score_batch": q_score_batch, "top_reasons": q_top_reasons,
        "risk_bucket": q_risk_bucket, "risk_rank": q_risk_rank, "rank_fallback": q_rank_fallback,
        "average_precision": q_average_precision, "brier_score": q_brier_score,
        "recall_at_top": q_recall_at_top, "recall_ties": q_recall_ties, "calibration_bins": q_calibration_bins,
        "eval_summary": q_eval_summary,
        "validate_features": q_validate_features, "validate_predictions": q_validate_predictions,
        "validate_drives": q_validate_drives, "duplicate_keys": q_duplicate_keys,
        "orphan_rows": q_orphan_rows, "cascade_delete": q_cascade_delete,
    }
    q.update(catalog_io.queries())
    return q
