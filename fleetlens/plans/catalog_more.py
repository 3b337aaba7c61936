"""Registered queries for cleaning, cohort and fleet operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlens.functions import casts as C
from fleetlens.functions.dates import day_label
from fleetlens.functions.risk import capacity_tb, percent_1dp, safe_ratio
from fleetlens.operators import canonical as CA
from fleetlens.operators import cohort as CO
from fleetlens.operators import fleet as FL
from fleetlens.plans import adapters as AD
from fleetlens.plans.catalog import round6

COHORT = dict(lookback_days=45, min_history_days=25, max_drives=100, date_col="as_of_date")


# -- cleaning ---------------------------------------------------------------
def q_canonicalize(spark, d):
    return CA.canonicalize(AD.raw_text(spark, d))


def q_clean_text(spark, d):
    r = AD.raw_text(spark, d)
    return r.select(C.clean_text("serial").alias("serial_number"), C.clean_text("model_name").alias("model"),
                    C.clean_text("`Day`").alias("day_text"))


def q_safe_cast(spark, d):
    r = AD.raw_text(spark, d)
    return r.select(C.safe_cast("`Day`", "date").alias("date"), C.safe_cast("failure", "int").alias("failure"),
                    C.safe_cast("smart_5", "bigint").alias("smart_5_int"),
                    C.safe_cast("smart_5", "double").alias("smart_5_raw"))


def q_drop_null_keys(spark, d):
    return CA.drop_null_keys(CA.canonicalize(AD.raw_text(spark, d)))


def q_partition_keys(spark, d):
    df = CA.with_partition_keys(CA.drop_null_keys(CA.canonicalize(AD.raw_text(spark, d))))
    return df.select("date", "serial_number", "year", "month")


def q_failure_flag(spark, d):
    r = AD.raw_text(spark, d)
    return r.select(C.clean_text("serial").alias("serial_number"), C.failure_flag("failure").alias("is_failed_today"))


def q_default_fill(spark, d):
    r = AD.raw_text(spark, d)
    return r.select(C.clean_text("serial").alias("serial_number"), CA.default_model("model_name").alias("model"))


def q_narrow_types(spark, d):
    t = AD.telemetry_events(spark, d)
    return t.select("serial_number", "as_of_date",
                    *[C.narrow_double(m).alias(m.replace("_raw", "")) for m in
                      ("smart_5_raw", "smart_197_raw", "smart_198_raw", "smart_199_raw")])


def _nonfinite(spark, d):
    ev = AD.table(spark, d, "events").select("event_id", "value")
    k = F.col("event_id") % 7
    return ev.select("event_id", F.when(k == 0, F.lit(float("nan"))).when(k == 1, F.lit(float("inf")))
                     .when(k == 2, F.lit(float("-inf"))).when(k == 3, F.lit(None).cast("double"))
                     .otherwise(F.col("value")).alias("x"))


def q_finite_or_zero(spark, d):
    return _nonfinite(spark, d).select("event_id", C.finite_or("x", 0.0).alias("x"))


def q_finite_or_null(spark, d):
    return _nonfinite(spark, d).select("event_id", C.finite_or("x", None).alias("x"))


def q_union_by_name(spark, d):
    a = AD.telemetry_events(spark, d).select("serial_number", "as_of_date", "smart_5_raw")
    b = AD.telemetry_ship(spark, d).select("as_of_date", "serial_number", "temperature")
    return round6(a.unionByName(b, allowMissingColumns=True))


def q_date_range(spark, d):
    t = CA.with_partition_keys(AD.telemetry_ship(spark, d), "as_of_date")
    r = CA.date_range(t, "1998-01-15", "1998-03-31", "as_of_date", partition_cols=("year", "month"))
    return round6(r.select("serial_number", "as_of_date", "smart_5_raw"))


# -- cohort -----------------------------------------------------------------
def _cohort_inputs(spark, d):
    tel = AD.telemetry_events(spark, d)
    return tel, CO.latest_day(tel, "as_of_date")


def q_date_bounds(spark, d):
    return CO.date_bounds(AD.telemetry_ship(spark, d), "as_of_date")


def q_cohort_candidates(spark, d):
    tel, last = _cohort_inputs(spark, d)
    return CO.cohort_candidates(tel, last, COHORT["lookback_days"], COHORT["min_history_days"], "as_of_date")


def q_select_cohort(spark, d):
    tel, last = _cohort_inputs(spark, d)
    return CO.select_cohort(tel, last, **COHORT)


def q_cohort_telemetry(spark, d):
    import datetime as dt
    tel, last = _cohort_inputs(spark, d)
    sel = CO.select_cohort(tel, last, **COHORT)
    start = last - dt.timedelta(days=COHORT["lookback_days"])
    return CO.cohort_telemetry(tel, sel, start, last, COHORT["max_drives"], "as_of_date")


def q_drive_summary(spark, d):
    import datetime as dt
    tel, last = _cohort_inputs(spark, d)
    sel = CO.select_cohort(tel, last, **COHORT)
    start = last - dt.timedelta(days=COHORT["lookback_days"])
    return CO.drive_summary(tel, sel, start, last, COHORT["max_drives"], "as_of_date")


# -- fleet ------------------------------------------------------------------
def _app(spark, d):
    tel = AD.telemetry_events(spark, d)
    return AD.drives(tel), AD.predictions(tel), tel


def q_fleet_summary(spark, d):
    drv, pred, _ = _app(spark, d)
    return FL.fleet_summary(drv, pred)


def q_bucket_distribution(spark, d):
    _, pred, _ = _app(spark, d)
    return FL.bucket_distribution(pred, ["day"])


def q_latest_prediction(spark, d):
    _, pred, _ = _app(spark, d)
    return round6(FL.latest_prediction(pred))


def q_drives_with_bucket(spark, d):
    drv, pred, _ = _app(spark, d)
    return FL.drives_with_bucket(drv, pred, "HIGH")


def q_drive_page(spark, d):
    drv, pred, _ = _app(spark, d)
    return round6(FL.list_drives(drv, pred, None, page=2, page_size=25))


def q_drive_page_high(spark, d):
    drv, pred, _ = _app(spark, d)
    return round6(FL.list_drives(drv, pred, "high", page=1, page_size=25))


def q_drive_history(spark, d):
    tel = AD.telemetry_daily(AD.telemetry_ship(spark, d))
    h = FL.drive_history(tel, 60, "oldest")
    return round6(h.select("drive_id", "day", F.col("smart_5_raw").alias("smart5"),
                           F.col("smart_197_raw").alias("smart197"), F.col("smart_198_raw").alias("smart198"),
                           F.col("smart_199_raw").alias("smart199"), "temperature"))


def q_prediction_history(spark, d):
    _, pred, _ = _app(spark, d)
    h = FL.drive_history(pred, 20, "latest", tiebreak=["scored_at", "model_version"])
    return round6(h.select("drive_id", "day", "risk_score", "risk_bucket", "model_version"))


def q_capacity_lookup(spark, d):
    drv, _, tel = _app(spark, d)
    rows = AD.telemetry_daily(tel)
    known = drv.where(F.substring("drive_id", 7, 1) != "3")
    return FL.capacity_lookup(rows, known)


def q_high_risk_rate(spark, d):
    _, pred, _ = _app(spark, d)
    g = pred.groupBy("day").agg(F.count_if(F.col("risk_bucket") == "HIGH").alias("high"),
                                F.count(F.lit(1)).alias("scored"))
    return g.select("day", day_label("day").alias("day_label"), "high", "scored",
                    percent_1dp(safe_ratio("high", "scored")).alias("high_risk_rate"))


def q_dashboard_formats(spark, d):
    drv, pred, _ = _app(spark, d)
    lp = FL.latest_prediction(pred.select("drive_id", "day", "scored_at", "model_version", "risk_score"))
    j = drv.join(lp, "drive_id", "left")
    return j.select("drive_id", F.round(capacity_tb("capacity_bytes"), 6).alias("capacity_tb"),
                    percent_1dp("risk_score").alias("risk_pct"), day_label("day").alias("day_label"))


def q_top_risk_drives(spark, d):
    _, pred, tel = _app(spark, d)
    last = CO.latest_day(tel, "as_of_date")
    return round6(FL.top_risk_drives(pred, last, 10).select("drive_id", "day", "model_version", "risk_score"))


def queries() -> dict:
    from fleetlens.plans import catalog_model
    q = {
        "canonicalize": q_canonicalize, "clean_text": q_clean_text, "safe_cast": q_safe_cast,
        "drop_null_keys": q_drop_null_keys, "partition_keys": q_partition_keys,
        "failure_flag": q_failure_flag, "default_fill": q_default_fill, "narrow_types": q_narrow_types,
        "finite_or_zero": q_finite_or_zero, "finite_or_null": q_finite_or_null,
        "union_by_name": q_union_by_name, "date_range": q_date_range,
        "date_bounds": q_date_bounds, "cohort_candidates": q_cohort_candidates,
        "select_cohort": q_select_cohort, "cohort_telemetry": q_cohort_telemetry,
        "drive_summary": q_drive_summary,
        "fleet_summary": q_fleet_summary, "bucket_distribution": q_bucket_distribution,
        "latest_prediction": q_latest_prediction, "drives_with_bucket": q_drives_with_bucket,
        "drive_page": q_drive_page, "drive_page_high": q_drive_page_high,
        "drive_history": q_drive_history, "prediction_history": q_prediction_history,
        "capacity_lookup": q_capacity_lookup, "high_risk_rate": q_high_risk_rate,
        "dashboard_formats": q_dashboard_formats, "top_risk_drives": q_top_risk_drives,
    }
    q.update(catalog_model.queries())
    return q
