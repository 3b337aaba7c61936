"""Registered queries for merges, audit, files, links, jobs and streaming."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fleetlens.operators import canonical as CA
from fleetlens.operators import cohort as CO
from fleetlens.functions import casts as CS
from fleetlens.operators import features as FE
from fleetlens.operators import fleet as FL
from fleetlens.operators import merge as MG
from fleetlens.operators import model as MO
from fleetlens.plans import adapters as AD
from fleetlens.plans import jobs as JB
from fleetlens.plans import registry as RG
from fleetlens.plans.catalog import round6
from fleetlens.schema import FEATURES_KEY, METRICS, PREDICTIONS_KEY, model_feature_names
from fleetlens.session import scratch_path
from fleetlens.sources import csv as CSV
from fleetlens.sources import links as LK
from fleetlens.sources import warehouse as WH
from fleetlens.sources import zipcsv as ZC
from fleetlens.sources.snapshots import SnapshotLog


def _last(col="drive_id"):
    return F.substring(col, 7, 1)


def q_merge_drives(spark, d):
    dr = AD.drives(AD.telemetry_events(spark, d))
    cur = dr.where(_last() < "7")
    inc = dr.where(_last() >= "4").select(
        "drive_id", F.concat("model", F.lit("x")).alias("model"),
        F.when(_last() == "5", F.lit(None)).otherwise(F.col("capacity_bytes") * 2).cast("bigint")
        .alias("capacity_bytes"),
        F.lit("dc-new").alias("datacenter"), F.date_sub("first_seen", 3).alias("first_seen"),
        F.date_sub("last_seen", 1).alias("last_seen"))
    # some drives come twice: the row seen last names the model, the widest span and greatest capacity count
    again = inc.where(_last() == "6").select(
        "drive_id", F.concat("model", F.lit("y")).alias("model"), (F.col("capacity_bytes") + 1).alias("capacity_bytes"),
        F.lit("dc-old").alias("datacenter"), F.date_sub("first_seen", 2).alias("first_seen"), F.date_sub("last_seen", 9).alias("last_seen"))
    return MG.merge_drives(cur, inc.unionByName(again))


def q_merge_features(spark, d):
    cur = AD.telemetry_daily(AD.telemetry_events(spark, d))
    upd = cur.where(F.col("day") >= F.lit("2024-01-25").cast("date")).withColumn(
        "smart_5_raw", F.col("smart_5_raw") * 2)
    new = cur.where(_last() == "0").withColumn("day", F.date_add("day", 31))
    return round6(MG.merge_by_key(cur, upd.unionByName(new), ["drive_id", "day"]))


def q_merge_predictions(spark, d):
    tel = AD.telemetry_events(spark, d)
    cur = AD.predictions(tel)
    last = CO.latest_day(tel, "as_of_date")
    upd = cur.where((F.col("day") == F.lit(last)) & (F.col("model_version") == "v2")).withColumns({
        "risk_score": F.col("risk_score") / 2,
        "scored_at": F.col("scored_at") + F.expr("INTERVAL 1 DAY")})
    upd = upd.withColumn("risk_bucket", F.when(F.col("risk_score") >= 0.75, "HIGH")
                         .when(F.col("risk_score") >= 0.4, "MED").otherwise("LOW"))
    new = cur.where((_last() == "3") & (F.col("model_version") == "v2")).withColumn("model_version", F.lit("v3"))
    # rows without a version, in both tables: a null key part is a value
    bare = cur.where((_last() == "5") & (F.col("model_version") == "v1")).withColumn("model_version", F.lit(None).cast("string"))
    inc = upd.unionByName(new).unionByName(bare.withColumn("risk_score", F.col("risk_score") / 4))
    return round6(MG.merge_by_key(cur.unionByName(bare), inc, ["drive_id", "day", "model_version"]))


def q_insert_if_absent(spark, d):
    dr = AD.drives(AD.telemetry_events(spark, d))
    cur = dr.where(_last() < "5")
    inc = dr.unionByName(dr.withColumn("model", F.concat(F.lit("Z"), "model")))
    return MG.insert_if_absent(cur, inc, ["drive_id"])


def q_audit_event(spark, d):
    tel = AD.telemetry_events(spark, d)
    last = CO.latest_day(tel, "as_of_date")
    sel = CO.select_cohort(tel, last, 45, 25, 100, "as_of_date")
    t = CO.cohort_telemetry(tel, sel, last - dt.timedelta(days=45), last, 100, "as_of_date")
    counts = t.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("drive_id").alias("drives"))
    a = RG.audit_from_counts(counts, "INGESTION", {
        "latest_day": F.lit(str(last)), "selected_drives": F.col("drives"), "min_history_days": F.lit(25),
        "inserted_telemetry_rows": F.col("rows")})
    return a.select("action", "drive_id", "payload")


# -- files ----------------------------------------------------------------------------
def q_ingest_csv(spark, d):
    path = scratch_path(spark, "csv")
    CSV.write_csv_text(AD.raw_text(spark, d), path)
    return CSV.ingest_csv(spark, path)


def _drift_parts(spark, d):
    ev = AD.table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    day = F.to_date("ts").cast("string")
    serial = F.concat(F.lit("U"), F.col("user_id").cast("string"))
    a = ev.where(F.col("event_id") % 2 == 0).select(
        day.alias("Day"), serial.alias("serial"), F.lit(" M1").alias("model_name"),
        F.when(F.col("event_type") == "error", "1").otherwise("0").alias("failure"),
        F.col("value").cast("string").alias("smart_5"))
    b = ev.where(F.col("event_id") % 2 == 1).select(
        F.col("value").cast("string").alias("temperature_raw"),
        F.when(F.col("event_type") == "error", "1").otherwise("0").alias("is_failed_today"),
        serial.alias("serial_number"), F.lit("M2 ").alias("model"), day.alias("date"),
        F.col("value").cast("string").alias("smart_5_raw"))
    return a, b


def q_ingest_csv_drift(spark, d):
    a, b = _drift_parts(spark, d)
    root = scratch_path(spark, "csv-drift")
    CSV.write_csv_text(a, f"{root}/a")
    CSV.write_csv_text(b, f"{root}/b")
    return CSV.ingest_csv(spark, root)


def q_ingest_zip_csv(spark, d):
    root = scratch_path(spark, "zip")
    ZC.write_zip_csv(AD.raw_text(spark, d).repartition(4), root).collect()
    return ZC.read_zip_csv(spark, root)


def q_skip_metadata_entries(spark, d):
    root = scratch_path(spark, "zip-meta")
    ZC.write_zip_csv(AD.raw_text(spark, d).repartition(3), root).collect()
    return ZC.zip_entries(spark, root).select(
        F.regexp_extract("entry", r"([^/]*)$", 1).alias("entry_name"), "header")


def q_write_warehouse(spark, d):
    path = scratch_path(spark, "warehouse")
    df = CA.drop_null_keys(CA.canonicalize(AD.raw_text(spark, d)))
    WH.write_partitioned(df, path, mode="append")
    return WH.scan_warehouse(spark, path)


def q_scan_warehouse(spark, d):
    path = scratch_path(spark, "warehouse-ship")
    t = AD.telemetry_ship(spark, d).withColumnRenamed("as_of_date", "date")
    WH.write_partitioned(t, path, mode="overwrite")
    s = WH.scan_warehouse(spark, path, "1998-01-15", "1998-03-31", schema=t.schema)
    return round6(s.select("serial_number", "date", "smart_5_raw", "year", "month"))


def q_write_features(spark, d):
    path = scratch_path(spark, "features")
    f = FE.build_features(AD.telemetry_ship(spark, d), METRICS, 30, source=AD.source_rows(AD.telemetry_ship, spark, d))
    WH.write_partitioned(f.drop("year", "month"), path, mode="overwrite", date_col="as_of_date")
    return round6(WH.scan_warehouse(spark, path, schema=f.schema))


def q_load_telemetry(spark, d):
    tel = AD.telemetry_events(spark, d)
    last = CO.latest_day(tel, "as_of_date")
    sel = CO.select_cohort(tel, last, 45, 25, 100, "as_of_date")
    t = CO.cohort_telemetry(tel, sel, last - dt.timedelta(days=45), last, 100, "as_of_date")
    path = scratch_path(spark, "telemetry")
    WH.load_telemetry(t, path, clear=True)
    back = spark.read.parquet(path)
    return back.withColumn("day", F.col("day").cast("date")).select(*t.columns)


def _trapped(spark, d):
    """The pages, each with a link in a script, references, and anchors that are very long or never closed."""
    many = F.col("page_id") % 25 == 0

    def filler(sign, n):
        return F.repeat(F.lit(sign), F.when(many, n).otherwise(3))

    html = F.concat("html", F.lit("<script>var a = \"<a href='scripted.zip'>\";</script><a title="), filler("y", 100_000),
                    F.lit(' href="a&#x2F;long.zip">l</a><A class="c"\n href=caf&eacute;.zip?x=1&amp;y=2&copy=3>e</A><a name '),
                    filler("z", 20_000))
    return AD.table(spark, d, "pages").select("page_id", "url", html.alias("html"))


def q_page_links(spark, d):
    return LK.page_links(_trapped(spark, d)).select("page_id", "pos", "href", "link")


def q_dataset_links(spark, d):
    return LK.extract_dataset_links(_trapped(spark, d), suffix="", markers=["example.com"])


def q_limit_rows(spark, d):
    t = CA.limit_rows(AD.telemetry_ship(spark, d), ["serial_number", "as_of_date"], 1000)
    return round6(t.select("serial_number", "as_of_date", "smart_5_raw"))


def q_sample_rows(spark, d):
    keys = ["serial_number", "as_of_date"]
    return CA.sample_rows(AD.telemetry_ship(spark, d), keys, 10).select(*keys)


def q_dataset_hash(spark, d):
    return CA.dataset_hash(LK.page_links(AD.table(spark, d, "pages")), ["page_id", "pos", "link"])


# -- jobs ---------------------------------------------------------------------------------
def q_backfill_cohort(spark, d):
    tel = AD.telemetry_events(spark, d)
    r = JB.backfill_fleet(tel, None, 45, 25, 100, date_col="as_of_date")
    return r.audit.select(F.from_json("payload", "latest_day string, start_day string, selected_drives bigint, "
                                                 "min_history_days int, inserted_telemetry_rows bigint").alias("p")
                          ).select("p.*")


def q_score_run(spark, d):
    tel = AD.telemetry_events(spark, d)
    app = AD.telemetry_daily(tel)
    run = JB.run_scoring(app, AD.drives(tel), None, MO.fixed_model(model_feature_names()), mode="compat")
    return JB.score_run_summary(run)


def q_score_run_consistent(spark, d):
    tel = AD.telemetry_events(spark, d)
    run = JB.run_scoring(AD.telemetry_daily(tel), AD.drives(tel), None, MO.fixed_model(model_feature_names()))
    return JB.score_run_summary(run)


def q_load_backfill(spark, d):
    """The telemetry that a backfill writes, cleared first and then upserted again."""
    tel = AD.telemetry_events(spark, d)
    root = scratch_path(spark, "backfill")
    run = JB.backfill_fleet(tel, None, 45, 25, 100, date_col="as_of_date")
    JB.load_backfill(run, root, clear=True)
    tables = JB.load_backfill(run, root, clear=False)
    return spark.read.schema(run.telemetry.schema).parquet(tables["telemetry"]).select(run.telemetry.columns)


def _trained(spark, d):
    f = FE.build_features(AD.telemetry_events(spark, d), METRICS, 7)
    return JB.train(f, horizon_days=7, test_months=9, version="events-h7", max_iter=50)


def q_train_logistic(spark, d):
    run = _trained(spark, d)
    m = {k: v for k, v in run.metrics.items() if k != "calibration"}
    return spark.createDataFrame([m])


def q_train_optimum(spark, d):
    """The training split and whether the fit is the objective's optimum there."""
    f = FE.build_features(AD.telemetry_events(spark, d), METRICS, 7)
    train, _, _ = MO.time_split(f, test_months=9)
    model = MO.fit_logistic(train, MO.numeric_features(f), horizon_days=7, max_iter=200)
    at = MO.optimality(train, model)
    return at.select(F.col("rows").alias("train_rows"), "positives", (F.col("largest_slope") < 0.001).alias("at_optimum"))


def q_active_model(spark, d):
    run = _trained(spark, d)
    good = JB.register(spark, run, "memory://events-h7")
    bad = RG.registry_row(spark, "partial", "memory://partial", {}, run.model.features, {}, 7, status="incomplete",
                          train_date=dt.datetime(2100, 1, 1))
    return RG.active_model(good.unionByName(bad)).select("model_version", "horizon_days", "status")


def q_stream_landing(spark, d):
    from fleetlens.streaming.landing import ingest_landing
    root = scratch_path(spark, "landing")
    raw = AD.raw_text(spark, d)
    CSV.write_csv_text(raw, f"{root}/in")
    ingest_landing(spark, f"{root}/in", f"{root}/table", checkpoint=f"{root}/ckpt")
    # a second run finds no new files and must add nothing
    ingest_landing(spark, f"{root}/in", f"{root}/table", checkpoint=f"{root}/ckpt")
    return spark.read.parquet(f"{root}/table").drop("year", "month")


def q_telemetry_window(spark, d):
    app = AD.telemetry_daily(AD.telemetry_events(spark, d))
    day = CO.latest_day(app, "day")
    return round6(FE.telemetry_window(app, day, 30).select("drive_id", "day", "smart_5_raw", "temperature"))


def q_utc_day(spark, d):
    from fleetlens.functions.dates import iso_day, utc_day
    ev = AD.table(spark, d, "events").select("event_id", "ts")
    return ev.select("event_id", utc_day("ts").alias("day"), iso_day("ts").alias("day_text"))


def q_dataset_manifest(spark, d):
    pages = AD.table(spark, d, "pages")
    name = F.concat(F.lit("data_Q"), F.col("page_id") % 4 + 1, F.lit("_"), 2010 + F.col("page_id") % 9, F.lit(".zip"))
    html = F.concat(F.lit('<a href="../drive-stats/./'), name, F.lit('">'), F.col("html"))
    return LK.dataset_manifest(pages.select("page_id", "url", html.alias("html")), year_from=2013)


def _detail(spark, d):
    tel = AD.telemetry_events(spark, d)
    scored = AD.predictions(tel).withColumn("reason_codes", F.array(
        F.struct(F.lit("age_days").alias("code"), F.col("risk_score").alias("contribution"), F.lit("UP").alias("direction")),
        F.struct(F.lit("smart_5_raw").alias("code"), (-F.col("risk_score")).alias("contribution"), F.lit("DOWN").alias("direction"))))
    drives = AD.drives(tel)
    first = scored.agg(F.min("drive_id")).first()[0]
    return FL.drive_detail(drives, AD.telemetry_daily(tel), scored, first)


def q_drive_attributes(spark, d):
    return _detail(spark, d).drive


def q_drive_reasons(spark, d):
    return round6(_detail(spark, d).top_reasons)


def q_drive_trend(spark, d):
    """One drive's telemetry and predictions, read by its id from tables laid out for that."""
    tel = AD.telemetry_events(spark, d)
    root = scratch_path(spark, "point-reads")
    WH.load_telemetry(AD.telemetry_daily(tel), f"{root}/telemetry")
    WH.write_by_drive(AD.drives(tel), f"{root}/drives")
    WH.write_by_drive(AD.predictions(tel), f"{root}/predictions")
    drives, predictions = spark.read.parquet(f"{root}/drives"), spark.read.parquet(f"{root}/predictions")
    history = spark.read.parquet(f"{root}/telemetry").withColumn("day", F.col("day").cast("date"))
    one = drives.agg(F.max("drive_id")).first()[0]
    found = FL.drive_detail(drives, history, predictions, one)
    trend = found.telemetry_trend.select("drive_id", "day", "smart_5_raw", F.lit(None).cast("string").alias("model_version"))
    risk = found.risk_history.select("drive_id", "day", F.col("risk_score").alias("smart_5_raw"), "model_version")
    return round6(trend.unionByName(risk))


def q_load_model(spark, d):
    from fleetlens.plans.catalog_model import _ffd
    path = scratch_path(spark, "model")
    JB.save_model(spark, MO.fixed_model(model_feature_names()), path)
    model = JB.load_model(spark, path)
    s = MO.score_batch(_ffd(spark, d), model, ["drive_id", "day"])
    return round6(s.select("drive_id", "day", "risk_score", "risk_bucket", "model_version"))


def q_publish_run(spark, d):
    """A run published, repeated, failed half-way and published again; what a reader sees of each table then."""
    tel = AD.telemetry_events(spark, d)
    log = SnapshotLog(spark, scratch_path(spark, "snapshots"))
    run = JB.run_scoring(AD.telemetry_daily(tel), AD.drives(tel), None, MO.fixed_model(model_feature_names()), mode="compat")
    JB.publish_scoring_run(run, log, "monday")
    JB.publish_scoring_run(run, log, "monday")

    def dies(work):
        work.upsert("predictions", run.predictions.withColumn("risk_score", F.lit(2.0)), PREDICTIONS_KEY, "day")
        raise InterruptedError

    try:
        log.publish("lost", dies)
    except InterruptedError:
        pass
    version = JB.publish_scoring_run(run, log, "tuesday")["version"]
    tables = [log.read(t).agg(F.lit(t).alias("table_name"), F.count(F.lit(1)).alias("rows"), F.lit(version).alias("version"),
                              F.count_distinct(*k).alias("keys"), (F.sum("risk_score") if t.endswith("predictions") else F.lit(None))
                              .cast("double").alias("score"))
              for t, k in (("predictions", PREDICTIONS_KEY), ("latest_predictions", ["drive_id"]), ("features", FEATURES_KEY), ("audit", ["created_at"]))]
    return round6(tables[0].unionByName(tables[1]).unionByName(tables[2]).unionByName(tables[3]))


def q_publish_features(spark, d):
    """The feature table published whole, then its last months again from half of the rows and once more from all."""
    log = SnapshotLog(spark, scratch_path(spark, "snapshots"))
    f = FE.build_features(AD.telemetry_ship(spark, d), METRICS, 30, source=AD.source_rows(AD.telemetry_ship, spark, d))
    version = JB.publish_features(f, log, "all")
    # the months come from the version that holds them all: the plan of ``f`` would build the whole table for each
    last = log.read("features_offline", version).where((F.col("as_of_date") >= F.lit("1998-01-01").cast("date")) & (F.col("year") >= 1998))
    JB.publish_features(last.where(F.col("age_days") % 2 == 0), log, "half", placed=True)
    JB.publish_features(last, log, "again", placed=True)
    return round6(log.read("features_offline"))


def q_latest_state(spark, d):
    """The kept latest predictions after batches that come late and twice."""
    pred = AD.predictions(AD.telemetry_events(spark, d))
    log = SnapshotLog(spark, scratch_path(spark, "snapshots"))
    day = F.dayofmonth("day")
    for i, batch in enumerate((day % 3 == 1, day % 3 == 0, day % 3 == 1, day % 3 == 2, day < 5)):
        log.publish(f"batch-{i}", lambda work, rows=pred.where(batch): work.fold_latest("latest", rows, "drive_id", FL.LATEST_ORDER))
    return round6(log.read("latest"))


def _pages(spark, d, risk):
    tel = AD.telemetry_events(spark, d)
    pred = AD.predictions(tel)
    index = FL.DrivePages.build(AD.drives(tel), scratch_path(spark, "drive-pages"), 16)
    total = sum(n for _, n in (index.counts if risk is None else index._counted(FL.drives_with_bucket(index.drives, pred, risk.upper()))))
    return round6(index.page(pred, risk, page=max(1, -(-total // 10)), page_size=10, latest=FL.latest_prediction(pred)))


def q_drive_page_deep(spark, d):
    """The last page, through the index of id ranges."""
    return _pages(spark, d, None)


def q_drive_page_deep_high(spark, d):
    return _pages(spark, d, "high")


def q_integer_forms(spark, d):
    """Numbers written in base 16 and 2, with digit groups, fractions and exponents, some of them broken."""
    ev = AD.table(spark, d, "events").select("event_id", "value")
    n = F.col("event_id")
    form = F.floor(n / 7) % 11
    text = (F.when(form == 0, F.concat(F.lit("0x"), F.hex(n))).when(form == 1, F.concat(F.lit(" 0X"), F.lower(F.hex(n)), F.lit(" ")))
            .when(form == 2, F.concat(F.lit("0b"), F.bin(n))).when(form == 3, F.concat(n.cast("string"), F.lit("_000")))
            .when(form == 4, F.concat(F.lit("-1_"), n.cast("string"), F.lit(".5"))).when(form == 5, F.concat(n.cast("string"), F.lit("_")))
            .when(form == 6, F.concat(F.lit("-0x"), F.hex(n))).when(form == 7, F.concat(n.cast("string"), F.lit("e1_0")))
            .when(form == 8, F.concat(F.lit("0xFFFFFFFF"), F.lpad(F.hex(n), 8, "0"))).when(form == 9, F.concat(F.lit("0x7F_"), F.hex(n)))
            .otherwise(F.concat(F.lit("."), n.cast("string"), F.lit("_5"))))
    return ev.select("event_id", CS.safe_int(text, "int").alias("as_int"), CS.safe_int(text).alias("as_bigint"),
                     F.round(CS.safe_double(text), 6).alias("as_double"))


def q_numeric_features(spark, d):
    """The features that training takes, in order."""
    names = MO.numeric_features(FE.build_features(AD.telemetry_events(spark, d), METRICS, 7))
    return spark.createDataFrame([(i, n) for i, n in enumerate(names, 1)], "position int, feature string")


def q_run_pipeline(spark, d):
    """Manifest to registry over zipped telemetry: what was written, and the lineage of the registered model."""
    tel = AD.telemetry_events(spark, d)
    text = tel.select(*[F.col(c).cast("string").alias(a) for c, a in (
        ("as_of_date", "date"), ("serial_number", "serial_number"), ("model", "model"), ("failure", "failure"),
        ("smart_5_raw", "smart_5"), ("temperature", "temperature_raw"))])
    root = scratch_path(spark, "run")
    # an archive per core, as archives are written and read by a task each
    ZC.write_zip_csv(text.repartition(max(4, spark.sparkContext.defaultParallelism)), f"{root}/zip").collect()
    out = JB.run_pipeline(spark, f"{root}/zip", horizon_days=7, root=f"{root}/out", manifest=q_dataset_manifest(spark, d))
    row = RG.active_model(spark.read.parquet(out["registry"]))
    return row.select(F.lit(out["warehouse_rows"]).cast("bigint").alias("warehouse_rows"),
                      F.lit(spark.read.parquet(out["features"]).count()).cast("bigint").alias("feature_rows"), "horizon_days", "status",
                      F.get_json_object("trained_data_window", "$.manifest_hash").alias("manifest_hash"))


def q_registry_row(spark, d):
    from fleetlens.plans.catalog_model import _eval_input
    e = _eval_input(spark, d)
    metrics = JB.evaluate(e, key=["k", "as_of_date"])
    run = JB.ModelRun(model=MO.fixed_model(model_feature_names()),
                      split=MO.Split(dt.date(2024, 1, 1), dt.date(2024, 1, 30), dt.date(2024, 1, 24), "fraction"),
                      metrics=metrics)
    row = JB.register(spark, run, "memory://fixed-v1", q_dataset_manifest(spark, d))
    return row.select("model_version", "horizon_days", "status",
                      F.get_json_object("metrics", "$.test_rows").cast("bigint").alias("test_rows"),
                      F.get_json_object("feature_schema", "$.label_column").alias("label_column"),
                      F.get_json_object("trained_data_window", "$.manifest_hash").alias("manifest_hash"))


def queries() -> dict:
    return {
        "telemetry_window": q_telemetry_window, "utc_day": q_utc_day, "dataset_manifest": q_dataset_manifest,
        "drive_attributes": q_drive_attributes, "drive_reasons": q_drive_reasons,
        "load_model": q_load_model, "registry_row": q_registry_row,
        "publish_run": q_publish_run, "publish_features": q_publish_features, "latest_state": q_latest_state,
        "drive_page_deep": q_drive_page_deep, "drive_page_deep_high": q_drive_page_deep_high,
        "integer_forms": q_integer_forms, "drive_trend": q_drive_trend, "numeric_features": q_numeric_features, "run_pipeline": q_run_pipeline,
        "merge_drives": q_merge_drives, "merge_features": q_merge_features,
        "merge_predictions": q_merge_predictions, "insert_if_absent": q_insert_if_absent,
        "audit_event": q_audit_event,
        "ingest_csv": q_ingest_csv, "ingest_csv_drift": q_ingest_csv_drift, "ingest_zip_csv": q_ingest_zip_csv,
        "skip_metadata_entries": q_skip_metadata_entries,
        "write_warehouse": q_write_warehouse, "scan_warehouse": q_scan_warehouse,
        "write_features": q_write_features, "load_telemetry": q_load_telemetry,
        "page_links": q_page_links, "dataset_links": q_dataset_links,
        "limit_rows": q_limit_rows, "sample_rows": q_sample_rows, "dataset_hash": q_dataset_hash,
        "backfill_cohort": q_backfill_cohort, "score_run": q_score_run, "score_run_consistent": q_score_run_consistent,
        "load_backfill": q_load_backfill,
        "train_logistic": q_train_logistic, "train_optimum": q_train_optimum, "active_model": q_active_model,
        "stream_landing": q_stream_landing,
    }
