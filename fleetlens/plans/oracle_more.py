"""Oracle SQL for the cleaning, cohort and fleet queries."""

from __future__ import annotations

from fleetlens.plans.oracle import with_adapters as W

NULL_METRICS = ", ".join(f"CAST(NULL AS DOUBLE) AS {m}" for m in (
    "smart_187_raw", "smart_188_raw", "smart_197_raw", "smart_198_raw", "smart_199_raw",
    "smart_241_raw", "smart_242_raw", "temperature"))

CANON = f"""SELECT TRY_CAST(NULLIF(TRIM("Day"), '') AS DATE) AS date,
       NULLIF(TRIM(serial), '') AS serial_number,
       NULLIF(TRIM(model_name), '') AS model,
       TRY_CAST(NULLIF(TRIM(failure), '') AS INTEGER) AS failure,
       CAST(NULL AS BIGINT) AS capacity_bytes,
       TRY_CAST(NULLIF(TRIM(smart_5), '') AS DOUBLE) AS smart_5_raw,
       {NULL_METRICS}
FROM raw_text"""

NONFINITE = """(SELECT event_id, CASE event_id % 7 WHEN 0 THEN CAST('nan' AS DOUBLE) WHEN 1 THEN CAST('inf' AS DOUBLE)
  WHEN 2 THEN CAST('-inf' AS DOUBLE) WHEN 3 THEN CAST(NULL AS DOUBLE) ELSE value END AS x FROM events)"""

BOUNDS = "bounds AS (SELECT max(as_of_date) AS latest FROM telemetry_events)"
# a drive's distinct days of the last 45, as a list; the cohort has 25 of them and the last one
CANDIDATES = """days AS (
  SELECT serial_number, list(DISTINCT as_of_date) AS seen FROM telemetry_events
  WHERE as_of_date >= (FROM bounds) - 45 AND serial_number IS NOT NULL GROUP BY ALL),
candidates AS (
  SELECT serial_number, len(seen) AS history_days, 1 AS seen_on_latest_day
  FROM days WHERE len(seen) >= 25 AND list_contains(seen, (FROM bounds)))"""
SELECTED = """newest AS (
  SELECT serial_number, nullif(trim(model), '') AS named, capacity_bytes AS bytes
  FROM telemetry_events SEMI JOIN candidates USING (serial_number) WHERE as_of_date = (FROM bounds)),
placed AS (
  SELECT serial_number, min(named) AS named, max(bytes) AS bytes, row_number() OVER (ORDER BY serial_number) AS place
  FROM newest GROUP BY serial_number),
selected AS (
  SELECT serial_number, ifnull(named, 'UNKNOWN') AS model, CAST(bytes AS BIGINT) AS capacity_bytes
  FROM placed WHERE place <= 100)"""
COHORT = ",\n".join([BOUNDS, CANDIDATES, SELECTED])

COUNTERS = ", ".join(f"CAST(round_even({m}_raw, 0) AS BIGINT) AS {m}" for m in (
    "smart_5", "smart_187", "smart_188", "smart_197", "smart_198", "smart_199"))
COHORT_TELEMETRY = f"""
SELECT serial_number AS drive_id, as_of_date AS day, {COUNTERS}, temperature,
  CAST(NULL AS DOUBLE) AS io_read_latency_ms, CAST(NULL AS DOUBLE) AS io_write_latency_ms,
  failure IS NOT DISTINCT FROM 1 AS is_failed_today, picked.model, ifnull(picked.capacity_bytes, e.capacity_bytes) AS capacity_bytes
FROM telemetry_events e JOIN selected picked USING (serial_number)
WHERE (FROM bounds) - as_of_date BETWEEN 0 AND 45"""

LATEST = """latest_pred AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY drive_id
                         ORDER BY day DESC, scored_at DESC, model_version DESC) AS rn
                 FROM predictions_app) WHERE rn = 1)"""


def oracle_sql() -> dict[str, str]:
    from fleetlens.plans import oracle_model
    q = {
        "canonicalize": W("raw_text") + CANON,
        "clean_text": W("raw_text") + """SELECT NULLIF(TRIM(serial), '') AS serial_number,
  NULLIF(TRIM(model_name), '') AS model, NULLIF(TRIM("Day"), '') AS day_text FROM raw_text""",
        "safe_cast": W("raw_text") + """SELECT TRY_CAST(NULLIF(TRIM("Day"), '') AS DATE) AS date,
  TRY_CAST(NULLIF(TRIM(failure), '') AS INTEGER) AS failure,
  TRY_CAST(NULLIF(TRIM(smart_5), '') AS BIGINT) AS smart_5_int,
  TRY_CAST(NULLIF(TRIM(smart_5), '') AS DOUBLE) AS smart_5_raw FROM raw_text""",
        "drop_null_keys": W("raw_text") + f"SELECT * FROM ({CANON}) WHERE date IS NOT NULL AND serial_number IS NOT NULL",
        "partition_keys": W("raw_text") + f"""SELECT date, serial_number, CAST(extract(year FROM date) AS INTEGER) AS year,
  lpad(CAST(extract(month FROM date) AS VARCHAR), 2, '0') AS month
FROM ({CANON}) WHERE date IS NOT NULL AND serial_number IS NOT NULL""",
        "failure_flag": W("raw_text") + """SELECT NULLIF(TRIM(serial), '') AS serial_number,
  CASE WHEN TRY_CAST(NULLIF(TRIM(failure), '') AS INTEGER) = 1 THEN TRUE ELSE FALSE END AS is_failed_today FROM raw_text""",
        "default_fill": W("raw_text") + """SELECT NULLIF(TRIM(serial), '') AS serial_number,
  COALESCE(NULLIF(TRIM(model_name), ''), 'UNKNOWN') AS model FROM raw_text""",
        "narrow_types": W("telemetry_events") + """SELECT serial_number, as_of_date,
  TRY_CAST(smart_5_raw AS BIGINT) AS smart_5, TRY_CAST(smart_197_raw AS BIGINT) AS smart_197,
  TRY_CAST(smart_198_raw AS BIGINT) AS smart_198, TRY_CAST(smart_199_raw AS BIGINT) AS smart_199
FROM telemetry_events""",
        "finite_or_zero": f"""SELECT event_id, CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN 0e0 ELSE x END AS x
FROM {NONFINITE}""",
        "finite_or_null": f"""SELECT event_id, CASE WHEN x IS NULL OR isnan(x) OR isinf(x) THEN NULL ELSE x END AS x
FROM {NONFINITE}""",
        "union_by_name": W("telemetry_events", "telemetry_ship") + """
SELECT serial_number, as_of_date, round(smart_5_raw, 6) AS smart_5_raw, CAST(NULL AS DOUBLE) AS temperature FROM telemetry_events
UNION ALL
SELECT serial_number, as_of_date, NULL, round(temperature, 6) FROM telemetry_ship""",
        "date_range": W("telemetry_ship") + """SELECT serial_number, as_of_date, round(smart_5_raw, 6) AS smart_5_raw
FROM telemetry_ship WHERE as_of_date BETWEEN DATE '1998-01-15' AND DATE '1998-03-31'""",
        "date_bounds": W("telemetry_ship") + "SELECT min(as_of_date) AS min_date, max(as_of_date) AS max_date FROM telemetry_ship",
        "cohort_candidates": W("telemetry_events", extra=",\n".join([BOUNDS, CANDIDATES])) + "SELECT * FROM candidates",
        "select_cohort": W("telemetry_events", extra=COHORT) + "SELECT * FROM selected",
        "cohort_telemetry": W("telemetry_events", extra=COHORT) + COHORT_TELEMETRY,
        "drive_summary": W("telemetry_events", extra=COHORT) + """
SELECT serial_number AS drive_id, any_value(picked.model) AS model, any_value(picked.capacity_bytes) AS capacity_bytes,
  'backblaze' AS datacenter, list_min(list(as_of_date)) AS first_seen, list_max(list(as_of_date)) AS last_seen
FROM selected picked JOIN telemetry_events USING (serial_number)
WHERE as_of_date >= (FROM bounds) - 45 GROUP BY serial_number""",
        "fleet_summary": W("drives_app", "predictions_app") + """
, d AS (SELECT max(day) AS day FROM predictions_app)
SELECT (SELECT day FROM d) AS day, (SELECT count(*) FROM drives_app) AS total_drives,
  count(*) AS drives_scored,
  CAST(sum(CASE WHEN risk_bucket = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS predicted_failures,
  CAST(sum(CASE WHEN risk_bucket = 'LOW' THEN 1 ELSE 0 END) AS BIGINT) AS low,
  CAST(sum(CASE WHEN risk_bucket = 'MED' THEN 1 ELSE 0 END) AS BIGINT) AS med,
  CAST(sum(CASE WHEN risk_bucket = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high,
  round(CASE WHEN count(*) = 0 THEN 0e0 ELSE
        CAST(sum(CASE WHEN risk_bucket = 'HIGH' THEN 1 ELSE 0 END) AS DOUBLE) / CAST(count(*) AS DOUBLE) * 100e0 END, 1)
    AS high_risk_rate
FROM predictions_app WHERE day = (SELECT day FROM d)""",
        "bucket_distribution": W("predictions_app") + """SELECT day,
  CAST(sum(CASE WHEN risk_bucket = 'LOW' THEN 1 ELSE 0 END) AS BIGINT) AS low,
  CAST(sum(CASE WHEN risk_bucket = 'MED' THEN 1 ELSE 0 END) AS BIGINT) AS med,
  CAST(sum(CASE WHEN risk_bucket = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high
FROM predictions_app GROUP BY day""",
        "latest_prediction": W("predictions_app", extra=LATEST) + """SELECT drive_id, day, model_version,
  round(risk_score, 6) AS risk_score, risk_bucket, scored_at FROM latest_pred""",
        "drives_with_bucket": W("drives_app", "predictions_app") + """SELECT * FROM drives_app
WHERE drive_id IN (SELECT drive_id FROM predictions_app WHERE risk_bucket = 'HIGH')""",
        "drive_page": W("drives_app", "predictions_app", extra=LATEST) + """
, pg AS (SELECT * FROM drives_app ORDER BY drive_id LIMIT 25 OFFSET 25)
SELECT pg.drive_id, pg.model, pg.datacenter, CAST(coalesce(pg.capacity_bytes, 0) AS BIGINT) AS capacity_bytes,
  pg.first_seen, pg.last_seen, lp.day AS latest_day, round(lp.risk_score, 6) AS latest_risk_score,
  lp.risk_bucket AS latest_risk_bucket, lp.model_version AS latest_model_version,
  2 AS page, 25 AS page_size, (SELECT count(*) FROM drives_app) AS total
FROM pg LEFT JOIN latest_pred lp ON lp.drive_id = pg.drive_id""",
        "drive_page_deep": W("drives_app", "predictions_app", extra=LATEST) + """
, f AS (SELECT *, row_number() OVER (ORDER BY drive_id) AS rn FROM drives_app),
pg AS (SELECT * FROM f WHERE (rn - 1) // 10 = (SELECT greatest(count(*) - 1, 0) // 10 FROM f))
SELECT pg.drive_id, pg.model, pg.datacenter, CAST(coalesce(pg.capacity_bytes, 0) AS BIGINT) AS capacity_bytes,
  pg.first_seen, pg.last_seen, lp.day AS latest_day, round(lp.risk_score, 6) AS latest_risk_score,
  lp.risk_bucket AS latest_risk_bucket, lp.model_version AS latest_model_version,
  CAST((SELECT greatest(1, (count(*) + 9) // 10) FROM f) AS INTEGER) AS page, 10 AS page_size, (SELECT count(*) FROM f) AS total
FROM pg LEFT JOIN latest_pred lp ON lp.drive_id = pg.drive_id""",
        "drive_page_deep_high": W("drives_app", "predictions_app", extra=LATEST) + """
, f AS (SELECT *, row_number() OVER (ORDER BY drive_id) AS rn FROM drives_app WHERE drive_id IN (SELECT drive_id FROM predictions_app WHERE risk_bucket = 'HIGH')),
pg AS (SELECT * FROM f WHERE (rn - 1) // 10 = (SELECT greatest(count(*) - 1, 0) // 10 FROM f))
SELECT pg.drive_id, pg.model, pg.datacenter, CAST(coalesce(pg.capacity_bytes, 0) AS BIGINT) AS capacity_bytes,
  pg.first_seen, pg.last_seen, lp.day AS latest_day, round(lp.risk_score, 6) AS latest_risk_score,
  lp.risk_bucket AS latest_risk_bucket, lp.model_version AS latest_model_version,
  CAST((SELECT greatest(1, (count(*) + 9) // 10) FROM f) AS INTEGER) AS page, 10 AS page_size, (SELECT count(*) FROM f) AS total
FROM pg LEFT JOIN latest_pred lp ON lp.drive_id = pg.drive_id""",
        "latest_state": W("predictions_app", extra=LATEST) + """SELECT drive_id, day, model_version,
  round(risk_score, 6) AS risk_score, risk_bucket, scored_at FROM latest_pred""",
        "drive_page_high": W("drives_app", "predictions_app", extra=LATEST) + """
, f AS (SELECT * FROM drives_app WHERE drive_id IN (SELECT drive_id FROM predictions_app WHERE risk_bucket = 'HIGH')),
pg AS (SELECT * FROM f ORDER BY drive_id LIMIT 25 OFFSET 0)
SELECT pg.drive_id, pg.model, pg.datacenter, CAST(coalesce(pg.capacity_bytes, 0) AS BIGINT) AS capacity_bytes,
  pg.first_seen, pg.last_seen, lp.day AS latest_day, round(lp.risk_score, 6) AS latest_risk_score,
  lp.risk_bucket AS latest_risk_bucket, lp.model_version AS latest_model_version,
  1 AS page, 25 AS page_size, (SELECT count(*) FROM f) AS total
FROM pg LEFT JOIN latest_pred lp ON lp.drive_id = pg.drive_id""",
        "drive_history": W("telemetry_ship") + """SELECT drive_id, day, round(smart5, 6) AS smart5,
  round(smart197, 6) AS smart197, round(smart198, 6) AS smart198, round(smart199, 6) AS smart199,
  round(temperature, 6) AS temperature
FROM (SELECT serial_number AS drive_id, as_of_date AS day, smart_5_raw AS smart5, smart_197_raw AS smart197,
             smart_198_raw AS smart198, smart_199_raw AS smart199, temperature,
             row_number() OVER (PARTITION BY serial_number ORDER BY as_of_date) AS rn
      FROM telemetry_ship) WHERE rn <= 60""",
        "prediction_history": W("predictions_app") + """SELECT drive_id, day, round(risk_score, 6) AS risk_score,
  risk_bucket, model_version
FROM (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY day DESC, scored_at DESC, model_version DESC) AS rn
      FROM predictions_app) WHERE rn <= 20""",
        "capacity_lookup": W("telemetry_app", "drives_app") + """SELECT t.drive_id,
  CAST(coalesce(d.capacity_bytes, 0) AS BIGINT) AS capacity_bytes
FROM (SELECT DISTINCT drive_id FROM telemetry_app) t
LEFT JOIN (SELECT * FROM drives_app WHERE substr(drive_id, 7, 1) <> '3') d ON d.drive_id = t.drive_id""",
        "high_risk_rate": W("predictions_app") + """SELECT day, strftime(day, '%m-%d') AS day_label, high, scored,
  round(CASE WHEN scored = 0 THEN 0e0 ELSE CAST(high AS DOUBLE) / CAST(scored AS DOUBLE) * 100e0 END, 1) AS high_risk_rate
FROM (SELECT day, CAST(sum(CASE WHEN risk_bucket = 'HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS high, count(*) AS scored
      FROM predictions_app GROUP BY day)""",
        "dashboard_formats": W("drives_app", "predictions_app", extra=LATEST) + """SELECT d.drive_id,
  round(CAST(coalesce(d.capacity_bytes, 0) AS DOUBLE) / 1e12, 6) AS capacity_tb,
  round(lp.risk_score * 100e0, 1) AS risk_pct, strftime(lp.day, '%m-%d') AS day_label
FROM drives_app d LEFT JOIN latest_pred lp ON lp.drive_id = d.drive_id""",
        "top_risk_drives": W("predictions_app", "telemetry_events") + """SELECT drive_id, day, model_version,
  round(risk_score, 6) AS risk_score FROM predictions_app
WHERE day = (SELECT max(as_of_date) FROM telemetry_events)
ORDER BY risk_score DESC, drive_id ASC LIMIT 10""",
    }
    q.update(oracle_model.oracle_sql())
    return q
