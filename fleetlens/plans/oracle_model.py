"""Oracle SQL for online features, vectors, scoring, ranking, evaluation and contracts."""

from __future__ import annotations

from fleetlens.operators.evaluate import calibration_edges
from fleetlens.operators.model import fixed_model
from fleetlens.plans.oracle import build_features_sql, with_adapters as W
from fleetlens.schema import METRICS, ONLINE_MISSING_METRICS, STATS, model_feature_names

FEATURES = model_feature_names()


def dbl(v: float) -> str:
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def ffd_cte() -> str:
    """Online features of the latest day: CTE named ffd (needs telemetry_app, drives_app)."""
    items = []
    for m in METRICS:
        if m in ONLINE_MISSING_METRICS:
            items += [f"0e0 AS {m}_mean_7d", f"0e0 AS {m}_mean_30d", f"0e0 AS {m}_std_30d",
                      f"0e0 AS {m}_delta_vs_7d", f"0 AS {m}_is_increasing"]
            continue
        items += [f"coalesce(avg({m}) OVER w7, 0e0) AS {m}_mean_7d",
                  f"coalesce(avg({m}) OVER w30, 0e0) AS {m}_mean_30d",
                  f"CASE WHEN count({m}) OVER w30 >= 2 THEN stddev_pop({m}) OVER w30 ELSE 0e0 END AS {m}_std_30d",
                  f"coalesce({m}, 0e0) - coalesce(avg({m}) OVER w7, 0e0) AS {m}_delta_vs_7d",
                  f"CASE WHEN {m} IS NOT NULL AND lag({m}) OVER w IS NOT NULL AND {m} > lag({m}) OVER w "
                  f"THEN 1 ELSE 0 END AS {m}_is_increasing"]
    stats = [f"{m}_{s}" for m in METRICS for s in STATS]
    return f"""d0 AS (SELECT max(day) AS d FROM telemetry_app),
sl AS (SELECT t.* FROM telemetry_app t, d0 WHERE t.day BETWEEN d0.d - 30 AND d0.d),
rw AS (SELECT drive_id, day, min(day) OVER (PARTITION BY drive_id) AS first_day,
              max(day) OVER (PARTITION BY drive_id) AS last_day,
              {", ".join(items)}
       FROM sl
       WINDOW w AS (PARTITION BY drive_id ORDER BY day),
              w7 AS (PARTITION BY drive_id ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
              w30 AS (PARTITION BY drive_id ORDER BY day ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
ffd AS (SELECT rw.drive_id, d0.d AS day, CAST(coalesce(dr.capacity_bytes, 0) AS BIGINT) AS capacity_bytes,
               CAST(greatest(0, date_diff('day', rw.first_day, d0.d)) AS BIGINT) AS age_days,
               {", ".join(stats)}
        FROM rw JOIN d0 ON TRUE LEFT JOIN drives_app dr ON dr.drive_id = rw.drive_id
        WHERE rw.day = rw.last_day)"""


def FFD(*more: str) -> str:
    return W("telemetry_app", "drives_app", *more, extra=ffd_cte())


def r6_all(cols: list[str], table_types: dict[str, str] | None = None) -> str:
    out = []
    for c in cols:
        if c.endswith("_is_increasing") or c in ("capacity_bytes", "age_days"):
            out.append(c)
        else:
            out.append(f"round({c}, 6) AS {c}")
    return ", ".join(out)


def model_sql():
    m = fixed_model(FEATURES)
    z = dbl(m.intercept)
    for n in m.features:
        div = m.scales[n] if m.scales[n] > 0 else 1.0
        z = f"({z} + {dbl(m.weights[n])} * ((coalesce(CAST({n} AS DOUBLE), {dbl(m.fills[n])}) - {dbl(m.means[n])}) / {dbl(div)}))"
    reasons = " UNION ALL ".join(
        f"SELECT drive_id, day, {i} AS pos, '{n}' AS code, {dbl(m.weights[n])} * coalesce(CAST({n} AS DOUBLE), {dbl(m.fills[n])}) AS c FROM ffd"
        for i, n in enumerate(m.features))
    return m, z, reasons


EVAL = """ev AS (
  SELECT serial_number AS k, as_of_date,
         CAST(CASE WHEN fd > as_of_date AND fd <= as_of_date + INTERVAL '7 day' THEN 1 ELSE 0 END AS INTEGER) AS y,
         smart_5_raw / (smart_5_raw + 100) AS score
  FROM (SELECT *, min(CASE WHEN failure = 1 THEN as_of_date END) OVER (PARTITION BY serial_number) AS fd
        FROM telemetry_events))"""


def offline_cte(adapter: str, horizon: int) -> str:
    return f"WITH feats AS ({build_features_sql(adapter, horizon, round6=False)})\n"


def numeric_names() -> list[str]:
    return ["capacity_bytes", "age_days"] + [f"{m}_{s}" for s in STATS for m in METRICS]


def fin0(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan(CAST({c} AS DOUBLE)) OR isinf(CAST({c} AS DOUBLE)) THEN 0e0 ELSE CAST({c} AS DOUBLE) END"


def moments_cte(names: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{n}' AS feature, avg({fin0(n)}) AS mean, stddev_pop({fin0(n)}) AS std, count(*) AS n FROM feats"
        for n in names)
    return f"mom AS ({parts})"


def split_sql(adapter: str, horizon: int) -> str:
    return offline_cte(adapter, horizon) + """, b AS (SELECT min(as_of_date) AS mn, max(as_of_date) AS mx FROM feats),
c AS (SELECT CASE WHEN CAST(mx - INTERVAL 9 MONTH AS DATE) <= mn
                  THEN mn + CAST(floor(greatest(1, date_diff('day', mn, mx)) * 0.8e0) AS INTEGER)
                  ELSE CAST(mx - INTERVAL 9 MONTH AS DATE) END AS cutoff_date FROM b)
SELECT 'train' AS part, count(*) AS rows, CAST(sum(label_30d) AS BIGINT) AS positives, cutoff_date
FROM feats, c WHERE as_of_date <= cutoff_date AND label_30d IS NOT NULL GROUP BY cutoff_date
UNION ALL
SELECT 'test', count(*), CAST(sum(label_30d) AS BIGINT), cutoff_date
FROM feats, c WHERE as_of_date > cutoff_date AND label_30d IS NOT NULL GROUP BY cutoff_date"""


def oracle_sql() -> dict[str, str]:
    stats = [f"{m}_{s}" for m in METRICS for s in STATS]
    m, z, reasons = model_sql()
    edges = calibration_edges()
    bins = " ".join(
        f"WHEN score >= {dbl(edges[i])} AND score {'<=' if i == 9 else '<'} {dbl(edges[i + 1])} THEN {i}"
        for i in range(10))
    left = " ".join(f"WHEN {i} THEN {dbl(edges[i])}" for i in range(10))
    right = " ".join(f"WHEN {i} THEN {dbl(edges[i + 1])}" for i in range(10))
    q = {
        "features_for_day": FFD() + f"SELECT drive_id, day, capacity_bytes, age_days, {r6_all(stats)} FROM ffd",
        "features_for_day_consistent": build_features_sql("telemetry_events", 30)
        + "\nWHERE as_of_date = (SELECT max(as_of_date) FROM telemetry_events)",
        "features_daily_row": FFD() + """SELECT drive_id, day, FALSE AS label_fail_within_14d,
  CAST(age_days AS INTEGER) AS age_days, round(smart_5_raw_mean_7d, 6) AS smart5_mean_7d,
  round(smart_5_raw_delta_vs_7d, 6) AS smart5_slope_14d, round(smart_197_raw_mean_30d, 6) AS smart197_max_30d,
  round(smart_197_raw_mean_7d, 6) AS smart197_mean_7d, round(smart_198_raw_delta_vs_7d, 6) AS smart198_delta_7d,
  round(smart_199_raw_std_30d, 6) AS smart199_volatility_30d, round(temperature_mean_7d, 6) AS temperature_mean_7d,
  CAST(NULL AS DOUBLE) AS read_latency_mean_7d, CAST(NULL AS DOUBLE) AS write_latency_mean_7d,
  smart_197_raw_mean_30d = 0 AS missing_smart_197_30d FROM ffd""",
        "vector_json": FFD() + " UNION ALL ".join(
            f"SELECT drive_id, day, '{n}' AS name, round(CAST({n} AS DOUBLE), 6) AS value FROM ffd" for n in FEATURES),
        "vector_fallback": FFD() + """SELECT drive_id, day,
  round(CASE WHEN substr(drive_id, 7, 1) = '1' THEN CAST(age_days + 1000 AS DOUBLE) ELSE CAST(age_days AS DOUBLE) END, 6) AS age_days,
  round(smart_5_raw_mean_7d, 6) AS smart_5_raw_mean_7d, round(smart_197_raw_mean_7d, 6) AS smart_197_raw_mean_7d,
  round(temperature_mean_30d, 6) AS temperature_mean_30d FROM ffd""",
        "normalize_features": FFD() + "SELECT drive_id, day, " + ", ".join(
            "CAST(NULL AS DOUBLE) AS temperature_is_increasing" if n == "temperature_is_increasing"
            else f"round(CAST({n} AS DOUBLE), 6) AS {n}" for n in FEATURES) + " FROM ffd",
        "schema_mismatch": FFD() + """SELECT drive_id, day,
  CASE WHEN substr(drive_id, 7, 1) IN ('2', '6') THEN 'age_days' ELSE '' END AS missing,
  CASE WHEN substr(drive_id, 7, 1) IN ('4', '6') THEN 'extra_feature' ELSE '' END AS unexpected,
  'Feature schema mismatch. Missing keys: ' ||
  CASE WHEN substr(drive_id, 7, 1) IN ('2', '6') THEN '[''age_days'']' ELSE 'none' END ||
  '. Unexpected keys: ' ||
  CASE WHEN substr(drive_id, 7, 1) IN ('4', '6') THEN '[''extra_feature'']' ELSE 'none' END || '.' AS message
FROM ffd WHERE substr(drive_id, 7, 1) IN ('2', '4', '6')""",
        "feature_moments": offline_cte("telemetry_events", 7) + ", " + moments_cte(numeric_names())
        + """ SELECT feature, round(mean / CASE feature WHEN 'capacity_bytes' THEN 1e12 ELSE 1e0 END, 6) AS mean,
  round(std / CASE feature WHEN 'capacity_bytes' THEN 1e12 ELSE 1e0 END, 6) AS std, n FROM mom""",
        "scale_features": offline_cte("telemetry_events", 7) + ", " + moments_cte(numeric_names())
        + " SELECT serial_number, as_of_date, " + ", ".join(
            f"round(({fin0(n)} - (SELECT mean FROM mom WHERE feature = '{n}')) / "
            f"(SELECT CASE WHEN std > 0 THEN std ELSE 1e0 END FROM mom WHERE feature = '{n}'), 6) AS {n}"
            for n in numeric_names()) + " FROM feats",
        "impute_mean": offline_cte("telemetry_events", 7) + ", " + moments_cte(numeric_names())
        + " SELECT serial_number, as_of_date, " + ", ".join(
            f"round(coalesce({m_}_mean_7d, (SELECT mean FROM mom WHERE feature = '{m_}_mean_7d')), 6) AS {m_}_mean_7d"
            for m_ in METRICS) + " FROM feats",
        "class_weights": offline_cte("telemetry_ship", 30) + """, c AS (SELECT count(*) AS n,
  CAST(sum(CASE WHEN label_30d = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n0,
  CAST(sum(CASE WHEN label_30d = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n1 FROM feats)
SELECT n, n0, n1, round(CASE WHEN n0 > 0 THEN n / (2e0 * n0) ELSE 1e0 END, 6) AS w0,
  round(CASE WHEN n1 > 0 THEN n / (2e0 * n1) ELSE 1e0 END, 6) AS w1 FROM c""",
        "time_split": split_sql("telemetry_events", 7),
        "train_optimum": f"""SELECT rows AS train_rows, positives, true AS at_optimum FROM ({split_sql("telemetry_events", 7)})
WHERE part = 'train'""",
        "time_split_ship": split_sql("telemetry_ship", 30),
        "score_linear": FFD() + f"SELECT drive_id, day, round({z}, 6) AS z, round(1e0 / (1e0 + exp(-({z}))), 6) AS risk_score FROM ffd",
        "score_batch": FFD() + f""", s AS (SELECT drive_id, day, 1e0 / (1e0 + exp(-({z}))) AS p FROM ffd)
SELECT drive_id, day, round(p, 6) AS risk_score,
  CASE WHEN p >= 0.75e0 THEN 'HIGH' WHEN p >= 0.4e0 THEN 'MED' ELSE 'LOW' END AS risk_bucket,
  '{m.version}' AS model_version FROM s""",
        "top_reasons": FFD() + f""", r AS ({reasons}),
x AS (SELECT *, CAST(format('{{:.6f}}', c) AS DOUBLE) AS cr FROM r),  -- formatting rounds the exact double
rr AS (SELECT *, row_number() OVER (PARTITION BY drive_id, day ORDER BY abs(cr) DESC, pos ASC) AS rank FROM x)
SELECT drive_id, day, CAST(rank AS INTEGER) AS rank, code, round(cr, 6) AS contribution,
  CASE WHEN c >= 0 THEN 'UP' ELSE 'DOWN' END AS direction FROM rr WHERE rank <= 5""",
        "risk_bucket": W("telemetry_events") + """SELECT serial_number, as_of_date,
  round(smart_187_raw / 4e0, 6) AS score_a,
  CASE WHEN smart_187_raw / 4e0 >= 0.75e0 THEN 'HIGH' WHEN smart_187_raw / 4e0 >= 0.4e0 THEN 'MED' ELSE 'LOW' END AS bucket_a,
  round(smart_188_raw / 5e0, 6) AS score_b,
  CASE WHEN smart_188_raw / 5e0 >= 0.75e0 THEN 'HIGH' WHEN smart_188_raw / 5e0 >= 0.4e0 THEN 'MED' ELSE 'LOW' END AS bucket_b
FROM telemetry_events""",
        "risk_rank": W("predictions_app") + """SELECT drive_id, day, round(risk_score, 6) AS risk_score,
  row_number() OVER (PARTITION BY day ORDER BY risk_score DESC, drive_id ASC) AS risk_rank
FROM predictions_app WHERE model_version = 'v2'""",
        "rank_fallback": W("predictions_low") + """, batches AS (
  SELECT drive_id, CASE WHEN substr(drive_id, 7, 1) <> '9' THEN day END AS day, model_version, risk_score,
         CASE WHEN day = DATE '2024-01-15' AND substr(drive_id, 7, 1) = '1' THEN 'MED' ELSE risk_bucket END AS risk_bucket
  FROM predictions_low),
st AS (SELECT day, count(*) AS n,
  max(CASE WHEN risk_bucket IN ('MED', 'HIGH') THEN 1 ELSE 0 END) AS mh FROM batches GROUP BY day),
r AS (SELECT p.*, st.n, st.mh,
             row_number() OVER (PARTITION BY p.day ORDER BY p.risk_score DESC, p.drive_id ASC) - 1 AS idx
      FROM batches p JOIN st ON st.day IS NOT DISTINCT FROM p.day),
c AS (SELECT *, CAST(CASE WHEN n >= 20 THEN ceil(n * 0.05e0) ELSE least(1, n) END AS BIGINT) AS hc FROM r),
c2 AS (SELECT *, CAST(CASE WHEN n >= 10 THEN ceil(n * 0.15e0) ELSE least(1, greatest(0, n - hc)) END AS BIGINT) AS mc FROM c),
b AS (SELECT *, CASE WHEN idx < hc THEN 'HIGH' WHEN idx < hc + mc THEN 'MED' ELSE 'LOW' END AS nb,
             CASE WHEN idx < hc THEN idx WHEN idx < hc + mc THEN idx - hc ELSE idx - hc - mc END AS pos,
             greatest(1, CASE WHEN idx < hc THEN hc WHEN idx < hc + mc THEN mc ELSE greatest(1, n - hc - mc) END) AS sz
      FROM c2),
t AS (SELECT *, CASE WHEN sz = 1 THEN 0.5e0 ELSE CAST(pos AS DOUBLE) / CAST(sz - 1 AS DOUBLE) END AS tt,
             CASE nb WHEN 'HIGH' THEN 0.95e0 WHEN 'MED' THEN 0.74e0 ELSE 0.39e0 END AS hi,
             CASE nb WHEN 'HIGH' THEN 0.75e0 WHEN 'MED' THEN 0.4e0 ELSE 0.02e0 END AS lo FROM b)
SELECT drive_id, day, model_version,
  round(CASE WHEN mh = 1 THEN risk_score ELSE round(hi - (hi - lo) * tt, 6) END, 6) AS risk_score,
  CASE WHEN mh = 1 THEN risk_bucket ELSE nb END AS risk_bucket,
  round(risk_score, 6) AS model_score,
  CASE WHEN mh = 1 THEN 'model' ELSE 'rank_fallback' END AS bucket_mode
FROM t""",
        "average_precision": W("telemetry_events", extra=EVAL) + """, g AS (SELECT score, sum(y) AS tp, count(*) AS cnt FROM ev GROUP BY score),
c AS (SELECT tp, sum(tp) OVER (ORDER BY score DESC) AS cum_tp, sum(cnt) OVER (ORDER BY score DESC) AS cum_cnt FROM g)
SELECT round(CASE WHEN coalesce(sum(tp), 0) = 0 THEN 0e0 ELSE sum(tp * cum_tp / cum_cnt) / sum(tp) END, 6) AS average_precision FROM c""",
        "brier_score": W("telemetry_events", extra=EVAL) + "SELECT round(avg(pow(score - y, 2)), 6) AS brier_score FROM ev",
        "recall_at_top": W("telemetry_events", extra=EVAL) + """, r AS (SELECT y, row_number() OVER (ORDER BY score DESC, k ASC, as_of_date ASC) AS rn FROM ev),
kk AS (SELECT CAST(greatest(1, floor(count(*) * 0.01e0)) AS BIGINT) AS k1, CAST(greatest(1, floor(count(*) * 0.05e0)) AS BIGINT) AS k5 FROM ev)
SELECT round(CASE WHEN sum(y) = 0 THEN 0e0 ELSE sum(CASE WHEN rn <= k1 THEN y ELSE 0 END) / sum(y) END, 6) AS recall_at_top_1pct,
  k1 AS k_1pct,
  round(CASE WHEN sum(y) = 0 THEN 0e0 ELSE sum(CASE WHEN rn <= k5 THEN y ELSE 0 END) / sum(y) END, 6) AS recall_at_top_5pct,
  k5 AS k_5pct
FROM r, kk GROUP BY k1, k5""",
        "recall_ties": W("telemetry_events", extra=EVAL) + """, r AS (SELECT y, row_number() OVER (ORDER BY floor(score * 10) DESC, k ASC, as_of_date ASC) AS rn FROM ev),
kk AS (SELECT CAST(greatest(1, floor(count(*) * 0.03e0)) AS BIGINT) AS k FROM ev)
SELECT round(CASE WHEN sum(y) = 0 THEN 0e0 ELSE sum(CASE WHEN rn <= k THEN y ELSE 0 END) / sum(y) END, 6) AS recall, k FROM r, kk GROUP BY k""",
        "calibration_bins": W("telemetry_events", extra=EVAL) + f""", b AS (SELECT CASE {bins} END AS bin, score, y FROM ev)
SELECT bin, round(CASE bin {left} END, 6) AS bin_left, round(CASE bin {right} END, 6) AS bin_right,
  round(avg(score), 6) AS predicted_mean, round(avg(y), 6) AS observed_rate, count(*) AS count
FROM b WHERE bin IS NOT NULL GROUP BY bin""",
        "eval_summary": W("telemetry_events", extra=EVAL) + "SELECT count(*) AS test_rows, round(coalesce(avg(y), 0), 6) AS positive_rate_test FROM ev",
        "validate_features": FFD() + """SELECT count(*) AS rows,
  count(*) FILTER (WHERE substr(drive_id, 7, 1) = '8') AS bad_drive_id,
  count(*) FILTER (WHERE day IS NULL) AS bad_day,
  count(*) FILTER (WHERE substr(drive_id, 7, 1) = '3') AS bad_features FROM ffd""",
        "validate_predictions": W("predictions_app") + """, p AS (SELECT drive_id,
  CASE WHEN substr(drive_id, 7, 1) = '9' THEN risk_score + 1 ELSE risk_score END AS s,
  CASE WHEN substr(drive_id, 7, 1) = '4' THEN lower(risk_bucket) ELSE risk_bucket END AS b,
  CASE WHEN substr(drive_id, 7, 1) = '6' THEN '' ELSE model_version END AS v,
  CASE WHEN substr(drive_id, 7, 1) = '8' THEN NULL ELSE scored_at END AS t FROM predictions_app)
SELECT count(*) AS rows,
  count(*) FILTER (WHERE s IS NULL OR isnan(s) OR s < 0 OR s > 1) AS bad_score,
  count(*) FILTER (WHERE b IS NULL OR b NOT IN ('LOW', 'MED', 'HIGH')) AS bad_bucket,
  count(*) FILTER (WHERE NULLIF(TRIM(v), '') IS NULL) AS bad_version,
  count(*) FILTER (WHERE t IS NULL) AS bad_scored_at,
  count(*) FILTER (WHERE substr(drive_id, 7, 1) = '3') AS bad_direction FROM p""",
        "validate_drives": W("drives_app") + """, d AS (SELECT drive_id,
  CASE WHEN substr(drive_id, 7, 1) = '2' THEN NULL ELSE model END AS model,
  CASE WHEN substr(drive_id, 7, 1) = '5' THEN -capacity_bytes ELSE capacity_bytes END AS cap FROM drives_app)
SELECT count(*) AS rows, count(*) FILTER (WHERE NULLIF(TRIM(drive_id), '') IS NULL) AS bad_drive_id,
  count(*) FILTER (WHERE NULLIF(TRIM(model), '') IS NULL) AS bad_model,
  count(*) FILTER (WHERE cap IS NOT NULL AND cap < 0) AS bad_capacity FROM d""",
        "duplicate_keys": W("telemetry_app") + """SELECT drive_id, day, count(*) AS n FROM (
  SELECT drive_id, day FROM telemetry_app UNION ALL
  SELECT drive_id, day FROM telemetry_app WHERE substr(drive_id, 7, 1) = '3')
GROUP BY drive_id, day HAVING count(*) > 1""",
        "orphan_rows": W("predictions_app", "drives_app") + """SELECT drive_id, day, model_version FROM predictions_app
WHERE drive_id NOT IN (SELECT drive_id FROM drives_app WHERE substr(drive_id, 7, 1) <> '4')""",
        "cascade_delete": W("predictions_app", "drives_app") + """SELECT drive_id, day, model_version FROM predictions_app
WHERE drive_id NOT IN (SELECT drive_id FROM drives_app WHERE substr(drive_id, 7, 1) = '1')""",
    }
    from fleetlens.plans import oracle_io
    q.update(oracle_io.oracle_sql())
    return q
