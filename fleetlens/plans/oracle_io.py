"""Oracle SQL for merges, audit, files, links and jobs (file round trips compare to the source rows)."""

from __future__ import annotations

from fleetlens.plans.oracle import build_features_sql, with_adapters as W
from fleetlens.plans.oracle_more import CANON, COHORT, COHORT_TELEMETRY
from fleetlens.operators.canonical import MERKLE_LEVELS
from fleetlens.plans.oracle_model import EVAL, FFD, model_sql
from fleetlens.schema import METRICS, STATS, model_feature_names

TEL_COLS = ["smart_5_raw", "smart_187_raw", "smart_188_raw", "smart_197_raw", "smart_198_raw", "smart_199_raw",
            "temperature"]
R6_TEL = ", ".join(f"round({c}, 6) AS {c}" for c in TEL_COLS)

LINK_RULE = r"""
  CASE WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.\-]*:') THEN h
       WHEN starts_with(h, '//') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1) || ':' || h
       WHEN starts_with(h, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)', 1) || h
       WHEN starts_with(h, '?') THEN regexp_replace(regexp_replace(url, '#.*$', ''), '\?.*$', '') || h
       WHEN starts_with(h, '#') THEN regexp_replace(url, '#.*$', '') || h
       WHEN h = '' THEN regexp_replace(url, '#.*$', '')
       ELSE regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''), '\?.*$', ''), '[^/]*$', '') || h END"""

# a page without comments, scripts and styles; its closed anchors; their references decoded, as far as the pages have some;
# one step up at most, as the registered queries have it
LINKS = r"""links AS (
  SELECT page_id, pos, href, CASE WHEN regexp_matches(l, '^[A-Za-z]+://[^/]+/\.\./') THEN replace(l, '/../', '/')
                                  ELSE regexp_replace(l, '/[^/]+/\.\./', '/') END AS link
  FROM (SELECT page_id, pos, h AS href, replace(""" + LINK_RULE + r""", '/./', '/') AS l
  FROM (SELECT page_id, url, trim(replace(replace(replace(regexp_replace(hr, '^"(.*)"$|^''(.*)''$', '\1\2', 's'),
                                  '&#x2F;', '/'), '&eacute;', 'é'), '&amp;', '&')) AS h,
               row_number() OVER (PARTITION BY page_id ORDER BY nth) - 1 AS pos
        FROM (SELECT page_id, url, nth, regexp_extract(tag, '(?is)[\s"'']href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1) AS hr
              FROM (SELECT page_id, url, unnest(tags) AS tag, unnest(range(len(tags))) AS nth
                    FROM (SELECT page_id, url, regexp_extract_all(regexp_replace(html,
                            '(?is)<!--.*?-->|<script[^>]*>.*?</script|<style[^>]*>.*?</style', '', 'g'), '(?is)<a\s[^<>]*>') AS tags
                          FROM pages))) WHERE hr <> '')))"""

# the pages of the link queries: a link in a script, a very long anchor, references, an anchor that is never closed
TRAPPED = r"""(SELECT page_id, url, html || '<script>var a = "<a href=''scripted.zip''>";</script><a title='
  || repeat('y', CASE WHEN page_id % 25 = 0 THEN 100000 ELSE 3 END) || ' href="a&#x2F;long.zip">l</a><A class="c"
 href=caf&eacute;.zip?x=1&amp;y=2&copy=3>e</A><a name ' || repeat('z', CASE WHEN page_id % 25 = 0 THEN 20000 ELSE 3 END) AS html
  FROM pages)"""


# Fixed values inside: the file-name patterns for year and period, as in sources/links.py.
def manifest_sql(pages: str, chosen: str, year_from: int) -> str:
    """The manifest of the chosen links of a pages table or subquery."""
    links = LINKS.replace("FROM pages", f"FROM {pages}")
    return "WITH " + links + r""", c AS (SELECT * FROM links WHERE """ + chosen + r"""),
f AS (SELECT link AS url, row_number() OVER (PARTITION BY link ORDER BY page_id, pos) AS rn FROM c),
n AS (SELECT url, regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?([^?#]*)', 1), '([^/]*)$', 1) AS file_name
      FROM f WHERE rn = 1),
y AS (SELECT url, file_name,
             regexp_extract(file_name, '(?i)(?:^|[_\-])Q([1-4])[_\-]?((?:19|20)\d{2})', 2) AS y1,
             regexp_extract(file_name, '(?i)(?:^|[_\-])Q([1-4])[_\-]?((?:19|20)\d{2})', 1) AS q1,
             regexp_extract(file_name, '(?i)((?:19|20)\d{2})[_\-]?Q([1-4])', 1) AS y2,
             regexp_extract(file_name, '(?i)((?:19|20)\d{2})[_\-]?Q([1-4])', 2) AS q2,
             regexp_extract(file_name, '((?:19|20)\d{2})', 1) AS y3 FROM n),
z AS (SELECT url, file_name,
             CAST(CASE WHEN y1 <> '' THEN y1 WHEN y2 <> '' THEN y2 WHEN y3 <> '' THEN y3 END AS INTEGER) AS year,
             CASE WHEN y1 <> '' THEN 'Q' || q1 WHEN y2 <> '' THEN 'Q' || q2 WHEN y3 <> '' THEN 'ANNUAL' ELSE 'UNKNOWN' END AS period
      FROM y)
SELECT CAST(year AS VARCHAR) || '_' || period || '_' || file_name AS dataset_id, year, period, file_name, url
FROM z WHERE year IS NOT NULL AND year >= """ + str(year_from)


def merkle(table: str, columns: list[str]) -> str:
    """CTEs of the Merkle tree over a table's rows; m0 holds the root."""
    fields = ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), 'n')" for c in columns)
    sql = f"m9 AS (SELECT sha256(concat_ws(',', {fields})) AS name, CAST(count(*) AS VARCHAR) AS held FROM {table} GROUP BY 1)"
    below = "m9"
    for digits in MERKLE_LEVELS:
        sql += (f", m{digits} AS (SELECT substr(name, 1, {digits}) AS name, sha256(string_agg(name || ':' || held, ',' "
                f"ORDER BY name || ':' || held)) AS held FROM {below} GROUP BY 1)")
        below = f"m{digits}"
    return sql


def oracle_sql() -> dict[str, str]:
    m, z, _reasons = model_sql()
    manifest = manifest_sql("""(SELECT page_id, url, concat('<a href="../drive-stats/./data_Q', page_id % 4 + 1, '_',
    2010 + page_id % 9, '.zip">', html) AS html FROM pages)""",
            "lower(link) LIKE '%/drive-stats/%' AND lower(link) LIKE '%.zip'", 2013)
    numeric = ["capacity_bytes", "age_days", *[f"{m}_{s}" for s in STATS for m in METRICS]]
    run_sql = f"""s AS (SELECT 1e0 / (1e0 + exp(-({z}))) AS p, day FROM ffd),
b AS (SELECT day, CASE WHEN p >= 0.75e0 THEN 'HIGH' WHEN p >= 0.4e0 THEN 'MED' ELSE 'LOW' END AS bk FROM s)
SELECT 'completed' AS status, max(day) AS day, count(*) AS stored_predictions, '{m.version}' AS model_version,
  CASE WHEN count(*) FILTER (WHERE bk IN ('MED', 'HIGH')) > 0 THEN 'model' ELSE 'rank_fallback' END AS bucket_mode,
  count(*) FILTER (WHERE bk = 'LOW') AS low, count(*) FILTER (WHERE bk = 'MED') AS med,
  count(*) FILTER (WHERE bk = 'HIGH') AS high FROM b"""
    canon_nonnull = f"SELECT * FROM ({CANON}) WHERE date IS NOT NULL AND serial_number IS NOT NULL"
    drift_null = ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in (
        "smart_187_raw", "smart_188_raw", "smart_197_raw", "smart_198_raw", "smart_199_raw", "smart_241_raw",
        "smart_242_raw"))
    return {
        "telemetry_window": W("telemetry_app") + """SELECT drive_id, day, round(smart_5_raw, 6) AS smart_5_raw,
  round(temperature, 6) AS temperature FROM telemetry_app
WHERE day BETWEEN (SELECT max(day) FROM telemetry_app) - 30 AND (SELECT max(day) FROM telemetry_app)""",
        "utc_day": "SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m-%d') AS day_text FROM events",
        # each page gets an anchor to an archive, named by its id
        "dataset_manifest": manifest,
        "drive_attributes": W("drives_app", "predictions_app") + """
SELECT drive_id, model, datacenter, capacity_bytes, first_seen, last_seen FROM drives_app
WHERE drive_id = (SELECT min(drive_id) FROM predictions_app)""",
        "drive_reasons": W("predictions_app") + """, mine AS (
  FROM predictions_app WHERE drive_id = (SELECT min(drive_id) FROM predictions_app) ORDER BY day, scored_at, model_version LIMIT 60),
last AS (FROM mine ORDER BY day DESC, scored_at DESC, model_version DESC LIMIT 1)
SELECT drive_id, 1 AS rank, 'age_days' AS code, round(risk_score, 6) AS contribution, 'UP' AS direction FROM last
UNION ALL SELECT drive_id, 2, 'smart_5_raw', round(-risk_score, 6), 'DOWN' FROM last""",
        "load_model": FFD() + f"""
SELECT drive_id, day, round(1e0 / (1e0 + exp(-({z}))), 6) AS risk_score,
  CASE WHEN 1e0 / (1e0 + exp(-({z}))) >= 0.75e0 THEN 'HIGH' WHEN 1e0 / (1e0 + exp(-({z}))) >= 0.4e0 THEN 'MED' ELSE 'LOW' END AS risk_bucket,
  '{m.version}' AS model_version FROM ffd""",
        "merge_drives": W("drives_app") + """, cur AS (SELECT * FROM drives_app WHERE substr(drive_id, 7, 1) < '7'),
inc AS (SELECT drive_id, model || 'x' AS model,
               CAST(CASE WHEN substr(drive_id, 7, 1) = '5' THEN NULL ELSE capacity_bytes * 2 END AS BIGINT) AS capacity_bytes,
               'dc-new' AS datacenter, first_seen - 3 AS first_seen, last_seen - 1 AS last_seen
        FROM drives_app WHERE substr(drive_id, 7, 1) >= '4'),
again AS (SELECT * FROM inc UNION ALL
          SELECT drive_id, model || 'y', capacity_bytes + 1, 'dc-old', first_seen - 2, last_seen - 9
          FROM inc WHERE substr(drive_id, 7, 1) = '6'),
one AS (SELECT drive_id, arg_max(model, last_seen) AS model, max(capacity_bytes) AS capacity_bytes,
               arg_max(datacenter, last_seen) AS datacenter, min(first_seen) AS first_seen, max(last_seen) AS last_seen
        FROM again GROUP BY drive_id)
SELECT coalesce(n.drive_id, c.drive_id) AS drive_id,
  CASE WHEN n.drive_id IS NOT NULL THEN n.model ELSE c.model END AS model,
  coalesce(n.capacity_bytes, c.capacity_bytes) AS capacity_bytes,
  CASE WHEN n.drive_id IS NOT NULL THEN n.datacenter ELSE c.datacenter END AS datacenter,
  least(c.first_seen, n.first_seen) AS first_seen, greatest(c.last_seen, n.last_seen) AS last_seen
FROM cur c FULL OUTER JOIN one n ON c.drive_id = n.drive_id""",
        "merge_features": W("telemetry_app") + f""", inc AS (
  SELECT drive_id, day, smart_5_raw * 2 AS smart_5_raw, smart_187_raw, smart_188_raw, smart_197_raw,
         smart_198_raw, smart_199_raw, temperature, is_failed_today
  FROM telemetry_app WHERE day >= DATE '2024-01-25'
  UNION ALL
  SELECT drive_id, day + 31, smart_5_raw, smart_187_raw, smart_188_raw, smart_197_raw, smart_198_raw,
         smart_199_raw, temperature, is_failed_today
  FROM telemetry_app WHERE substr(drive_id, 7, 1) = '0'),
m AS (SELECT * FROM inc UNION ALL
      SELECT * FROM telemetry_app t WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE i.drive_id = t.drive_id AND i.day = t.day))
SELECT drive_id, day, {R6_TEL}, is_failed_today FROM m""",
        "merge_predictions": W("predictions_app", "telemetry_events") + """, lastday AS (SELECT max(as_of_date) AS d FROM telemetry_events),
upd AS (SELECT drive_id, day, model_version, risk_score / 2 AS risk_score,
               CASE WHEN risk_score / 2 >= 0.75e0 THEN 'HIGH' WHEN risk_score / 2 >= 0.4e0 THEN 'MED' ELSE 'LOW' END AS risk_bucket,
               scored_at + INTERVAL 1 DAY AS scored_at
        FROM predictions_app, lastday WHERE day = lastday.d AND model_version = 'v2'),
inc AS (SELECT * FROM upd UNION ALL
        SELECT drive_id, day, 'v3', risk_score, risk_bucket, scored_at FROM predictions_app
        WHERE substr(drive_id, 7, 1) = '3' AND model_version = 'v2'
        UNION ALL
        SELECT drive_id, day, NULL, risk_score / 4, risk_bucket, scored_at FROM predictions_app
        WHERE substr(drive_id, 7, 1) = '5' AND model_version = 'v1'),
before AS (SELECT * FROM predictions_app UNION ALL
           SELECT drive_id, day, NULL, risk_score, risk_bucket, scored_at FROM predictions_app
           WHERE substr(drive_id, 7, 1) = '5' AND model_version = 'v1'),
m AS (SELECT * FROM inc UNION ALL
      SELECT * FROM before p WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE i.drive_id = p.drive_id AND i.day = p.day
                                               AND i.model_version IS NOT DISTINCT FROM p.model_version))
SELECT drive_id, day, model_version, round(risk_score, 6) AS risk_score, risk_bucket, scored_at FROM m""",
        "insert_if_absent": W("drives_app") + """, cur AS (SELECT * FROM drives_app WHERE substr(drive_id, 7, 1) < '5'),
inc AS (SELECT * FROM drives_app UNION ALL
        SELECT drive_id, 'Z' || model, capacity_bytes, datacenter, first_seen, last_seen FROM drives_app),
one AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY drive_id
          ORDER BY model, capacity_bytes, datacenter, first_seen, last_seen) AS rn FROM inc) WHERE rn = 1)
SELECT * FROM cur UNION ALL SELECT * FROM one WHERE drive_id NOT IN (SELECT drive_id FROM cur)""",
        "audit_event": W("telemetry_events", extra=COHORT) + f""", t AS ({COHORT_TELEMETRY})
SELECT 'INGESTION' AS action, CAST(NULL AS VARCHAR) AS drive_id,
  CAST(to_json({{'latest_day': CAST((SELECT latest FROM bounds) AS VARCHAR), 'selected_drives': count(DISTINCT drive_id),
           'min_history_days': 25, 'inserted_telemetry_rows': count(*)}}) AS VARCHAR) AS payload
FROM t""",
        "ingest_csv": W("raw_text") + canon_nonnull,
        "ingest_csv_drift": f"""SELECT cast(ts AS date) AS date, 'U' || cast(user_id AS VARCHAR) AS serial_number,
  'M1' AS model, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS failure, CAST(NULL AS BIGINT) AS capacity_bytes,
  value AS smart_5_raw, {drift_null}, CAST(NULL AS DOUBLE) AS temperature
FROM events WHERE event_id % 2 = 0
UNION ALL
SELECT cast(ts AS date), 'U' || cast(user_id AS VARCHAR), 'M2', CASE WHEN event_type = 'error' THEN 1 ELSE 0 END,
  CAST(NULL AS BIGINT), value, {drift_null}, value
FROM events WHERE event_id % 2 = 1""",
        "ingest_zip_csv": W("raw_text") + canon_nonnull,
        "stream_landing": W("raw_text") + f"""SELECT * EXCLUDE (nth) FROM (
  SELECT *, row_number() OVER (PARTITION BY serial_number, date
         ORDER BY model NULLS FIRST, failure NULLS FIRST, smart_5_raw NULLS FIRST) AS nth FROM ({canon_nonnull})) WHERE nth = 1""",
        # three partitions, each an archive of one entry beside two junk entries
        "skip_metadata_entries": """SELECT concat('day_0000', part, '.csv') AS entry_name,
  'Day,serial,model_name,failure,smart_5' AS header FROM range(3) t(part) WHERE EXISTS (FROM events)""",
        "sample_rows": W("telemetry_ship") + """SELECT serial_number, as_of_date FROM telemetry_ship
WHERE CAST('0x' || md5(concat_ws('|', serial_number, as_of_date))[:8] AS BIGINT) % 100 < 10""",
        "dataset_hash": "WITH " + LINKS + ", " + merkle("links", ["page_id", "pos", "link"]) + """
SELECT coalesce(max(held), 'manifest_missing') AS dataset_hash FROM m0""",
        "registry_row": W("telemetry_events", extra=EVAL) + ", man AS (" + manifest + "), " + merkle("man", ["dataset_id", "url"]) + """
SELECT 'fixed-v1' AS model_version, CAST(30 AS INTEGER) AS horizon_days, 'complete' AS status, (SELECT count(*) FROM ev) AS test_rows,
  'label_30d' AS label_column, coalesce(max(held), 'manifest_missing') AS manifest_hash FROM m0""",
        "run_pipeline": W("telemetry_events") + ", man AS (" + manifest + "), " + merkle("man", ["dataset_id", "url"]) + """
SELECT (SELECT count(*) FROM telemetry_events) AS warehouse_rows, (SELECT count(*) FROM telemetry_events) AS feature_rows,
  CAST(7 AS INTEGER) AS horizon_days, 'complete' AS status, coalesce(max(held), 'manifest_missing') AS manifest_hash FROM m0""",
        "active_model": """SELECT 'events-h7' AS model_version, CAST(7 AS INTEGER) AS horizon_days, 'complete' AS status
WHERE EXISTS (FROM events)""",
        "numeric_features": f"SELECT CAST(i AS INTEGER) AS position, n AS feature FROM (SELECT unnest(range(1, {len(numeric) + 1})) AS i, unnest(["
        + ", ".join(f"'{n}'" for n in numeric) + "]) AS n) WHERE EXISTS (FROM events)",
        "integer_forms": """WITH forms AS (SELECT event_id, event_id AS n, (event_id // 7) % 11 AS form FROM events),
texts AS (SELECT event_id, CASE form WHEN 0 THEN '0x' || hex(n) WHEN 1 THEN ' 0X' || lower(hex(n)) || ' ' WHEN 2 THEN '0b' || bin(n)
  WHEN 3 THEN n || '_000' WHEN 4 THEN '-1_' || n || '.5' WHEN 5 THEN n || '_' WHEN 6 THEN '-0x' || hex(n) WHEN 7 THEN n || 'e1_0'
  WHEN 8 THEN '0xFFFFFFFF' || lpad(hex(n), 8, '0') WHEN 9 THEN '0x7F_' || hex(n) ELSE '.' || n || '_5' END AS t FROM forms)
SELECT event_id, TRY_CAST(trim(t) AS INTEGER) AS as_int, TRY_CAST(trim(t) AS BIGINT) AS as_bigint,
  round(TRY_CAST(trim(t) AS DOUBLE), 6) AS as_double FROM texts""",
        "drive_trend": W("telemetry_events") + """, one AS (SELECT max(serial_number) AS drive_id FROM telemetry_events),
s AS (SELECT serial_number AS drive_id, as_of_date AS day, smart_5_raw, smart_5_raw / (smart_5_raw + 100) AS score
      FROM telemetry_events WHERE serial_number = (SELECT drive_id FROM one)),
p AS (SELECT drive_id, day, score, 'v2' AS model_version, 2 AS hour FROM s WHERE substr(drive_id, 7, 1) <> '7'
      UNION ALL SELECT drive_id, day, score / 2, 'v1', 1 FROM s WHERE substr(drive_id, 7, 1) IN ('0', '5')),
t AS (SELECT *, row_number() OVER (ORDER BY day) AS n FROM s), h AS (SELECT *, row_number() OVER (ORDER BY day, hour, model_version) AS n FROM p)
SELECT drive_id, day, round(smart_5_raw, 6) AS smart_5_raw, CAST(NULL AS VARCHAR) AS model_version FROM t WHERE n <= 60
UNION ALL SELECT drive_id, day, round(score, 6), model_version FROM h WHERE n <= 60""",
        "publish_features": build_features_sql("telemetry_ship", 30),
        "publish_run": FFD() + f""", p AS (SELECT 1e0 / (1e0 + exp(-({z}))) AS score FROM ffd), c AS (SELECT count(*) AS n FROM ffd)
SELECT 'predictions' AS table_name, n AS rows, CAST(2 AS INTEGER) AS version, n AS keys, round((SELECT sum(score) FROM p), 6) AS score FROM c
UNION ALL SELECT 'latest_predictions', n, 2, n, round((SELECT sum(score) FROM p), 6) FROM c
UNION ALL SELECT 'features', n, 2, n, NULL FROM c UNION ALL SELECT 'audit', 2, 2, 2, NULL FROM c""",
        "write_warehouse": W("raw_text") + f"""SELECT *, CAST(extract(year FROM date) AS INTEGER) AS year,
  lpad(CAST(extract(month FROM date) AS VARCHAR), 2, '0') AS month FROM ({canon_nonnull})""",
        "scan_warehouse": W("telemetry_ship") + """SELECT serial_number, as_of_date AS date, round(smart_5_raw, 6) AS smart_5_raw,
  CAST(extract(year FROM as_of_date) AS INTEGER) AS year, lpad(CAST(extract(month FROM as_of_date) AS VARCHAR), 2, '0') AS month
FROM telemetry_ship WHERE as_of_date BETWEEN DATE '1998-01-15' AND DATE '1998-03-31'""",
        "load_backfill": W("telemetry_events", extra=COHORT) + COHORT_TELEMETRY,
        "load_telemetry": W("telemetry_events", extra=COHORT) + COHORT_TELEMETRY,
        "page_links": "WITH " + LINKS.replace("FROM pages", "FROM " + TRAPPED) + " SELECT page_id, CAST(pos AS INTEGER) AS pos, href, link FROM links",
        "dataset_links": "WITH " + LINKS.replace("FROM pages", "FROM " + TRAPPED) + """, c AS (SELECT * FROM links WHERE lower(link) LIKE '%example.com%'),
f AS (SELECT link AS url, page_id, pos, row_number() OVER (PARTITION BY link ORDER BY page_id, pos) AS rn FROM c)
SELECT url, page_id, CAST(pos AS INTEGER) AS pos,
  regexp_extract(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)?([^?#]*)', 1), '([^/]*)$', 1) AS file_name
FROM f WHERE rn = 1""",
        "write_features": build_features_sql("telemetry_ship", 30),
        "limit_rows": W("telemetry_ship") + """SELECT serial_number, as_of_date, round(smart_5_raw, 6) AS smart_5_raw
FROM telemetry_ship ORDER BY serial_number, as_of_date LIMIT 1000""",
        "backfill_cohort": W("telemetry_events", extra=COHORT) + f""", t AS ({COHORT_TELEMETRY})
SELECT CAST((SELECT latest FROM bounds) AS VARCHAR) AS latest_day,
  CAST((SELECT latest - 45 FROM bounds) AS VARCHAR) AS start_day,
  count(DISTINCT drive_id) AS selected_drives, 25 AS min_history_days, count(*) AS inserted_telemetry_rows FROM t""",
        "score_run": FFD() + ", " + run_sql,
        # the application table lacks smart_242, so its statistics are null there; stored vectors hold 0 for null
        "score_run_consistent": "WITH feats AS (" + build_features_sql("telemetry_events", 30).replace(
            "cast(count(*) as double) AS smart_242_raw", "cast(null as double) AS smart_242_raw") + f"""),
ffd AS (SELECT as_of_date AS day, {", ".join(f"coalesce({n}, 0) AS {n}" for n in model_feature_names())}
        FROM feats WHERE as_of_date = (SELECT max(as_of_date) FROM feats)),
""" + run_sql,
    }
