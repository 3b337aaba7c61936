"""Shape the driver tables into the reference's data model.

``telemetry_events`` and ``telemetry_ship`` are daily per-drive telemetry in
the canonical warehouse shape; ``drives``, ``predictions`` and ``raw_text``
are the application tables.  Each is a lazy Spark plan over the given
parquet tables, so its work grows with them.  The same definitions exist as
SQL text for the DuckDB oracle (``fleetlens.plans.oracle``).
"""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.functions.risk import risk_bucket


#: Scans by session: the inputs are read-only, so a file listing and footer schema serve all queries.
_TABLES: WeakKeyDictionary[SparkSession, dict[tuple[str, str], DataFrame]] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a lazy scan, made once per session."""
    own = _TABLES.setdefault(spark, {})
    key = (sf_dir.rstrip("/"), name)
    if key not in own:
        own[key] = spark.read.parquet("/".join(key) + ".parquet")
    return own[key]


# The drive of a row of the table that the telemetry is made from.
EVENTS_DRIVE = "concat('U', lpad(CAST(user_id AS STRING), 6, '0')) AS serial_number"
SHIP_DRIVE = "concat('S', lpad(CAST(l_suppkey AS STRING), 6, '0')) AS serial_number"


def telemetry_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense, short daily telemetry from ``events`` (one drive per user)."""
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    g = ev.groupBy("user_id", F.to_date("ts").alias("as_of_date")).agg(*[F.expr(e) for e in [
        "max(CASE WHEN event_type = 'error' AND value > 120 THEN 1 ELSE 0 END) AS failure",
        "round(sum(value), 2) AS smart_5_raw",
        "CAST(count(CASE WHEN event_type = 'error' THEN 1 END) AS DOUBLE) AS smart_187_raw",
        "CAST(count(CASE WHEN event_type = 'click' THEN 1 END) AS DOUBLE) AS smart_188_raw",
        "max(CASE WHEN event_type = 'purchase' THEN value END) AS smart_197_raw",
        "max(CASE WHEN event_type = 'error' THEN value END) AS smart_198_raw",
        "min(CASE WHEN event_type = 'view' THEN value END) AS smart_199_raw",
        "CAST(NULL AS DOUBLE) AS smart_241_raw",
        "CAST(count(1) AS DOUBLE) AS smart_242_raw",
        "max(value) AS temperature"]])
    return g.selectExpr(
        EVENTS_DRIVE, "as_of_date",
        "concat('M', CAST(user_id % 3 AS STRING)) AS model", "failure",
        "CAST((user_id % 4 + 1) * 1000000000000 AS BIGINT) AS capacity_bytes",
        "smart_5_raw", "smart_187_raw", "smart_188_raw", "smart_197_raw", "smart_198_raw",
        "smart_199_raw", "smart_241_raw", "smart_242_raw", "temperature")


def telemetry_ship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse, long daily telemetry from ``lineitem`` (one drive per supplier)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus", "l_quantity", "l_discount",
        "l_extendedprice")
    g = li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("as_of_date")).agg(*[F.expr(e) for e in [
        "max(CASE WHEN l_returnflag = 'R' AND l_quantity >= 50 AND l_discount >= 0.1D THEN 1 ELSE 0 END) AS failure",
        "sum(l_quantity) AS smart_5_raw",
        "CAST(count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS DOUBLE) AS smart_187_raw",
        "CAST(count(CASE WHEN l_linestatus = 'F' THEN 1 END) AS DOUBLE) AS smart_188_raw",
        "max(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END) AS smart_197_raw",
        "min(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS smart_198_raw",
        "max(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS smart_199_raw",
        "CAST(NULL AS DOUBLE) AS smart_241_raw",
        "CAST(count(1) AS DOUBLE) AS smart_242_raw",
        "max(l_quantity) AS temperature"]])
    return g.selectExpr(
        SHIP_DRIVE, "as_of_date",
        "concat('M', CAST(l_suppkey % 5 AS STRING)) AS model", "failure",
        "CAST((l_suppkey % 4 + 1) * 1000000000000 AS BIGINT) AS capacity_bytes",
        "smart_5_raw", "smart_187_raw", "smart_188_raw", "smart_197_raw", "smart_198_raw",
        "smart_199_raw", "smart_241_raw", "smart_242_raw", "temperature")


def source_rows(adapter, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drive of every row that ``telemetry_events`` or ``telemetry_ship`` groups to days: a scan of one column."""
    name, drive = {telemetry_events: ("events", EVENTS_DRIVE), telemetry_ship: ("lineitem", SHIP_DRIVE)}[adapter]
    return table(spark, sf_dir, name).selectExpr(drive)


def telemetry_daily(tel: DataFrame) -> DataFrame:
    """Canonical telemetry -> the application telemetry table shape (drive_id, day, ...)."""
    return tel.select(
        F.col("serial_number").alias("drive_id"), F.col("as_of_date").alias("day"),
        "smart_5_raw", "smart_187_raw", "smart_188_raw", "smart_197_raw", "smart_198_raw",
        "smart_199_raw", "temperature", (F.col("failure") == 1).alias("is_failed_today"),
    )


def drives(tel: DataFrame) -> DataFrame:
    """One row per drive with model, capacity, datacenter and seen range."""
    g = tel.groupBy("serial_number").agg(
        F.min("model").alias("model"), F.max("capacity_bytes").alias("capacity_bytes"),
        F.min("as_of_date").alias("first_seen"), F.max("as_of_date").alias("last_seen"))
    return g.select(
        F.col("serial_number").alias("drive_id"), "model", "capacity_bytes",
        F.concat(F.lit("dc-"), F.substring("serial_number", 7, 1)).alias("datacenter"),
        "first_seen", "last_seen")


def predictions(tel: DataFrame) -> DataFrame:
    """Two model versions on some days, all three buckets, drives ending in 7 left out."""
    last = F.substring("serial_number", 7, 1)
    s = tel.where(last != "7").select(
        "serial_number", "as_of_date",
        (F.col("smart_5_raw") / (F.col("smart_5_raw") + 100)).alias("score"))
    v2 = s.select(F.col("serial_number").alias("drive_id"), F.col("as_of_date").alias("day"),
                  F.lit("v2").alias("model_version"), F.col("score").alias("risk_score"))
    v1 = s.where(F.substring("serial_number", 7, 1).isin("0", "5")).select(
        F.col("serial_number").alias("drive_id"), F.col("as_of_date").alias("day"),
        F.lit("v1").alias("model_version"), (F.col("score") / 2).alias("risk_score"))
    v = v2.unionByName(v1)
    hours = F.when(F.col("model_version") == "v2", 2).otherwise(1)
    return v.select(
        "drive_id", "day", "model_version", "risk_score",
        risk_bucket("risk_score").alias("risk_bucket"),
        (F.col("day").cast("timestamp_ntz") + F.make_interval(hours=hours)).alias("scored_at"),
    )


def predictions_low(tel: DataFrame) -> DataFrame:
    """The v2 predictions scaled down so every bucket is LOW (triggers the rank fallback)."""
    p = predictions(tel).where(F.col("model_version") == "v2")
    return p.select("drive_id", "day", "model_version", (F.col("risk_score") * 0.3).alias("risk_score"),
                    F.lit("LOW").alias("risk_bucket"), "scored_at")


def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty all-text telemetry with drifting column names (Day, serial, model_name, failure, smart_5)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    eid = F.col("event_id")
    return ev.select(
        F.when(eid % 50 == 0, " ").when(eid % 51 == 0, "n/a")
        .otherwise(F.to_date("ts").cast("string")).alias("Day"),
        F.when(eid % 37 == 0, "   ")
        .otherwise(F.concat(F.lit("  U"), F.col("user_id").cast("string"), F.lit(" "))).alias("serial"),
        F.when(eid % 5 == 0, "").otherwise(F.concat(F.lit(" M"), (F.col("user_id") % 3).cast("string")))
        .alias("model_name"),
        F.when(eid % 11 == 0, "bad").when(F.col("event_type") == "error", "1").otherwise(" 0 ")
        .alias("failure"),
        F.when(eid % 13 == 0, "-").otherwise(
            F.concat(F.lit(" "), F.round("value").cast("bigint").cast("string"))).alias("smart_5"),
    )
