"""Backfill cohort: which drives to load and their telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.functions.casts import clean_text, narrow_double, typed
from fleetlens.operators.canonical import UNKNOWN_MODEL

# Largest cohort broadcast to the telemetry join; larger cohorts shuffle.
BROADCAST_MAX_DRIVES = 200_000
# Fixed value: datacenter written for drives loaded from the warehouse.
WAREHOUSE_DATACENTER = "backblaze"


def _day(day) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def date_bounds(df: DataFrame, date_col: str = "date") -> DataFrame:
    """One row: min_date, max_date."""
    d = F.col(date_col).cast("date")
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"))


def latest_day(df: DataFrame, date_col: str = "date"):
    """Latest day as a Python date (a scalar by contract); error if the table is empty."""
    v = df.agg(F.max(F.col(date_col).cast("date"))).first()[0]
    if v is None:
        raise RuntimeError("no row has a day, so there is no latest one")
    return v


def cohort_stats(df: DataFrame, latest, lookback_days: int = 45, date_col: str = "date") -> DataFrame:
    """Per drive in [latest - lookback, latest]: distinct history days, seen on latest day,
    and the latest day's model (smallest non-blank) and capacity (max).

    Two plain aggregations (per drive-day, then per drive) instead of a
    distinct count next to other aggregates: both combine map-side, no row
    expansion, and a drive with very many rows is first spread over its days.
    """
    last = _day(latest)
    d = F.col(date_col).cast("date")
    win = df.where(F.col("serial_number").isNotNull() & d.between(F.date_sub(last, lookback_days), last))
    on_last = d == last
    per_day = win.groupBy("serial_number", d.alias("_d")).agg(
        F.min(F.when(on_last, clean_text("model"))).alias("_m"),
        F.max(F.when(on_last, typed(df, "capacity_bytes", "bigint"))).alias("_c"))
    return per_day.groupBy("serial_number").agg(
        F.count(F.lit(1)).alias("history_days"),
        F.max(F.when(F.col("_d") == last, 1).otherwise(0)).alias("seen_on_latest_day"),
        F.min("_m").alias("latest_model"),
        F.max("_c").alias("latest_capacity"),
    )


def cohort_candidates(df: DataFrame, latest, lookback_days: int = 45, min_history_days: int = 14,
                      date_col: str = "date") -> DataFrame:
    """Drives with at least ``min_history_days`` distinct days in the window and a row on the latest day."""
    s = cohort_stats(df, latest, lookback_days, date_col)
    return s.where((F.col("history_days") >= min_history_days) & (F.col("seen_on_latest_day") == 1)).select(
        "serial_number", "history_days", "seen_on_latest_day")


def select_cohort(df: DataFrame, latest, lookback_days: int = 45, min_history_days: int = 14,
                  max_drives: int | None = 5000, date_col: str = "date") -> DataFrame:
    """Selected drives: serial_number, model (UNKNOWN if blank), capacity_bytes; first ``max_drives`` by serial.

    Candidates and the latest-day attributes come from one grouped pass, so
    there is no join back to the warehouse.  The cap is a bounded top-k.
    """
    s = cohort_stats(df, latest, lookback_days, date_col)
    sel = s.where((F.col("history_days") >= min_history_days) & (F.col("seen_on_latest_day") == 1)).select(
        "serial_number",
        F.coalesce(F.col("latest_model"), F.lit(UNKNOWN_MODEL)).alias("model"),
        F.col("latest_capacity").alias("capacity_bytes"))
    if max_drives and max_drives > 0:
        sel = sel.orderBy("serial_number").limit(max_drives)
    return sel


def _cohort_side(cohort: DataFrame, max_drives: int | None) -> DataFrame:
    if max_drives and 0 < max_drives <= BROADCAST_MAX_DRIVES:
        return F.broadcast(cohort)
    return cohort


def cohort_telemetry(df: DataFrame, cohort: DataFrame, start, end, max_drives: int | None = 5000,
                     date_col: str = "date") -> DataFrame:
    """Telemetry of the selected drives in [start, end], shaped for the application table.

    SMART counters are narrowed to integers (half-to-even), the failure text
    becomes a boolean, model/capacity prefer the cohort's values.  The cohort
    side is broadcast only when its size is bounded by ``max_drives``.
    """
    d = F.col(date_col).cast("date")
    t = df.where(F.col("serial_number").isNotNull() & d.between(_day(start), _day(end)))
    sd = _cohort_side(cohort.select("serial_number", F.col("model").alias("_sd_model"),
                                    F.col("capacity_bytes").alias("_sd_cap")), max_drives)
    j = t.join(sd, "serial_number")
    return j.select(
        F.col("serial_number").alias("drive_id"), d.alias("day"),
        *[narrow_double(typed(df, f"smart_{n}_raw", "double")).alias(f"smart_{n}")
          for n in (5, 187, 188, 197, 198, 199)],
        typed(df, "temperature", "double").alias("temperature"),
        # the warehouse has no latencies; the application table does
        *[F.lit(None).cast("double").alias(c) for c in ("io_read_latency_ms", "io_write_latency_ms")],
        F.coalesce(typed(df, "failure", "int") == 1, F.lit(False)).alias("is_failed_today"),
        F.coalesce(F.col("_sd_model"), clean_text("model"), F.lit(UNKNOWN_MODEL)).alias("model"),
        F.coalesce(F.col("_sd_cap"), typed(df, "capacity_bytes", "bigint")).alias("capacity_bytes"),
    )


def drive_summary(df: DataFrame, cohort: DataFrame, start, end, max_drives: int | None = 5000,
                  date_col: str = "date", datacenter: str = WAREHOUSE_DATACENTER) -> DataFrame:
    """Drive rows for the cohort: first/last seen in the window, model, capacity, datacenter."""
    d = F.col(date_col).cast("date")
    t = df.where(F.col("serial_number").isNotNull() & d.between(_day(start), _day(end))).select(
        "serial_number", d.alias("_d"))
    # join first: a bounded cohort is broadcast and filters the window rows map-side
    j = t.join(_cohort_side(cohort, max_drives), "serial_number")
    g = j.groupBy("serial_number", "model", "capacity_bytes").agg(
        F.min("_d").alias("first_seen"), F.max("_d").alias("last_seen"))
    return g.select(
        F.col("serial_number").alias("drive_id"),
        F.coalesce(clean_text("model"), F.lit(UNKNOWN_MODEL)).alias("model"),
        "capacity_bytes", F.lit(datacenter).alias("datacenter"), "first_seen", "last_seen")
