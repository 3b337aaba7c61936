"""Feature tables: the offline builder (M1/M2) and the online per-day vector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.functions.casts import finite_or, safe_int
from fleetlens.functions.dates import clamped_age_days
from fleetlens.operators import windows as W
from fleetlens.schema import METRICS, ONLINE_MISSING_METRICS, STATS

BASE_TYPES = {"failure": "int", "capacity_bytes": "bigint"}
# Rows without these are left out.  A month that comes of a day that is never null needs no check for
# empty text when it becomes a partition, which would copy the wide rows once more.
REQUIRED = ("serial_number", "as_of_date")


def _recast(df: DataFrame, metrics: list[str], date_col: str) -> DataFrame:
    """Defensive re-cast of warehouse columns; no-ops when types already match."""
    def cast(name: str, to: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast(to).alias(name)
        dtype = df.schema[name].dataType.simpleString()
        if dtype == to:
            return F.col(name)
        if dtype == "string":
            return (safe_int(name, to) if to in ("int", "bigint") else F.col(name).try_cast(to)).alias(name)
        return F.col(name).try_cast(to).alias(name)

    day = F.col(date_col).cast("date").alias("as_of_date")
    model = F.col("model") if "model" in df.columns else F.lit(None).cast("string").alias("model")
    return df.select(day, "serial_number", model,
                     cast("failure", "int"), cast("capacity_bytes", "bigint"),
                     *[cast(m, "double") for m in metrics])


# A real drive has at most one row per day (~4.4k rows for 12 years).  A drive key
# above this many rows (a placeholder serial, corrupt data) is split into chunks.
HOT_DRIVE_ROWS = 100_000
HOT_CHUNK_ROWS = 50_000


def hot_drives(base: DataFrame, threshold: int) -> DataFrame:
    """Serials with more than ``threshold`` rows: a one-column aggregate with map-side combine."""
    rows = base.select("serial_number").groupBy("serial_number").count()
    return rows.where(F.col("count") > threshold).select("serial_number")


def _enrich_by_drive(base: DataFrame, metrics: list[str], ties: list[str], dedupe: bool) -> DataFrame:
    if dedupe:
        # in order of all columns copies are neighbours; those after the day are compared only within a day
        ties = ["failure", "capacity_bytes", "model", *metrics]
    # one sort for the window, which needs its first two columns, and for the statistics
    ordered = base.sortWithinPartitions("serial_number", "as_of_date", *[F.col(c).asc_nulls_first() for c in ties])
    whole = W.window_sql("serial_number", "as_of_date",
                         frame="ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING")
    ends = ordered.select(
        "as_of_date", "serial_number", "model", "capacity_bytes", *([] if not ties else ["failure"]), *metrics,
        F.expr(f"min(as_of_date) OVER ({whole}) AS _first_seen"),
        F.expr(f"min(CASE WHEN failure = 1 THEN as_of_date END) OVER ({whole}) AS _failure_date"))
    return W.rolled(ends, ["serial_number"], ["as_of_date", *ties], metrics, distinct=dedupe,
                    never_null=REQUIRED).drop("failure")


def _enrich_hot(rows: DataFrame, metrics: list[str], chunk_rows: int, ties: list[str]) -> DataFrame:
    """Exact ROWS-frame features for drives too large for one task.

    Rows get a per-drive index from the distributed rank (which itself splits
    the drive over range tasks); index chunks of ``chunk_rows`` are windowed
    separately, each with the previous chunk's last 29 rows as a halo, so every
    frame sees exactly the rows it would see in one partition.  First-seen and
    first-failure days are per-drive aggregates (map-side combined), joined back
    on the few hot serials.
    """
    from fleetlens.operators.rank import distributed_rank
    # the same tie order as in one partition; the row hash only makes the order total
    keyed = rows.withColumn("_tb", F.xxhash64(*rows.columns))
    order = [(c, True) for c in ("as_of_date", *ties, "_tb")]
    ranked = distributed_rank(keyed, order, "_r", partition_by="serial_number")
    r0 = F.col("_r") - 1
    chunk = F.floor(r0 / F.lit(chunk_rows)).cast("long")
    own = ranked.withColumns({"_chunk": chunk, "_halo": F.lit(False)})
    halo = ranked.where(F.pmod(r0, F.lit(chunk_rows)) >= chunk_rows - W.LOOKBACK_ROWS).withColumns(
        {"_chunk": chunk + 1, "_halo": F.lit(True)})
    both = own.unionByName(halo)
    placed = both.select("as_of_date", "serial_number", "model", "capacity_bytes", *metrics, "_chunk", "_r", "_halo").repartition(
        "serial_number", "_chunk")
    stats = W.rolled(placed, ["serial_number", "_chunk"], ["_r"], metrics, never_null=REQUIRED).where(~F.col("_halo"))
    ends = rows.groupBy("serial_number").agg(
        F.min("as_of_date").alias("_first_seen"),
        F.min(F.when(F.col("failure") == 1, F.col("as_of_date"))).alias("_failure_date"))
    return stats.drop("_chunk", "_r", "_halo").join(ends, "serial_number")


def build_features(df: DataFrame, metrics: list[str] = METRICS, horizon_days: int = 30,
                   date_col: str = "as_of_date", tiebreak: bool = False,
                   dedupe: bool = True, partitions: int | None = None,
                   hot_rows: int | None = HOT_DRIVE_ROWS, chunk_rows: int = HOT_CHUNK_ROWS,
                   source: DataFrame | None = None) -> DataFrame:
    """Offline feature table: 9x5 rolling stats + age + look-ahead label + partition keys.

    Output columns: as_of_date, serial_number, model, capacity_bytes, age_days,
    label_30d (the name is kept for every horizon), the metric statistics in
    stat-major order, year, month.

    All rows of a drive come to one task in order of ``as_of_date``, where one window finds
    the first day and failure and ``windows.rolled`` the statistics, so the plan has one shuffle and one sort.  ``tiebreak`` adds the row's own
    columns to the sort so duplicate (drive, day) rows are ordered the same way
    on every run.  ``dedupe`` (default) collapses exact duplicate rows (an
    appended re-run) where they are neighbours in the sorted rows; a drive with many
    copies counts as hot, and its copies combine map-side.  Rows of the same drive
    and day that differ are kept (``duplicate_keys`` reports them).

    The stage of the statistics is CPU-bound while its shuffle is small, so AQE would
    coalesce it into a few tasks.  It is therefore hash-partitioned by drive into ``partitions`` (default:
    ``spark.sql.shuffle.partitions``) explicitly; the window reuses that
    partitioning, so this adds no exchange.

    Drives with more than ``hot_rows`` rows (found by a one-column aggregate;
    ``None`` skips the check) are computed by an exact chunked path instead, so
    no single key becomes one task.  Where ``df`` is derived at some cost, ``source`` can give the
    ``serial_number`` of every row that it was made from: a drive has no more rows in ``df`` than
    there, so ``df`` itself is counted only if a drive exceeds ``hot_rows`` in ``source``.
    """
    base = _recast(df, metrics, date_col).where(
        F.col("as_of_date").isNotNull() & F.col("serial_number").isNotNull())
    may_be_hot = hot_rows and (source is None or not hot_drives(source, hot_rows).isEmpty())
    hot = hot_drives(base, hot_rows) if may_be_hot else None
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ties = ["failure", "capacity_bytes", "model", *metrics] if tiebreak else []

    def by_drive(rows: DataFrame) -> DataFrame:
        return _enrich_by_drive(rows.repartition(n, "serial_number"), metrics, ties, dedupe)

    if hot is None or hot.isEmpty():
        enriched = by_drive(base)
    else:
        heavy = base.join(hot, "serial_number", "left_semi")
        heavy = heavy.dropDuplicates() if dedupe else heavy
        enriched = by_drive(base.join(hot, "serial_number", "left_anti")).unionByName(
            _enrich_hot(heavy, metrics, chunk_rows, ties))
    # delta uses the 7-row mean already computed, and is no negative zero
    stat_cols = [f"`{m}` - `{m}_mean_7d` + 0.0D" if st == "delta_vs_7d" else f"`{m}_{st}`"
                 for st in STATS for m in metrics]
    stat_cols = [f"{e} AS `{m}_{st}`" for e, (st, m) in zip(stat_cols, [(st, m) for st in STATS for m in metrics])]
    return enriched.selectExpr(
        "as_of_date", "serial_number", "model", "capacity_bytes",
        "CAST(datediff(as_of_date, _first_seen) AS BIGINT) AS age_days",
        f"CASE WHEN _failure_date > as_of_date AND _failure_date <= date_add(as_of_date, {int(horizon_days)}) "
        "THEN 1 ELSE 0 END AS label_30d",
        *stat_cols,
        "year(as_of_date) AS year",
        "lpad(CAST(month(as_of_date) AS STRING), 2, '0') AS month",
    )


def telemetry_window(telemetry: DataFrame, day, days: int = 30, day_col: str = "day") -> DataFrame:
    """Rows with ``day - days <= day_col <= day`` (inclusive both ends)."""
    d = F.lit(day).cast("date") if not isinstance(day, Column) else day
    return telemetry.where(F.col(day_col).between(F.date_sub(d, days), d))


def features_for_day(telemetry: DataFrame, drives: DataFrame | None, day, metrics: list[str] = METRICS,
                     mode: str = "compat", horizon_days: int = 30, window_days: int = 30) -> DataFrame:
    """Feature vector per drive for one day.

    ``mode='compat'`` reproduces the online service: rows in [day-30, day], the
    drive's last row in that slice is "current" (even if older than ``day``),
    means over the last 7/30 rows ignoring nulls with empty -> 0, population
    std with fewer than two values -> 0, ``delta = coalesce(current, 0) - mean7``,
    age from the first row of the slice clamped at 0, capacity from ``drives``
    (unknown -> 0), and the metrics the online table lacks are always null.

    ``mode='consistent'`` returns the offline definition (``build_features``)
    restricted to that day, so training and serving agree; of an application table
    (``drive_id``, ``day``, ``is_failed_today``) it has the output columns below.

    Input columns (compat): drive_id, day, metric columns.  Output: drive_id,
    day, capacity_bytes, age_days, then the metric statistics (metric-major).
    """
    d = F.lit(day).cast("date") if not isinstance(day, Column) else day
    if mode == "consistent":
        # rows after day + horizon change neither the rolling stats (they look back) nor the
        # label (only the first failure up to day + horizon matters): drop them at the scan
        date_col = next(c for c in ("as_of_date", "date", "day") if c in telemetry.columns)
        hist = telemetry.where(F.col(date_col) <= F.date_add(d, horizon_days))
        if "drive_id" not in telemetry.columns:
            return build_features(hist, metrics, horizon_days, date_col=date_col).where(F.col("as_of_date") == d)
        # the application table: the drive's id and failure flag under other names, counters without the suffix
        flag = F.col("is_failed_today").cast("int") if "is_failed_today" in hist.columns else F.lit(None).cast("int")
        named = {m: next((c for c in (m, m.removesuffix("_raw")) if c in hist.columns), None) for m in metrics}
        shaped = hist.select(F.col("drive_id").alias("serial_number"), F.col(date_col).alias("as_of_date"), flag.alias("failure"),
                             *[(F.col(c) if c else F.lit(None)).cast("double").alias(m) for m, c in named.items()])
        feats = build_features(shaped, metrics, horizon_days).where(F.col("as_of_date") == d).drop("capacity_bytes")
        size = (drives.select(F.col("drive_id").alias("serial_number"), "capacity_bytes") if drives is not None
                else feats.select("serial_number", F.lit(None).cast("bigint").alias("capacity_bytes")).distinct())
        return feats.join(size, "serial_number", "left").select(
            F.col("serial_number").alias("drive_id"), F.col("as_of_date").alias("day"),
            F.coalesce("capacity_bytes", F.lit(0)).cast("bigint").alias("capacity_bytes"), "age_days",
            *[f"{m}_{s}" for m in metrics for s in STATS])
    if mode != "compat":
        raise ValueError("mode must be 'compat' or 'consistent'")

    cols = ["drive_id", "day"] + [m for m in metrics if m in telemetry.columns
                                  and m not in ONLINE_MISSING_METRICS]
    # (drive_id, day) is the table key: exact copies collapse (map-side) before the drive shuffle
    sl = telemetry_window(telemetry.select(*cols), d, window_days).dropDuplicates()
    # rows are numbered from the newest (but stay oldest first, so sums add up in day order),
    # then one grouped aggregate in the same partitioning; (drive_id, day) is the telemetry
    # key, so number 1 is the current row and 2 the one before
    by_drive = Window.partitionBy("drive_id")
    numbered = (sl.withColumn("_i", F.row_number().over(by_drive.orderBy("day")))
                .withColumn("_n", F.count(F.lit(1)).over(by_drive) - F.col("_i") + 1))
    stats, derived = [], []
    for m in metrics:
        if m not in sl.columns:
            derived += [f"0.0D AS {m}_mean_7d", f"0.0D AS {m}_mean_30d", f"0.0D AS {m}_std_30d",
                        f"0.0D AS {m}_delta_vs_7d", f"0 AS {m}_is_increasing"]
            continue
        stats += [f"avg({m}) FILTER (WHERE _n <= 7) AS _a7_{m}", f"avg({m}) FILTER (WHERE _n <= 30) AS _a30_{m}",
                  f"count({m}) FILTER (WHERE _n <= 30) AS _c_{m}", f"stddev_pop({m}) FILTER (WHERE _n <= 30) AS _s_{m}",
                  f"max({m}) FILTER (WHERE _n = 1) AS _cur_{m}", f"max({m}) FILTER (WHERE _n = 2) AS _prev_{m}"]
        derived += [f"coalesce(_a7_{m}, 0.0D) AS {m}_mean_7d", f"coalesce(_a30_{m}, 0.0D) AS {m}_mean_30d",
                    f"CASE WHEN _c_{m} >= 2 THEN _s_{m} ELSE 0.0D END AS {m}_std_30d",
                    f"coalesce(CAST(_cur_{m} AS DOUBLE), 0.0D) - coalesce(_a7_{m}, 0.0D) AS {m}_delta_vs_7d",
                    f"CASE WHEN _cur_{m} > _prev_{m} THEN 1 ELSE 0 END AS {m}_is_increasing"]
    grouped = numbered.groupBy("drive_id").agg(F.min("day").alias("_first"), *[F.expr(e) for e in stats])
    current = grouped.selectExpr("drive_id", "_first", *derived)
    ordered = [f"{m}_{s}" for m in metrics for s in STATS]
    out = current.select(
        "drive_id", d.alias("day"),
        clamped_age_days("_first", d).alias("age_days"),
        *ordered,
    )
    if drives is not None:
        cap = drives.select("drive_id", "capacity_bytes")
        out = out.join(cap, "drive_id", "left")
    else:
        out = out.withColumn("capacity_bytes", F.lit(None).cast("bigint"))
    return out.select("drive_id", "day",
                      F.coalesce(F.col("capacity_bytes"), F.lit(0)).cast("bigint").alias("capacity_bytes"),
                      "age_days", *ordered)
