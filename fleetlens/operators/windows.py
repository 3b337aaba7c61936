"""Per-drive window operators.

All windows partition by drive and order by day, with ROWS frames: a gap in
telemetry stretches the "7d" window over more than seven calendar days, as in
the reference.  Every expression shares one partition/order spec, so Spark
plans a single hash exchange on the drive key and a single sort; frames only
split the Window operators, not the shuffle.

Scale: each drive contributes at most one row per day of history, so a window
partition is bounded by the number of days covered (about 4.4k rows for 12
years), independent of fleet size.  Spark's window operator spills beyond
memory anyway.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.schema import METRICS, STATS

LOOKBACK_ROWS = 29  # the widest frame is the current row and the 29 rows before it
ROLLED = [s for s in STATS if s != "delta_vs_7d"]


def window_sql(key="serial_number", order: str = "as_of_date", tiebreak: list[str] | None = None,
               frame: str | None = None) -> str:
    """The drive window as SQL text (one parse on the JVM instead of many Column calls).
    ``key`` is a column name or a list of them."""
    keys = [key] if isinstance(key, str) else list(key)
    ords = ", ".join([f"`{order}`"] + [f"`{c}` ASC NULLS FIRST" for c in (tiebreak or [])])
    return f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} ORDER BY {ords}" + (f" {frame}" if frame else "")


def _rows(n: int) -> str:
    return f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW"


def metric_stat_sql(metric: str, stat: str, key: str = "serial_number", order: str = "as_of_date",
                    tiebreak: list[str] | None = None) -> str:
    m = f"`{metric}`"
    if stat == "mean_7d":
        return f"avg({m}) OVER ({window_sql(key, order, tiebreak, _rows(7))})"
    if stat == "mean_30d":
        return f"avg({m}) OVER ({window_sql(key, order, tiebreak, _rows(30))})"
    if stat == "std_30d":
        return f"stddev_pop({m}) OVER ({window_sql(key, order, tiebreak, _rows(30))})"
    if stat == "delta_vs_7d":
        return f"{m} - avg({m}) OVER ({window_sql(key, order, tiebreak, _rows(7))})"
    if stat == "is_increasing":
        return f"CASE WHEN {m} > lag({m}) OVER ({window_sql(key, order, tiebreak)}) THEN 1 ELSE 0 END"
    raise ValueError(f"unknown stat {stat}")


def rolling_feature_columns(metrics: list[str] = METRICS, key: str = "serial_number", order: str = "as_of_date",
                            stats: list[str] = STATS, tiebreak: list[str] | None = None) -> list[Column]:
    """All metric statistics (stat-major order), aliased ``<metric>_<stat>``."""
    return [F.expr(f"{metric_stat_sql(m, s, key, order, tiebreak)} AS `{m}_{s}`") for s in stats for m in metrics]


def rolled(rows: DataFrame, key: list[str], order: list[str], metrics: list[str] = METRICS,
           distinct: bool = False, never_null: tuple[str, ...] = ()) -> DataFrame:
    """``rows``, placed by a part of ``key``, with the rolling means, deviation and rise of every metric.

    The values of ``metric_stat_sql`` (all but the difference to the mean), added up in the
    same order.  Sliding frames go over up to 30 rows for each row and statistic; here tasks get
    their sorted rows as Arrow batches, and a step adds one row of the frame for all rows of a
    batch.  The last 29 rows go on to the next batch, so a drive of any length takes the memory of one.
    ``distinct`` drops rows that equal the row before in ``key`` and ``order``, first of all.
    ``never_null`` names columns that the caller knows to hold no null, which the result's schema then says.
    """
    names = [f"{m}_{s}" for s in ROLLED for m in metrics]
    types = ["int" if s == "is_increasing" else "double" for s in ROLLED for _ in metrics]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}{' NOT NULL' if f.name in never_null else ''}" for f in rows.schema]
                       + [f"`{n}` {t}" for n, t in zip(names, types)])

    def roll(batches):
        import pyarrow as pa

        held = last = None
        for batch in batches:
            if distinct and batch.num_rows:
                batch, last = _without_copies(batch, last, [*key, *order])
            if not batch.num_rows:
                continue
            now = batch.select([*key, *metrics])
            with_held = pa.Table.from_batches([now] if held is None else [held, now]).combine_chunks().to_batches()[0]
            found = _rolled_batch(with_held, key, metrics, with_held.num_rows - batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, *names])
            held = with_held.slice(max(with_held.num_rows - LOOKBACK_ROWS, 0))

    ordered = rows.sortWithinPartitions(*key, F.col(order[0]), *[F.col(c).asc_nulls_first() for c in order[1:]])
    return ordered.mapInArrow(roll, schema)


def _without_copies(batch, last, columns: list[str]):
    """The rows that differ from the row before in one of ``columns`` (null equals null, NaN equals NaN), and the last row.

    ``last`` is the row before the batch, if there is one.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    rows = batch.select(columns)
    n = batch.num_rows
    both = pa.Table.from_batches([rows] if last is None else [last, rows]).combine_chunks().to_batches()[0]
    copy = np.ones(both.num_rows - 1, bool)
    for c in both.columns:
        here, before = c.slice(1), c.slice(0, both.num_rows - 1)
        same = pc.equal(here, before)
        if pa.types.is_floating(c.type):
            same = pc.or_(same, pc.and_(pc.is_nan(here), pc.is_nan(before)))
        same = pc.if_else(pc.is_valid(same), same, pc.and_(pc.is_null(here), pc.is_null(before)))
        copy &= same.to_numpy(zero_copy_only=False)
        if not copy.any():
            break
    else:
        kept = ~copy if last is not None else np.concatenate([[True], ~copy])
        batch = batch.filter(pa.array(kept))
    return batch, rows.slice(n - 1)


def _rolled_batch(batch, key: list[str], metrics: list[str], skip: int) -> list:
    """The statistics of the rows after the first ``skip`` ones, an Arrow array each, in the order of ``ROLLED``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    n = batch.num_rows
    starts = np.ones(n, bool)
    starts[1:] = False
    for c in key:
        column = batch.column(c)
        starts[1:] |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    since = (np.arange(n) - np.maximum.accumulate(np.where(starts, np.arange(n), 0)))[skip:]  # rows of the drive before
    # masks are words of ones or noughts: a double and its mask is the double or 0.0, whatever it was (NaN too)
    reach = [-(since >= back).astype(np.int64) for back in range(LOOKBACK_ROWS + 1)]
    one = np.ones(1).view(np.int64)[0]
    pad = LOOKBACK_ROWS - min(skip, LOOKBACK_ROWS)
    own = slice(skip + pad, n + pad)
    x, held, out = np.zeros(n + pad), np.zeros(n + pad, np.int64), {}
    nothing = {s: pa.array(np.zeros(n - skip, np.int32)) if s == "is_increasing" else pa.nulls(n - skip, pa.float64()) for s in ROLLED}
    for m in metrics:
        column = batch.column(m)
        if column.null_count == n:
            out[m] = nothing
            continue
        np.negative(column.is_valid().to_numpy(zero_copy_only=False), out=held[pad:], dtype=np.int64)
        x[pad:] = pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False)
        n7, n30, sum7, sum30, mean, spread = (np.zeros(n - skip) for _ in range(6))
        value, counted, delta, part = (np.empty(n - skip) for _ in range(4))
        inside = np.empty(n - skip, np.int64)
        with np.errstate(all="ignore"):
            for back in range(LOOKBACK_ROWS, -1, -1):
                span = slice(own.start - back, own.stop - back)
                np.bitwise_and(held[span], reach[back], out=inside)
                np.bitwise_and(x[span].view(np.int64), inside, out=value.view(np.int64))
                np.bitwise_and(inside, one, out=counted.view(np.int64))
                n30 += counted
                sum30 += value
                if back < 7:
                    n7 += counted
                    sum7 += value
                # Spark's own update of a deviation; rows outside change nothing
                np.subtract(value, mean, out=delta)
                np.bitwise_and(delta.view(np.int64), inside, out=delta.view(np.int64))
                np.divide(delta, np.maximum(n30, 1.0, out=part), out=part)
                mean += part
                np.subtract(delta, part, out=part)
                part *= delta
                spread += part
            before = slice(own.start - 1, own.stop - 1)
            rises = (x[own] > x[before]) | (np.isnan(x[own]) & ~np.isnan(x[before]))
            rises &= (held[own] & held[before] & reach[1]) != 0
            out[m] = {"mean_7d": pa.array(sum7 / n7, mask=n7 == 0), "mean_30d": pa.array(sum30 / n30, mask=n30 == 0),
                      "std_30d": pa.array(np.sqrt(spread / n30), mask=n30 == 0), "is_increasing": pa.array(rises.astype(np.int32))}
    return [out[m][s] for s in ROLLED for m in metrics]


def with_first_days(df: DataFrame, key: str = "serial_number", order: str = "as_of_date",
                    failure: str = "failure") -> DataFrame:
    """``df`` plus ``first_seen`` and ``first_failure`` of each row's drive (whole history; looks ahead).

    Two minima per drive, combined map-side, are joined back: a drive with very many rows
    is a skewed join side, which AQE splits, not a window partition.
    """
    firsts = df.groupBy(key).agg(F.min(order).alias("first_seen"),
                                 F.min(F.when(F.col(failure) == 1, F.col(order))).alias("first_failure"))
    return df.join(firsts, key, "left")


def label_within(day: Column, failure_day: Column, horizon_days: int) -> Column:
    """1 if the first failure is strictly after ``day`` and at most ``horizon_days`` later, else 0."""
    hit = (failure_day > day) & (failure_day <= F.date_add(day, horizon_days))
    return F.when(hit, 1).otherwise(0)


def head_rows(df: DataFrame, key: str, order: list[Column], n: int, rank_col: str = "_rn") -> DataFrame:
    """First ``n`` rows per key (row_number <= n; Spark plans a WindowGroupLimit before the shuffle)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n).drop(rank_col)
