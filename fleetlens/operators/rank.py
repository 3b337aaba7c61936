"""Distributed global rank and prefix sums.

``Window.orderBy(...)`` without a partition moves every row into one task.  Instead
Spark range-partitions the rows by the full composite sort key (so heavy ties on the
score are split by the tie-break key) and the placed rows are written once to the shared
checkpoint folder, each with its range number.  Ranges are ranked by partitioned windows
and shifted by the row counts of earlier ranges.  There is one path for every size, nulls
sort as Spark sorts them, and a task that is recomputed after an executor loss reads the
written ranges again, so counts and ranks always agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.session import scratch_path

Order = list[tuple[str, bool]]  # (column, ascending)


def _sort_cols(order: Order) -> list[Column]:
    return [F.col(c).asc() if asc else F.col(c).desc() for c, asc in order]


def with_range(df: DataFrame, order: Order, range_col: str = "_range") -> DataFrame:
    """``df`` written with the number of the range each row falls in; ranges follow ``order``."""
    spark = df.sparkSession
    placed = df.repartitionByRange(*_sort_cols(order)).withColumn(range_col, F.spark_partition_id())
    path = scratch_path(spark, "ranges")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def _with_offsets(ranged: DataFrame, sums: dict[str, Column], partition_by: str | None = None) -> DataFrame:
    """``ranged`` plus ``_off_<name>``: totals over all earlier ranges (of the same ``partition_by`` value).

    The totals have a row per range and value; a null value is a value of its own.
    """
    value = F.col(partition_by) if partition_by else F.lit(0)
    per = ranged.groupBy(F.col("_range").alias("_at"), value.alias("_of")).agg(*[v.alias(k) for k, v in sums.items()])
    earlier = Window.partitionBy("_of").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("_at", "_of", *[F.coalesce(F.sum(k).over(earlier), F.lit(0)).alias(f"_off_{k}") for k in sums])
    same = F.col("_range") == F.col("_at")
    if partition_by:
        same = same & ranged[partition_by].eqNullSafe(offsets["_of"])
    return ranged.join(offsets, same).drop("_at", "_of")


def distributed_rank(df: DataFrame, order: Order, rank_col: str = "rank", partition_by: str | None = None) -> DataFrame:
    """1-based row number in the total order ``order`` (add a unique last key for a stable result).

    With ``partition_by`` the rank restarts per value of that column (e.g. per day; null is
    a value) while still being computed over balanced ranges of the whole frame.  Only the
    columns of the order are placed in ranges and written, each distinct row of them once with
    its count; the ranks come back to the whole rows by these columns, so the bytes written do
    not depend on what else a row carries.
    """
    full: Order = ([(partition_by, True)] if partition_by else []) + [o for o in order if o[0] != partition_by]
    names = [c for c, _ in full]
    slim = df.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    ranged = _with_offsets(with_range(slim, full), {"n": F.sum("_n")}, partition_by)
    inside = Window.partitionBy("_range", *([partition_by] if partition_by else [])).orderBy(*_sort_cols(full)).rowsBetween(
        Window.unboundedPreceding, 0)
    before = ranged.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(names)],
                           (F.sum("_n").over(inside) - F.col("_n") + F.col("_off_n")).alias("_before"))
    same = [df[f"`{c}`"].eqNullSafe(before[f"_k{i}"]) for i, c in enumerate(names)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    # rows that agree in the whole order are numbered in the join's partitioning
    equal = Window.partitionBy(*[f"`{c}`" for c in names]).orderBy(F.lit(1))
    return df.join(before, on).select(*[df[f"`{c}`"] for c in df.columns],
                                      (F.row_number().over(equal) + F.col("_before")).cast("long").alias(rank_col))


def distributed_prefix_sum(df: DataFrame, order: Order, values: list[str], prefix: str = "cum_") -> DataFrame:
    """Running totals of ``values`` in the total order (inclusive of the current row)."""
    out = _with_offsets(with_range(df, order), {v: F.sum(v) for v in values})
    inside = Window.partitionBy("_range").orderBy(*_sort_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    return out.select(*df.columns, *[(F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.coalesce(F.col(f"_off_{v}"), F.lit(0)))
                                     .alias(f"{prefix}{v}") for v in values])
