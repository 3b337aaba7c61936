"""Distributed evaluation metrics (E1-E5): no score array ever reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fleetlens.operators.histogram import leaves, slim, top_cuts
from fleetlens.operators.rank import distributed_rank

#: Most rows of a range of several scores that one task of the average precision cumulates.
LEAF_ROWS = 1_000_000

# Calibration bins are 10 equal-width bins on [0, 1] whose edges
# are computed as i * 0.1 (so edge 3 is 0.30000000000000004); the last bin is closed.
CALIBRATION_BINS = 10


def calibration_edges(bins: int = CALIBRATION_BINS) -> list[float]:
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def _one_row(spark: SparkSession, **values) -> DataFrame:
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])


def average_precision(df: DataFrame, y: str = "y", score: str = "score", leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """One row ``average_precision``: sum over distinct thresholds (descending) of dRecall x Precision.

    A histogram of the score's bits gives the rows and positives above each range of scores;
    inside a range the distinct scores (collapsed map-side) are cumulated by a window of its
    own.  A range with many rows is divided further, a score that many rows share is one row.
    No positives -> 0.  The passes run when this is called.
    """
    with slim(df, y, score) as rows:
        found = leaves(rows, leaf_rows)
        if not found.hits:
            return _one_row(df.sparkSession, average_precision=0.0)
        above = df.sparkSession.createDataFrame(found.above, "_size int, _cell long, _rows long, _hits long")
        size, cell = found.columns()
        g = rows.groupBy("_bits").agg(F.sum("_hit").alias("tp"), F.count(F.lit(1)).alias("cnt"))
        inside = Window.partitionBy("_size", "_cell").orderBy(F.col("_bits").desc())
        c = g.select("*", size.alias("_size"), cell.alias("_cell")).join(F.broadcast(above), ["_size", "_cell"])
        c = c.select("tp", (F.col("_hits") + F.sum("tp").over(inside)).alias("cum_tp"), (F.col("_rows") + F.sum("cnt").over(inside)).alias("cum_cnt"))
        value = c.agg(F.sum(F.col("tp") * F.col("cum_tp") / F.col("cum_cnt"))).first()[0] / found.hits
    return _one_row(df.sparkSession, average_precision=float(value))


def brier_score(df: DataFrame, y: str = "y", score: str = "score") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(y).cast("double"), 2)).alias("brier_score"))


def recalls_at_top(df: DataFrame, fractions: list[float], y: str = "y", score: str = "score",
                   key: str | list[str] | None = None, n: int | None = None) -> list[tuple[float, int]]:
    """(recall, k) for each fraction: the share of all positives in the top k = max(1, int(n * fraction)) scores.

    The k-th score comes from a refined histogram, shared by all fractions; only rows that tie
    with it, are taken in part and differ in ``y`` are ranked by the key.  Without a key the
    negatives among those ties come first.  Empty input or no positives -> 0.
    """
    keys = [key] if isinstance(key, str) else list(key or [])
    with slim(df, y, score, keys) as rows:
        _, positives, cuts = top_cuts(rows, lambda found: [max(1, int((found if n is None else n) * f)) for f in fractions])
        out = []
        for cut in cuts:
            if cut.ties_hits in (0, cut.ties) or cut.rest == cut.ties:
                hits = min(cut.rest, cut.ties_hits)
            elif not keys:
                hits = max(0, cut.rest - (cut.ties - cut.ties_hits))
            else:
                ranked = distributed_rank(rows.where(F.col("_bits") == cut.bits).select("_hit", *keys), [(k, True) for k in keys], "_rank")
                hits = ranked.where((F.col("_rank") <= cut.rest) & (F.col("_hit") == 1)).count()
            out.append(((cut.above_hits + hits) / positives if positives else 0.0, cut.k))
    return out


def recall_at_top(df: DataFrame, fraction: float, y: str = "y", score: str = "score",
                  key: str | list[str] | None = None, n: int | None = None) -> DataFrame:
    """``recalls_at_top`` for one fraction, as a row (recall, k)."""
    (recall, k), = recalls_at_top(df, [fraction], y, score, key, n)
    return df.sparkSession.range(1).select(F.lit(float(recall)).alias("recall"), F.lit(k).cast("bigint").alias("k"))


def calibration_bin(score: str = "score", bins: int = CALIBRATION_BINS):
    e = calibration_edges(bins)
    s = F.col(score)
    expr = None
    for i in range(bins):
        cond = (s >= F.lit(e[i])) & ((s <= F.lit(e[i + 1])) if i == bins - 1 else (s < F.lit(e[i + 1])))
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr


def calibration_bins(df: DataFrame, y: str = "y", score: str = "score", bins: int = CALIBRATION_BINS) -> DataFrame:
    """Non-empty bins: bin, bin_left, bin_right, predicted_mean, observed_rate, count."""
    e = calibration_edges(bins)
    b = df.select(calibration_bin(score, bins).alias("bin"), score, y).where(F.col("bin").isNotNull())
    g = b.groupBy("bin").agg(F.avg(score).alias("predicted_mean"), F.avg(F.col(y).cast("double")).alias(
        "observed_rate"), F.count(F.lit(1)).alias("count"))
    left = F.element_at(F.array(*[F.lit(x) for x in e[:-1]]), F.col("bin") + 1)
    right = F.element_at(F.array(*[F.lit(x) for x in e[1:]]), F.col("bin") + 1)
    return g.select("bin", left.alias("bin_left"), right.alias("bin_right"), "predicted_mean",
                    "observed_rate", "count")


def eval_summary(df: DataFrame, y: str = "y") -> DataFrame:
    """test_rows and positive_rate_test."""
    return df.agg(F.count(F.lit(1)).alias("test_rows"),
                  F.coalesce(F.avg(F.col(y).cast("double")), F.lit(0.0)).alias("positive_rate_test"))
