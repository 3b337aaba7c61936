"""Risk buckets and the operational rank fallback."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fleetlens.operators.rank import distributed_rank
from fleetlens.schema import (FALLBACK_HIGH_MIN_N, FALLBACK_HIGH_SHARE, FALLBACK_MED_MIN_N, FALLBACK_MED_SHARE,
                              FALLBACK_SCORE_RANGES)


def risk_rank(scores: DataFrame, batch: str = "day", key: str = "drive_id", score: str = "risk_score",
              rank_col: str = "risk_rank") -> DataFrame:
    """Rank per batch by score descending, drive id ascending (binary order)."""
    return distributed_rank(scores, [(score, False), (key, True)], rank_col, partition_by=batch)


def fallback_sizes(n: Column) -> tuple[Column, Column]:
    """(HIGH, MED) sizes for a batch of ``n`` all-LOW scores."""
    high = F.when(n >= FALLBACK_HIGH_MIN_N, F.ceil(n * F.lit(FALLBACK_HIGH_SHARE))).otherwise(
        F.least(F.lit(1), n)).cast("bigint")
    med = F.when(n >= FALLBACK_MED_MIN_N, F.ceil(n * F.lit(FALLBACK_MED_SHARE))).otherwise(
        F.least(F.lit(1), F.greatest(F.lit(0), n - high))).cast("bigint")
    return high, med


def _linear_score(bucket: Column, pos: Column, size: Column) -> Column:
    size = F.greatest(F.lit(1), size)
    t = F.when(size == 1, F.lit(0.5)).otherwise(pos.cast("double") / (size - 1).cast("double"))

    def hi_lo(b: str) -> tuple[Column, Column]:
        hi, lo = FALLBACK_SCORE_RANGES[b]
        return F.lit(hi), F.lit(lo)

    hi = F.when(bucket == "HIGH", hi_lo("HIGH")[0]).when(bucket == "MED", hi_lo("MED")[0]).otherwise(
        hi_lo("LOW")[0])
    lo = F.when(bucket == "HIGH", hi_lo("HIGH")[1]).when(bucket == "MED", hi_lo("MED")[1]).otherwise(
        hi_lo("LOW")[1])
    return F.round(hi - (hi - lo) * t, 6)


def rank_fallback(scores: DataFrame, batch: str = "day", key: str = "drive_id",
                  score: str = "risk_score", bucket: str = "risk_bucket") -> DataFrame:
    """Re-bucket batches where the model called every row LOW.

    A null batch is a batch of its own.  Only batches with no MED/HIGH row change: rows are ranked by score (desc,
    id asc); the top ceil(5%) become HIGH and the next ceil(15%) MED (small
    batches get at most one of each) and scores are spread linearly inside the
    bucket.  Other batches pass through.  Adds ``model_score`` (the raw score)
    and ``bucket_mode`` ('model' or 'rank_fallback').
    """
    stats = scores.groupBy(batch).agg(
        F.count(F.lit(1)).alias("_n"),
        F.max(F.when(F.col(bucket).isin("MED", "HIGH"), 1).otherwise(0)).alias("_mh"))
    passthrough = scores.select(*scores.columns, F.col(score).alias("model_score"),
                                F.lit("model").alias("bucket_mode"))
    # one row per batch (day): small by construction, so it is looked at once and sent back as a table
    batches = stats.collect()
    all_low = [(r[batch], r["_n"]) for r in batches if r["_mh"] == 0]
    if not all_low:
        return passthrough
    of = scores.sparkSession.createDataFrame(all_low, T.StructType([
        T.StructField("_of", scores.schema[batch].dataType), T.StructField("_n", T.LongType())]))
    low = scores.join(F.broadcast(of), scores[batch].eqNullSafe(of["_of"])).drop("_of")
    others = scores.join(F.broadcast(of), scores[batch].eqNullSafe(of["_of"]), "left_anti")
    keep = others.select(*scores.columns, F.col(score).alias("model_score"), F.lit("model").alias("bucket_mode"))
    ranked = distributed_rank(low, [(score, False), (key, True)], "_rank", partition_by=batch)
    n = F.col("_n")
    high, med = fallback_sizes(n)
    idx = F.col("_rank") - 1
    ranked = ranked.withColumns({"_hc": high, "_mc": med})
    hc, mc = F.col("_hc"), F.col("_mc")
    new_bucket = F.when(idx < hc, "HIGH").when(idx < hc + mc, "MED").otherwise("LOW")
    pos = F.when(idx < hc, idx).when(idx < hc + mc, idx - hc).otherwise(idx - hc - mc)
    size = F.when(idx < hc, hc).when(idx < hc + mc, mc).otherwise(F.greatest(F.lit(1), n - hc - mc))
    fb = ranked.withColumn("_b", new_bucket).select(
        *[c for c in scores.columns if c not in (score, bucket)],
        _linear_score(F.col("_b"), pos, size).alias(score), F.col("_b").alias(bucket),
        F.col(score).alias("model_score"), F.lit("rank_fallback").alias("bucket_mode"))
    fb = fb.select(*scores.columns, "model_score", "bucket_mode")
    return fb if len(all_low) == len(batches) else keep.unionByName(fb)
