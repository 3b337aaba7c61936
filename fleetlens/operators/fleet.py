"""Fleet read queries: summary, drive list, latest prediction, drive history."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlens.functions.risk import percent_1dp, safe_ratio
from fleetlens.operators.windows import head_rows
from fleetlens.schema import MAX_PAGE_SIZE, RISK_BUCKETS

LATEST_ORDER = ["day", "scored_at", "model_version"]


def _day(day) -> Column:
    return day if isinstance(day, Column) else F.lit(day).cast("date")


def validate_page(page: int, page_size: int) -> None:
    if type(page) is not int or page < 1:  # a bool is no page
        raise ValueError("page must be an integer >= 1")
    if type(page_size) is not int or not 1 <= page_size <= MAX_PAGE_SIZE:
        raise ValueError(f"page_size must be between 1 and {MAX_PAGE_SIZE}")


def validate_day(day):
    """A job's day parameter: a date, or ISO 'YYYY-MM-DD' text; anything else is rejected."""
    import datetime as dt
    if day is None or isinstance(day, Column):
        return day
    if isinstance(day, dt.datetime):
        return day.date()
    if isinstance(day, dt.date):
        return day
    try:
        if not re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", str(day)):  # no week dates, no compact form
            raise ValueError
        return dt.date.fromisoformat(str(day))
    except ValueError:
        raise ValueError(f"day must be an ISO date (YYYY-MM-DD), got {day!r}") from None


def validate_risk(risk: str | None) -> str | None:
    if risk is None:
        return None
    # lower case only, as callers of the list must send it
    if risk != risk.lower() or risk.upper() not in RISK_BUCKETS:
        raise ValueError("risk must be one of low, med, high")
    return risk.upper()


def latest_prediction(predictions: DataFrame, key: str = "drive_id",
                      order: list[str] = LATEST_ORDER) -> DataFrame:
    """Each drive's latest prediction by (day, scored_at, model_version) descending.

    ``max_by`` is an aggregate, so Spark combines map-side before the shuffle:
    a drive with very many predictions never lands in one task as a whole.
    """
    payload = [c for c in predictions.columns if c != key]
    g = predictions.groupBy(key).agg(
        F.max_by(F.struct(*payload), F.struct(*order)).alias("_p"))
    return g.select(key, *[F.col(f"_p.{c}").alias(c) for c in payload])


def drives_with_bucket(drives: DataFrame, predictions: DataFrame, bucket: str, match: str = "any",
                       key: str = "drive_id") -> DataFrame:
    """Drives with a prediction in ``bucket``: on any day/version (``any``) or in the latest one."""
    if match == "latest":
        p = latest_prediction(predictions.select(key, "risk_bucket", *LATEST_ORDER), key)
    elif match == "any":
        p = predictions
    else:
        raise ValueError("match must be 'any' or 'latest'")
    return drives.join(p.where(F.col("risk_bucket") == bucket).select(key), key, "left_semi")


def _page(page_rows: DataFrame, predictions: DataFrame, page: int, page_size: int, total: int | None,
          latest: DataFrame | None) -> DataFrame:
    """The rows of a page (<= 200, broadcast), each with its latest prediction."""
    wanted = ["drive_id", "day", "scored_at", "model_version", "risk_score", "risk_bucket"]
    if latest is None:
        # only the page's drives have their latest prediction computed
        latest = latest_prediction(predictions.select(*wanted).join(F.broadcast(page_rows.select("drive_id")), "drive_id", "left_semi"))
    out = F.broadcast(page_rows).join(latest.select(*wanted), "drive_id", "left").select(
        "drive_id", "model", "datacenter",
        F.coalesce(F.col("capacity_bytes"), F.lit(0)).cast("bigint").alias("capacity_bytes"),
        "first_seen", "last_seen",
        F.col("day").alias("latest_day"), F.col("risk_score").alias("latest_risk_score"),
        F.col("risk_bucket").alias("latest_risk_bucket"), F.col("model_version").alias("latest_model_version"),
        F.lit(page).alias("page"), F.lit(page_size).alias("page_size"))
    return out if total is None else out.withColumn("total", F.lit(total).cast("bigint"))


def list_drives(drives: DataFrame, predictions: DataFrame, risk: str | None = None, page: int = 1,
                page_size: int = 25, match: str = "any", with_total: bool = True, after: str | None = None,
                latest: DataFrame | None = None) -> DataFrame:
    """One page of drives ordered by id, each with its latest prediction (null if never scored).

    The page is a bounded top-k (``offset + limit`` after ``orderBy``), then
    only that page is joined to the latest predictions.  ``total`` (rows
    matching the filter) is a count by contract.  For pages far behind, either give ``after``,
    the last id of the page before (a seek: the top-k is one page, whatever its number), or use
    ``DrivePages``.  ``latest`` is a kept table of latest predictions to read instead of the history.
    """
    validate_page(page, page_size)
    risk = validate_risk(risk)
    base = drives if risk is None else drives_with_bucket(drives, predictions, risk, match)
    if after is not None:
        page_rows = base.where(F.col("drive_id") > after).orderBy("drive_id").limit(page_size)
    else:
        page_rows = base.orderBy("drive_id").offset((page - 1) * page_size).limit(page_size)
    return _page(page_rows, predictions, page, page_size, base.count() if with_total else None, latest)


class DrivePages:
    """An order-statistic index of the drives: id ranges in folders of their own, and their row counts.

    A page number becomes an offset, the counts tell which range holds it, and only that
    range (two at a border) is read and sorted.  The driver holds a number per range.
    """

    def __init__(self, spark: SparkSession, path: str, schema):
        from pyspark.sql import types as T
        self.drives = spark.read.schema(T.StructType([*schema.fields, T.StructField("range", T.IntegerType())])).parquet(path)
        self.counts = self._counted(self.drives)

    @classmethod
    def build(cls, drives: DataFrame, path: str, ranges: int) -> DrivePages:
        """Write the drives by range (null ids first), at most ``ranges`` of them, of about equal size."""
        placed = drives.repartitionByRange(ranges, "drive_id").withColumn("range", F.spark_partition_id())
        placed.sortWithinPartitions("range", "drive_id").write.partitionBy("range").parquet(path)
        return cls(drives.sparkSession, path, drives.schema)

    @staticmethod
    def _counted(rows: DataFrame) -> list[tuple[int, int]]:
        return sorted((r["range"], r["count"]) for r in rows.groupBy("range").count().collect())

    def locate(self, counts: list[tuple[int, int]], offset: int, size: int) -> tuple[list[int], int]:
        """The ranges that rows offset to offset + size lie in, and the rows of them that come before."""
        found, skip, seen = [], 0, 0
        for at, n in counts:
            if seen + n > offset and seen < offset + size:
                skip = skip if found else offset - seen
                found.append(at)
            seen += n
        return found, skip

    def page(self, predictions: DataFrame, risk: str | None = None, page: int = 1, page_size: int = 25, match: str = "any",
             latest: DataFrame | None = None) -> DataFrame:
        """The same rows as ``list_drives``."""
        validate_page(page, page_size)
        risk = validate_risk(risk)
        base, counts = self.drives, self.counts
        if risk is not None:
            base = drives_with_bucket(base, predictions, risk, match)
            counts = self._counted(base)
        at, skip = self.locate(counts, (page - 1) * page_size, page_size)
        rows = base.where(F.col("range").isin(at)).orderBy("drive_id").offset(skip).limit(page_size).drop("range")
        return _page(rows, predictions, page, page_size, sum(n for _, n in counts), latest)


def top_risk_drives(predictions: DataFrame, day, k: int = 10) -> DataFrame:
    """The ``k`` highest scores of a day (ties by drive id); a bounded top-k."""
    return (predictions.where(F.col("day") == _day(day))
            .orderBy(F.col("risk_score").desc(), F.col("drive_id").asc()).limit(k))


def drive_history(df: DataFrame, n: int = 60, order: str = "oldest", key: str = "drive_id",
                  day_col: str = "day", tiebreak: list[str] | None = None) -> DataFrame:
    """First ``n`` rows per drive by day (``oldest``, as the reference does) or the last ``n`` (``latest``)."""
    if order not in ("oldest", "latest"):
        raise ValueError("order must be 'oldest' or 'latest'")
    d = F.col(day_col).asc() if order == "oldest" else F.col(day_col).desc()
    extra = [F.col(c).asc() if order == "oldest" else F.col(c).desc() for c in (tiebreak or [])]
    return head_rows(df, key, [d, *extra], n)


def fleet_summary(drives: DataFrame, predictions: DataFrame, day=None,
                  model_version: str | None = None) -> DataFrame:
    """One row: day, total_drives, drives_scored, predicted_failures, low/med/high, high_risk_rate.

    ``day=None`` uses the latest prediction day.  Counts of a day include every
    model version unless ``model_version`` is given (the reference counts all).
    Built as one aggregate over predictions and one over drives, merged by a
    union + global aggregate (no join of the two).
    """
    day = validate_day(day)
    p = predictions
    if model_version is not None:
        p = p.where(F.col("model_version") == model_version)
    if day is None:
        last = predictions.agg(F.max("day").alias("_summary_day"))
        # a one-row side: broadcast equi-join on the day
        p = p.join(F.broadcast(last), F.col("day") == F.col("_summary_day"))
        day_col = F.col("_summary_day")
    else:
        p = p.where(F.col("day") == _day(day))
        day_col = _day(day)
    b = F.col("risk_bucket")
    pa = p.agg(
        F.max(day_col).alias("day"),
        F.count(F.lit(1)).alias("drives_scored"),
        F.count_if(b == "HIGH").alias("predicted_failures"),
        F.count_if(b == "LOW").alias("low"),
        F.count_if(b == "MED").alias("med"),
        F.count_if(b == "HIGH").alias("high"),
    ).withColumn("total_drives", F.lit(None).cast("bigint"))
    da = drives.agg(F.count(F.lit(1)).alias("total_drives"))
    merged = pa.unionByName(da, allowMissingColumns=True).agg(
        F.max("day").alias("day"),
        F.coalesce(F.max("total_drives"), F.lit(0)).cast("bigint").alias("total_drives"),
        F.coalesce(F.max("drives_scored"), F.lit(0)).cast("bigint").alias("drives_scored"),
        F.coalesce(F.max("predicted_failures"), F.lit(0)).cast("bigint").alias("predicted_failures"),
        F.coalesce(F.max("low"), F.lit(0)).cast("bigint").alias("low"),
        F.coalesce(F.max("med"), F.lit(0)).cast("bigint").alias("med"),
        F.coalesce(F.max("high"), F.lit(0)).cast("bigint").alias("high"),
    )
    return merged.withColumn("high_risk_rate",
                             percent_1dp(safe_ratio(F.col("high"), F.col("drives_scored"))))


def bucket_distribution(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Count per bucket with zero fill, one row per ``by`` group (or one row overall)."""
    b = F.col("risk_bucket")
    aggs = [F.count_if(b == "LOW").cast("bigint").alias("low"),
            F.count_if(b == "MED").cast("bigint").alias("med"),
            F.count_if(b == "HIGH").cast("bigint").alias("high")]
    return predictions.groupBy(*(by or [])).agg(*aggs)


def capacity_lookup(rows: DataFrame, drives: DataFrame, key: str = "drive_id") -> DataFrame:
    """Capacity per drive id of ``rows`` (left join on the drives table; unknown -> 0)."""
    ids = rows.select(key).distinct()
    return ids.join(drives.select(key, "capacity_bytes"), key, "left").select(
        key, F.coalesce(F.col("capacity_bytes"), F.lit(0)).cast("bigint").alias("capacity_bytes"))


@dataclass
class DriveDetail:
    drive: DataFrame
    telemetry_trend: DataFrame
    risk_history: DataFrame
    top_reasons: DataFrame


def drive_detail(drives: DataFrame, telemetry: DataFrame, predictions: DataFrame, drive_id: str,
                 n: int = 60, order: str = "oldest") -> DriveDetail:
    """Attributes, telemetry trend, risk history and reasons of the last history row; unknown id -> error."""
    d = drives.where(F.col("drive_id") == drive_id)
    if d.isEmpty():
        raise LookupError(f"Drive {drive_id} not found")
    tel = drive_history(telemetry.where(F.col("drive_id") == drive_id), n, order)
    hist = drive_history(predictions.where(F.col("drive_id") == drive_id), n, order,
                         tiebreak=["scored_at", "model_version"])
    last = latest_prediction(hist) if "reason_codes" in predictions.columns else None
    reasons = (last.select("drive_id", F.posexplode("reason_codes").alias("rank", "reason"))
               .select("drive_id", (F.col("rank") + 1).alias("rank"), "reason.*")
               if last is not None else None)
    return DriveDetail(
        drive=d.select("drive_id", "model", "datacenter",
                       F.coalesce(F.col("capacity_bytes"), F.lit(0)).cast("bigint").alias("capacity_bytes"),
                       "first_seen", "last_seen"),
        telemetry_trend=tel, risk_history=hist, top_reasons=reasons)
