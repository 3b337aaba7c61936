"""Fleet read queries, including the reference's service test expectation (120/110/17)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlens.operators import fleet as FL

DAY = dt.date(2026, 2, 22)


@pytest.fixture(scope="module")
def fleet(spark):
    drives = spark.createDataFrame([(f"drive-{i:03d}", "M", 10**12, "dc", DAY, DAY) for i in range(120)],
                                   "drive_id string, model string, capacity_bytes bigint, datacenter string, "
                                   "first_seen date, last_seen date")
    buckets = ["LOW"] * 71 + ["MED"] * 22 + ["HIGH"] * 17
    preds = spark.createDataFrame(
        [(f"drive-{i:03d}", DAY, "v1", {"LOW": 0.1, "MED": 0.5, "HIGH": 0.9}[b], b,
          dt.datetime(2026, 2, 22, 3)) for i, b in enumerate(buckets)],
        "drive_id string, day date, model_version string, risk_score double, risk_bucket string, scored_at timestamp_ntz")
    return drives, preds


def test_summary_counts(fleet):
    drives, preds = fleet
    r = FL.fleet_summary(drives, preds).first()
    assert (r["day"], r["total_drives"], r["drives_scored"], r["predicted_failures"]) == (DAY, 120, 110, 17)
    assert (r["low"], r["med"], r["high"]) == (71, 22, 17)
    assert r["high_risk_rate"] == round(17 / 110 * 100, 1)


def test_summary_without_predictions(spark, fleet):
    drives, preds = fleet
    r = FL.fleet_summary(drives, preds.limit(0)).first()
    assert r["day"] is None and r["total_drives"] == 120 and r["drives_scored"] == 0 and r["high_risk_rate"] == 0.0


def test_list_drives_page_and_filter(fleet):
    drives, preds = fleet
    page = FL.list_drives(drives, preds, "high", page=1, page_size=10).collect()
    assert len(page) == 10 and page[0]["total"] == 17
    assert all(r["latest_risk_bucket"] == "HIGH" for r in page)
    last = FL.list_drives(drives, preds, None, page=5, page_size=25).collect()
    assert [r["drive_id"] for r in last][0] == "drive-100" and len(last) == 20
    assert sum(r["latest_day"] is None for r in last) == 10


def test_page_validation(fleet):
    drives, preds = fleet
    with pytest.raises(ValueError):
        FL.list_drives(drives, preds, page=0)
    with pytest.raises(ValueError):
        FL.list_drives(drives, preds, page_size=201)
    with pytest.raises(ValueError):
        FL.list_drives(drives, preds, risk="urgent")


def test_unknown_drive(spark, fleet):
    drives, preds = fleet
    with pytest.raises(LookupError):
        FL.drive_detail(drives, preds.select("drive_id", "day"), preds, "nope")


def test_detail_history_oldest(spark, fleet):
    drives, preds = fleet
    tel = spark.range(100).select(F.lit("drive-001").alias("drive_id"),
                                  F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("day"))
    d = FL.drive_detail(drives, tel, preds, "drive-001")
    days = [r["day"] for r in d.telemetry_trend.orderBy("day").collect()]
    assert len(days) == 60 and days[0] == DAY


def test_day_validation(fleet):
    drives, preds = fleet
    with pytest.raises(ValueError):
        FL.fleet_summary(drives, preds, day="2026/02/22")
    assert FL.fleet_summary(drives, preds, day="2026-02-22").first()["drives_scored"] == 110


def test_match_latest_vs_any(spark, fleet):
    drives, _ = fleet
    preds = spark.createDataFrame(
        [("drive-000", DAY, "v1", 0.9, "HIGH", dt.datetime(2026, 2, 22, 1)),
         ("drive-000", DAY + dt.timedelta(days=1), "v1", 0.1, "LOW", dt.datetime(2026, 2, 23, 1)),
         ("drive-001", DAY, "v1", 0.9, "HIGH", dt.datetime(2026, 2, 22, 1))],
        "drive_id string, day date, model_version string, risk_score double, risk_bucket string, scored_at timestamp_ntz")
    anyb = {r["drive_id"] for r in FL.drives_with_bucket(drives, preds, "HIGH", "any").collect()}
    latest = {r["drive_id"] for r in FL.drives_with_bucket(drives, preds, "HIGH", "latest").collect()}
    assert anyb == {"drive-000", "drive-001"} and latest == {"drive-001"}


def test_history_latest_order(spark, fleet):
    tel = spark.range(100).select(F.lit("d").alias("drive_id"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("day"))
    got = [r["day"] for r in FL.drive_history(tel, 60, "latest").orderBy("day").collect()]
    assert len(got) == 60 and got[-1] == DAY + dt.timedelta(days=99)
