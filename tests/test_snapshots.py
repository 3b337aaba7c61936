"""The snapshot log, the drive pages, the kept latest predictions and the Merkle hash."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from fleetlens.functions import casts as C
from fleetlens.operators import canonical as CA
from fleetlens.operators import fleet as FL
from fleetlens.operators import merge as MG
from fleetlens.sources.snapshots import Conflict, SnapshotLog

ROWS = "k string, day string, v int"


def rows(spark, *values):
    return spark.createDataFrame(list(values), ROWS).withColumn("day", F.col("day").cast("date"))


def seen(log, table, version=None):
    return sorted(tuple(map(str, r)) for r in log.read(table, version).select("k", "day", "v").collect())


def test_tables_change_together_or_not_at_all(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path))
    first = rows(spark, ("A", "2024-01-01", 1), ("B", "2024-01-02", 2), ("C", None, 3))

    def build(work):
        work.upsert("p", first, ["k", "day"], "day")
        work.append("audit", spark.range(1))

    assert log.publish("one", build) == 1
    before = seen(log, "p")
    assert len(before) == 3

    def dies(work):
        work.upsert("p", rows(spark, ("A", "2024-01-01", 9)), ["k", "day"], "day")
        work.append("audit", spark.range(5))
        raise InterruptedError

    with pytest.raises(InterruptedError):
        log.publish("two", dies)
    assert (log.version(), seen(log, "p"), log.read("audit").count()) == (1, before, 1)
    assert log.publish("one", dies) == 1  # a run that is in the log is not done again
    assert log.publish("two", lambda work: work.upsert("p", rows(spark, ("A", "2024-01-01", 9), ("C", None, 8)), ["k", "day"], "day")) == 2
    assert seen(log, "p") == [("A", "2024-01-01", "9"), ("B", "2024-01-02", "2"), ("C", "None", "8")]
    assert seen(log, "p", 1) == before  # an older version is as it was
    fresh = SnapshotLog(spark, str(tmp_path))
    assert seen(fresh, "p") == seen(log, "p")
    # the folder of the run that died goes, and versions beyond the kept ones
    gone = log.vacuum(keep=1, older_than_s=-5)
    assert len(gone) >= 3 and seen(log, "p") == seen(fresh, "p") and log.read("audit").count() == 1


def test_writers_of_other_partitions_both_win_and_of_the_same_conflict(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path))
    log.publish("base", lambda w: w.upsert("p", rows(spark, ("A", "2024-01-01", 1), ("B", "2024-01-02", 2)), ["k", "day"], "day"))
    one, two, three = log.begin("x1"), log.begin("x2"), log.begin("x3")
    one.upsert("p", rows(spark, ("A", "2024-01-01", 10)), ["k", "day"], "day")
    two.upsert("p", rows(spark, ("B", "2024-01-02", 20)), ["k", "day"], "day")
    three.upsert("p", rows(spark, ("N", "2024-01-01", 30)), ["k", "day"], "day")
    assert (one.commit(), two.commit()) == (2, 3)
    with pytest.raises(Conflict):
        three.commit()
    assert one.commit() == 2  # again: already there
    tries = []

    def build(work):
        if not tries:  # another writer comes between
            log.publish("between", lambda w: w.upsert("p", rows(spark, ("A", "2024-01-01", 11)), ["k", "day"], "day"))
        tries.append(1)
        work.upsert("p", rows(spark, ("N", "2024-01-01", 30)), ["k", "day"], "day")

    assert log.publish("late", build) == 5 and len(tries) == 2
    assert seen(log, "p") == [("A", "2024-01-01", "11"), ("B", "2024-01-02", "20"), ("N", "2024-01-01", "30")]
    with pytest.raises(ValueError):
        log.begin().append("p", rows(spark, ("A", "2024-01-01", 1)))
    with pytest.raises(LookupError):
        log.read("nothing")


def test_a_read_prunes_folders_and_a_replaced_month_is_whole(spark, tmp_path):
    log = SnapshotLog(spark, str(tmp_path))
    f = spark.range(100).selectExpr("id", "CAST(2020 + id % 3 AS INT) AS year", "lpad(CAST(id % 2 + 1 AS STRING), 2, '0') AS month")
    log.publish("all", lambda w: w.replace("f", f, ["year", "month"]))
    log.publish("part", lambda w: w.replace("f", f.where("year = 2021 AND id < 10"), ["year", "month"]))
    got = log.read("f")
    want = f.where("year <> 2021 OR id < 10")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got.where("year = 2020 AND month = '01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "year" in plan.split("PartitionFilters")[1]


def test_a_scoring_run_is_one_commit(spark, smoke_dir, tmp_path):
    from fleetlens.operators import model as MO
    from fleetlens.plans import adapters as AD
    from fleetlens.plans import jobs as JB
    from fleetlens.schema import model_feature_names
    tel = AD.telemetry_events(spark, smoke_dir)
    run = JB.run_scoring(AD.telemetry_daily(tel), AD.drives(tel), None, MO.fixed_model(model_feature_names()), mode="compat")
    log = SnapshotLog(spark, str(tmp_path))
    assert JB.publish_scoring_run(run, log, "r")["version"] == 1
    assert not run.held.storageLevel.useMemory  # the cached features are let go
    counts = {t: log.read(t).count() for t in ("predictions", "latest_predictions", "features", "audit")}
    assert counts["predictions"] == counts["latest_predictions"] == counts["features"] > 0 and counts["audit"] == 1


def test_latest_rows_do_not_depend_on_the_order_of_batches(spark):
    batches = [[("A", 1, "x"), ("B", 5, "y")], [("A", 3, "z")], [("A", 2, "w"), ("B", 5, "y"), (None, 1, "n")]]
    frames = [spark.createDataFrame(b, "k string, at int, v string") for b in batches]
    want = [("A", 3, "z"), ("B", 5, "y"), (None, 1, "n")]
    for order in itertools.permutations(range(3)):
        state = None
        for i in [*order, order[0]]:
            state = MG.merge_latest(state, frames[i], "k", ["at"])
        assert sorted(map(tuple, state.collect()), key=str) == sorted(want, key=str)


def test_pages_through_the_index_are_those_of_the_list(spark, tmp_path):
    drives = spark.range(237).selectExpr("concat('D', lpad(CAST(id * 7 % 1000 AS STRING), 4, '0'), id) AS drive_id", "'m' AS model", "'d' AS datacenter",
                                         "CAST(id AS LONG) AS capacity_bytes", "DATE '2024-01-01' AS first_seen", "DATE '2024-02-01' AS last_seen")
    preds = drives.selectExpr("drive_id", "DATE '2024-01-05' AS day", "CAST('2024-01-05' AS TIMESTAMP) AS scored_at", "'v' AS model_version",
                              "0.5D AS risk_score", "CASE WHEN capacity_bytes % 5 = 0 THEN 'HIGH' ELSE 'LOW' END AS risk_bucket")
    index = FL.DrivePages.build(drives, str(tmp_path / "pages"), 8)
    assert len(index.counts) == 8 and sum(n for _, n in index.counts) == 237
    for risk, page, size in ((None, 1, 25), (None, 5, 25), (None, 10, 25), (None, 99, 25), (None, 2, 100), ("high", 3, 10), ("high", 5, 10)):
        want = FL.list_drives(drives, preds, risk, page, size).orderBy("drive_id").collect()
        assert index.page(preds, risk, page, size).orderBy("drive_id").collect() == want
        assert index.page(preds, risk, page, size, latest=FL.latest_prediction(preds)).orderBy("drive_id").collect() == want
    at, skip = index.locate(index.counts, 200, 10)
    assert len(at) <= 2 and skip < max(n for _, n in index.counts)
    # one range is read, however far the page
    far = index.drives.where(F.col("range").isin(index.locate(index.counts, 120, 5)[0]))
    folders = far._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert "range" in folders.split("PushedFilters")[0]
    third = FL.list_drives(drives, preds, None, 3, 25).orderBy("drive_id").collect()
    second = FL.list_drives(drives, preds, None, 2, 25).orderBy("drive_id").collect()
    assert [r["drive_id"] for r in FL.list_drives(drives, preds, None, 3, 25, after=second[-1]["drive_id"]).orderBy("drive_id").collect()] == [
        r["drive_id"] for r in third]


def test_merkle_hash(spark):
    base = [("a", 1), ("b", 2), (None, 3), ("a", 1)]
    df = spark.createDataFrame(base, "x string, y int")

    def digest(values):
        return CA.dataset_hash(spark.createDataFrame(values, "x string, y int"), ["x", "y"]).first()[0]

    one = CA.dataset_hash(df, ["x", "y"]).first()[0]
    assert one == digest(base[::-1]) and len(one) == 64
    others = [base[:3], [("a", 2), ("b", 1), (None, 3), ("a", 1)], [("a", 1), ("b", 2), ("", 3), ("a", 1)], [("a1", None), *base[1:]], [*base, ("a", 1)]]
    assert len({one, *map(digest, others)}) == len(others) + 1
    assert CA.dataset_hash(df.limit(0), ["x", "y"]).first()[0] == "manifest_missing"


def test_integer_forms(spark):
    forms = {"0x1F": 31, "0X1f": 31, "-0x1F": None, "0x": None, "0x1_F": 31, "1_000": 1000, "1__0": None, "_1": None, "1_": None,
             "-1_0": -10, "1_0.5": 11, "0b101": 5, "0o17": None, " 0x1F ": 31, "0x7FFFFFFFFFFFFFFF": 2 ** 63 - 1, "0x8000000000000000": None,
             "0x" + "0" * 30 + "1": 1, "9223372036854775807": 2 ** 63 - 1}
    got = spark.createDataFrame([(t,) for t in forms], "t string").select("t", C.safe_int("t")).collect()
    assert {r[0]: r[1] for r in got} == forms


def test_parameters_are_checked():
    for page in (True, 0, "1", 1.0):
        with pytest.raises(ValueError):
            FL.validate_page(page, 25)
    for day in ("2024-W01-1", "20240101", "2024-1-1", "x"):
        with pytest.raises(ValueError):
            FL.validate_day(day)
    assert FL.validate_day("2024-01-31") == dt.date(2024, 1, 31)


def test_publish_features_builds_and_shuffles_the_table_once(spark, smoke_dir, monkeypatch):
    """Months that are published again come from the version that holds them, without the plan of the whole table."""
    from fleetlens.plans import catalog_io, jobs
    plans, publish = [], jobs.publish_features

    def watched(features, *args, **kwargs):
        plans.append((features._jdf.queryExecution().optimizedPlan().toString(), kwargs))
        return publish(features, *args, **kwargs)

    monkeypatch.setattr(jobs, "publish_features", watched)
    got = catalog_io.q_publish_features(spark, smoke_dir)
    assert ["MapInArrow" in p for p, _ in plans] == [True, False, False]
    assert [k.get("placed", False) for _, k in plans] == [False, True, True]
    want = catalog_io.q_write_features(spark, smoke_dir)
    assert sorted(map(repr, got.select(want.columns).collect())) == sorted(map(repr, want.collect()))
