"""Properties: distributed rank and prefix sums equal the naive single-window forms, upserts are
idempotent, the consistent online features equal the offline table of that day."""

import datetime as dt
import random

from pyspark.sql import Window, functions as F

from fleetlens.operators import features as FE
from fleetlens.operators import merge as MG
from fleetlens.operators import rank as RK
from fleetlens.plans import adapters as AD
from fleetlens.schema import METRICS


def _scores(spark, n=3000, ties=True, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # a third of all rows share one score: the heavy-tie case
        s = 0.5 if ties and i % 3 == 0 else round(rnd.random(), 3)
        rows.append((f"k{i:05d}", dt.date(2024, 1, 1 + i % 4), s, rnd.randint(0, 1)))
    return spark.createDataFrame(rows, "key string, day date, score double, y int")


def test_distributed_rank_equals_naive(spark):
    df = _scores(spark)
    order = [("score", False), ("key", True)]
    got = RK.distributed_rank(df, order, "r")
    naive = df.withColumn("n", F.row_number().over(Window.orderBy(F.col("score").desc(), F.col("key"))))
    j = got.join(naive, "key")
    assert j.where(F.col("r") != F.col("n")).count() == 0
    assert got.select("r").distinct().count() == df.count()


def test_distributed_rank_per_partition(spark):
    df = _scores(spark)
    got = RK.distributed_rank(df, [("score", False), ("key", True)], "r", partition_by="day")
    w = Window.partitionBy("day").orderBy(F.col("score").desc(), F.col("key"))
    naive = df.withColumn("n", F.row_number().over(w))
    assert got.join(naive, "key").where(F.col("r") != F.col("n")).count() == 0


def test_ranges_are_balanced_under_heavy_ties(spark):
    df = _scores(spark, n=6000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in RK.with_range(df, [("score", False), ("key", True)]).groupBy("_range").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 7 and max(sizes) < 6000 / 3


def test_rank_with_null_scores_and_days(spark):
    df = (_scores(spark).withColumn("score", F.when(F.col("key").endswith("3"), None).otherwise(F.col("score")))
          .withColumn("day", F.when(F.col("key").endswith("7"), None).otherwise(F.col("day"))))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many ranges, few rows each
    try:
        for part in (None, "day"):
            got = RK.distributed_rank(df, [("score", False), ("key", True)], "r", partition_by=part)
            w = Window.partitionBy(*([part] if part else [])).orderBy(F.col("score").desc(), F.col("key"))
            naive = df.select("key", F.row_number().over(w).alias("n"))
            j = got.join(naive, "key")
            assert j.count() == df.count() and j.where(F.col("r") != F.col("n")).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_drives_answer_alike_at_every_threshold(spark):
    rnd = random.Random(5)
    rows = []
    for s in ("a", "b", "c"):
        for i in range(300):
            for _ in range(2):  # two differing rows a day
                rows.append((s, dt.date(2020, 1, 1) + dt.timedelta(days=i), "M", int(rnd.random() < 0.01), 5,
                             *[float(rnd.randint(0, 50)) if rnd.random() > 0.1 else None for _ in METRICS]))
    rows += rows[:150]  # copies
    ddl = "serial_number string, as_of_date date, model string, failure int, capacity_bytes bigint, "
    df = spark.createDataFrame(rows, ddl + ", ".join(f"{m} double" for m in METRICS))
    one = FE.build_features(df, tiebreak=True, hot_rows=None)
    key = ["serial_number", "as_of_date"]
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in one.dtypes]
    a = one.select(*rounded)
    b = FE.build_features(df, tiebreak=True, hot_rows=100, chunk_rows=64).select(*rounded)
    assert a.count() == b.count() == 1800
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.select(*key).distinct().count() == 900


def test_prefix_sum_equals_naive(spark):
    df = _scores(spark, ties=False).groupBy("score").agg(F.sum("y").alias("tp"), F.count("*").alias("cnt"))
    got = RK.distributed_prefix_sum(df, [("score", False)], ["tp", "cnt"])
    w = Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    naive = df.select("score", F.sum("tp").over(w).alias("ntp"), F.sum("cnt").over(w).alias("ncnt"))
    j = got.join(naive, "score")
    assert j.where((F.col("cum_tp") != F.col("ntp")) | (F.col("cum_cnt") != F.col("ncnt"))).count() == 0


def test_upsert_idempotent(spark, smoke_dir):
    p = AD.predictions(AD.telemetry_events(spark, smoke_dir))
    inc = p.where(F.col("model_version") == "v2").withColumn("risk_score", F.col("risk_score") / 2)
    keys = ["drive_id", "day", "model_version"]
    once = MG.merge_by_key(p, inc, keys)
    twice = MG.merge_by_key(once, inc, keys)
    assert once.count() == p.count()
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0
    ins = MG.insert_if_absent(p, inc, keys)
    assert ins.exceptAll(p).count() == 0 and ins.count() == p.count()


def test_consistent_online_equals_offline_day(spark, smoke_dir):
    tel = AD.telemetry_events(spark, smoke_dir)
    day = tel.agg(F.max("as_of_date")).first()[0]
    off = FE.build_features(tel, METRICS, 30).where(F.col("as_of_date") == F.lit(day))
    on = FE.features_for_day(tel, None, day, METRICS, mode="consistent", horizon_days=30)
    assert off.exceptAll(on).count() == 0 and on.exceptAll(off).count() == 0


def test_features_one_shuffle(spark, smoke_dir):
    """The flagship plan has exactly one exchange above the adapter's aggregate."""
    df = FE.build_features(AD.telemetry_ship(spark, smoke_dir), METRICS, 30)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(serial_number") == 1


def test_upsert_partitions_touches_only_new_days(spark, smoke_dir, tmp_path):
    import glob
    import os
    p = AD.predictions(AD.telemetry_events(spark, smoke_dir)).withColumn("day", F.col("day").cast("string"))
    keys = ["drive_id", "day", "model_version"]
    table = str(tmp_path / "predictions")
    MG.upsert_partitions(p, table, keys)
    last = p.agg(F.max("day")).first()[0]
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{table}/day=*/*.parquet")}
    inc = p.where(F.col("day") == last).withColumn("risk_score", F.col("risk_score") / 2)
    assert MG.upsert_partitions(inc, table, keys) == 1
    after = {f: os.path.getmtime(f) for f in glob.glob(f"{table}/day=*/*.parquet")}
    untouched = [f for f in before if f"day={last}" not in f]
    assert untouched and all(after.get(f) == before[f] for f in untouched)
    got = spark.read.parquet(table).select(*p.columns)
    want = MG.merge_by_key(p, inc, keys)
    assert got.count() == p.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    MG.upsert_partitions(inc, table, keys)
    assert spark.read.parquet(table).count() == p.count()


def test_copies_collapse_before_windows(spark, smoke_dir):
    tel = AD.telemetry_ship(spark, smoke_dir)
    hot = tel.where(F.col("serial_number") == tel.agg(F.min("serial_number")).first()[0])
    copies = tel
    for _ in range(5):
        copies = copies.unionByName(hot)
    a = FE.build_features(tel, METRICS, 30)
    b = FE.build_features(copies, METRICS, 30)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_warehouse_range_prunes_partitions(spark, smoke_dir, tmp_path):
    from fleetlens.sources import warehouse as WH
    path = str(tmp_path / "wh")
    t = AD.telemetry_ship(spark, smoke_dir).withColumnRenamed("as_of_date", "date")
    WH.write_partitioned(t, path, mode="overwrite")
    s = WH.scan_warehouse(spark, path, "1998-01-15", "1998-03-31").select("serial_number", "date")
    plan = _plan(s)
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "PushedFilters: [" in plan and "date" in plan.split("PushedFilters: [")[1].split("]")[0]
    assert "ReadSchema: struct<date:date,serial_number:string>" in plan
    want = t.where(F.col("date").between(F.lit("1998-01-15").cast("date"), F.lit("1998-03-31").cast("date")))
    assert s.count() == want.count()


def test_day_window_pushes_filter(spark, smoke_dir, tmp_path):
    path = str(tmp_path / "tel")
    AD.telemetry_daily(AD.telemetry_events(spark, smoke_dir)).write.parquet(path)
    app = spark.read.parquet(path)
    day = app.agg(F.max("day")).first()[0]
    plan = _plan(FE.features_for_day(app, None, day, METRICS))
    assert "PushedFilters: [" in plan and "day" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_hot_drive_chunked_path_is_exact(spark):
    import datetime as dt
    rows = []
    for i in range(3000):  # one very long drive, one row per day, a few nulls and failures
        d = dt.date(2000, 1, 1) + dt.timedelta(days=i)
        v = None if i % 17 == 0 else float((i * 37) % 101)
        rows.append(("HOT", d, 1 if i in (1500, 2900) else 0, v))
    for s in ("A", "B"):
        for i in range(50):
            rows.append((s, dt.date(2000, 1, 1) + dt.timedelta(days=3 * i), 1 if i == 40 else 0, float(i % 7)))
    df = spark.createDataFrame(rows, "serial_number string, as_of_date date, failure int, smart_5_raw double")
    for m in METRICS:
        if m not in df.columns:
            df = df.withColumn(m, F.lit(None).cast("double"))
    df = df.withColumn("model", F.lit("M")).withColumn("capacity_bytes", F.lit(1).cast("bigint"))
    plain = FE.build_features(df, METRICS, 30, hot_rows=None)
    chunked = FE.build_features(df, METRICS, 30, hot_rows=1000, chunk_rows=400)
    assert [r[0] for r in FE.hot_drives(df, 1000).collect()] == ["HOT"]
    assert chunked.count() == plain.count() == 3100
    assert plain.exceptAll(chunked).count() == 0 and chunked.exceptAll(plain).count() == 0


def test_a_failed_read_is_no_empty_table(spark, tmp_path):
    import pytest
    table = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", "2024-01-01", 1.0), ("b", "2024-01-01", 2.0)], "drive_id string, day string, score double")
    assert MG.upsert_partitions(rows, table, ["drive_id", "day"]) == 1
    new = spark.createDataFrame([("a", "2024-01-01", 5.0)], "drive_id string, day string, score double")

    def broken(*_):
        raise OSError("storage is away")
    real, MG.read_if_exists = MG.read_if_exists, broken
    try:
        with pytest.raises(OSError):
            MG.upsert_partitions(new, table, ["drive_id", "day"])
    finally:
        MG.read_if_exists = real
    assert spark.read.parquet(table).count() == 2
    MG.upsert_partitions(new, table, ["drive_id", "day"])
    assert {r["drive_id"]: r["score"] for r in spark.read.parquet(table).collect()} == {"a": 5.0, "b": 2.0}


def test_duplicate_incoming_keys_follow_the_order(spark):
    rows = spark.createDataFrame([("a", 9.0, 1), ("a", 3.0, 2)], "k string, v double, scored_at int")
    assert MG.dedupe_by_key(rows, ["k"], "max", ["scored_at"]).collect() == [("a", 3.0, 2)]
    assert MG.merge_by_key(rows.limit(0), rows, ["k"], order=["scored_at"]).collect() == [("a", 3.0, 2)]


def test_rolled_rows_have_the_values_of_the_sliding_frames(spark):
    """The same doubles as the window expressions, over nulls, NaN, infinities, drives longer than a batch and batches shorter than a frame."""
    from fleetlens.operators import windows as W
    metrics = ["a", "b"]
    rng = random.Random(17)
    odd = [None, 0.0, 1e15, -2.5, float("nan"), float("inf")]
    rows = [(f"D{d}", i, rng.choice(odd) if rng.random() < 0.05 else rng.gauss(1e3, 50), None if d == 2 else float(rng.randrange(3)))
            for d, days in enumerate((1, 95, 40, 7, 230)) for i in range(days)]
    df = spark.createDataFrame(rows, "serial_number string, as_of_date int, a double, b double").repartition(2, "serial_number")
    want = df.select("serial_number", "as_of_date", *W.rolling_feature_columns(metrics, stats=W.ROLLED))
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("10000", "64", "11", "1"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            got = W.rolled(df, ["serial_number"], ["as_of_date"], metrics).select(want.columns)
            assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)


def test_fast_rounding_gives_the_double_that_round_gives(spark):
    from fleetlens.plans.catalog import rounded
    rng = random.Random(23)
    xs = [None, 0.0, -0.0, float("nan"), float("inf"), -float("inf"), 1e-7, -1e-7, 5e-7, 1.5e-6, -2.5e-6, 1.0000005, 0.0078125, 4e6, 3999999.9999995, 1e15, 1e300]
    xs += [s * rng.random() * 10.0 ** rng.randrange(-9, 12) for s in (1, -1) for _ in range(3000)]
    xs += [s * (rng.randrange(10 ** 12) + 0.5) / 1e6 for s in (1, -1) for _ in range(1000)]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").selectExpr("x", "round(x, 6) AS want", f"{rounded('x')} AS got").collect()
    assert [repr(r.got) for r in rows] == [repr(r.want) for r in rows]
    assert "rint" in rounded("x") and spark.sql(f"SELECT {rounded('x', 2)} AS y FROM VALUES (1.005D), (-7.125D) AS t(x)").collect() == [(1.01,), (-7.13,)]


def test_a_derived_table_is_counted_only_if_its_source_has_a_hot_drive(spark, smoke_dir, monkeypatch):
    tel = AD.telemetry_ship(spark, smoke_dir)
    source = AD.source_rows(AD.telemetry_ship, spark, smoke_dir)
    assert "Aggregate" not in _plan(source)
    counted, count = [], FE.hot_drives

    def watched(rows, threshold):
        counted.append(rows.columns)
        return count(rows, threshold)

    monkeypatch.setattr(FE, "hot_drives", watched)
    want = FE.build_features(tel, METRICS, 30, hot_rows=None)
    assert counted == []
    most = max(r["count"] for r in tel.groupBy("serial_number").count().collect())
    few = FE.build_features(tel, METRICS, 30, source=source)
    assert counted == [["serial_number"]]  # of the source, not of the table
    counted.clear()
    # the source has more rows of a drive than the bound: the table decides, and some of its drives go the long way
    many = FE.build_features(tel, METRICS, 30, hot_rows=most - 1, chunk_rows=64, source=source)
    assert len(counted) == 2 and counted[1] != ["serial_number"] and "_chunk" in _plan(many)
    for got in (few, many):
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_copies_are_neighbours_of_one_sort(spark):
    """Copies go once the rows are sorted for the statistics: no aggregate over all columns, no second sort, no copy of the wide rows for the month."""
    rng = random.Random(29)
    odd = [None, 0.0, -0.0, float("nan"), 2.5]
    rows = []
    for drive, days in (("A", 40), ("B", 3), ("C", 75)):
        for i in range(days):
            for _ in range(rng.choice((1, 1, 1, 2))):  # rows of one day that differ, each with up to 20 copies
                row = (drive, dt.date(2024, 1, 1) + dt.timedelta(days=i), rng.choice((0, 1, None)), rng.choice(("m", None)),
                       rng.choice((1, None)), rng.choice(odd), float(i % 7))
                rows += [row] * rng.choice((1, 2, 3, 20))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "serial_number string, as_of_date date, failure int, model string, capacity_bytes bigint, a double, b double")
    got = FE.build_features(df, ["a", "b"], 30, tiebreak=True, hot_rows=None)
    plan = _plan(got)
    assert "Aggregate" not in plan and plan.count("Sort [") == 1
    assert not got.schema["month"].nullable
    want = FE.build_features(df.dropDuplicates(), ["a", "b"], 30, tiebreak=True, hot_rows=None, dedupe=False)
    wanted = sorted(map(repr, want.collect()))
    assert len(wanted) == df.distinct().count() < len(rows)
    kept = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in ("10000", "7", "1"):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert sorted(map(repr, got.collect())) == wanted
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", kept)
