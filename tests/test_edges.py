"""Hand-computed edge cases (FIXTURES section 4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fleetlens.functions import casts as C
from fleetlens.functions.risk import risk_bucket
from fleetlens.operators import evaluate as EV
from fleetlens.operators import features as FE
from fleetlens.operators import merge as MG
from fleetlens.operators import model as MO
from fleetlens.operators import risk as RK
from fleetlens.schema import METRICS

D0 = dt.date(2024, 3, 1)


def tel(spark, rows, metrics=("smart_5_raw",)):
    """rows: (serial, day offset, failure, value)"""
    data = [(s, D0 + dt.timedelta(days=o), f, v) for s, o, f, v in rows]
    df = spark.createDataFrame(data, "serial_number string, as_of_date date, failure int, smart_5_raw double")
    for m in METRICS:
        if m not in df.columns:
            df = df.withColumn(m, F.lit(None).cast("double"))
    return df.withColumn("model", F.lit("M")).withColumn("capacity_bytes", F.lit(1).cast("bigint"))


def feats(spark, rows, horizon=30):
    out = FE.build_features(tel(spark, rows), METRICS, horizon)
    return {(r["serial_number"], r["as_of_date"]): r for r in out.collect()}


def test_label_bounds(spark):
    f = 100
    rows = [("a", f + o, 1 if o == 0 else 0, 1.0) for o in (-31, -30, -1, 0, 1)]
    got = feats(spark, rows)
    labels = [got[("a", D0 + dt.timedelta(days=f + o))]["label_30d"] for o in (-31, -30, -1, 0, 1)]
    assert labels == [0, 1, 1, 0, 0]


def test_second_failure_ignored(spark):
    rows = [("a", 0, 1, 1.0), ("a", 1, 0, 1.0), ("a", 20, 1, 1.0)]
    assert feats(spark, rows)[("a", D0 + dt.timedelta(days=1))]["label_30d"] == 0


def test_single_row_drive(spark):
    r = feats(spark, [("a", 0, 0, 5.0)])[("a", D0)]
    assert (r["smart_5_raw_mean_7d"], r["smart_5_raw_std_30d"], r["smart_5_raw_delta_vs_7d"],
            r["smart_5_raw_is_increasing"], r["age_days"]) == (5.0, 0.0, 0.0, 0, 0)


def test_null_current_offline_and_online(spark):
    rows = [("a", 0, 0, 4.0), ("a", 1, 0, 6.0), ("a", 2, 0, None)]
    r = feats(spark, rows)[("a", D0 + dt.timedelta(days=2))]
    assert r["smart_5_raw_mean_7d"] == 5.0 and r["smart_5_raw_delta_vs_7d"] is None
    assert r["smart_5_raw_is_increasing"] == 0
    app = tel(spark, rows).select(F.col("serial_number").alias("drive_id"), F.col("as_of_date").alias("day"),
                                  *METRICS)
    o = FE.features_for_day(app, None, D0 + dt.timedelta(days=2)).first()
    assert o["smart_5_raw_delta_vs_7d"] == -5.0 and o["smart_5_raw_is_increasing"] == 0


def test_gap_in_days_uses_rows(spark):
    rows = [("a", d, 0, float(d)) for d in range(1, 7)] + [("a", 40, 0, 40.0)]
    r = feats(spark, rows)[("a", D0 + dt.timedelta(days=40))]
    assert r["smart_5_raw_mean_7d"] == pytest.approx((1 + 2 + 3 + 4 + 5 + 6 + 40) / 7)


def test_all_null_metric(spark):
    rows = [("a", d, 0, 1.0) for d in range(3)]
    r = feats(spark, rows)[("a", D0 + dt.timedelta(days=2))]
    assert r["smart_241_raw_mean_7d"] is None
    app = tel(spark, rows).select(F.col("serial_number").alias("drive_id"), F.col("as_of_date").alias("day"),
                                  *METRICS)
    o = FE.features_for_day(app, None, D0 + dt.timedelta(days=2)).first()
    assert o["smart_241_raw_mean_7d"] == 0.0 and o["smart_198_raw_std_30d"] == 0.0


def test_online_stale_drive(spark):
    rows = [("fresh", 0, 0, 1.0), ("stale10", -10, 0, 2.0), ("stale31", -31, 0, 3.0)]
    app = tel(spark, rows).select(F.col("serial_number").alias("drive_id"), F.col("as_of_date").alias("day"),
                                  *METRICS)
    got = {r["drive_id"]: r for r in FE.features_for_day(app, None, D0).collect()}
    assert set(got) == {"fresh", "stale10"}
    assert got["stale10"]["age_days"] == 10 and got["stale10"]["smart_5_raw_mean_7d"] == 2.0


def test_non_finite(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (1.5,)], "x double")
    zero = [r[0] for r in df.select(C.finite_or("x", 0.0)).collect()]
    null = [r[0] for r in df.select(C.finite_or("x", None)).collect()]
    assert zero == [0.0, 0.0, 0.0, 0.0, 1.5] and null == [None, None, None, None, 1.5]


def test_casts(spark):
    df = spark.createDataFrame([(t,) for t in ["1.5", "2.5", "1e3", " 7 ", "bad", ""]], "t string")
    assert [r[0] for r in df.select(C.safe_int("t", "int")).collect()] == [2, 3, 1000, 7, None, None]
    d = spark.createDataFrame([(2.5,), (3.5,), (-2.5,)], "x double")
    assert [r[0] for r in d.select(C.narrow_double("x")).collect()] == [2, 4, -2]
    dates = spark.createDataFrame([(t,) for t in ["2024-1-5", "2024/01/05", "2024", "2024-01", "n/a"]], "t string")
    got = [r[0] for r in dates.select(C.safe_date("t")).collect()]
    assert got == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, None, None]


@pytest.mark.parametrize("n,expected", [(0, None), (1, (1, 0)), (2, (1, 1)), (9, (1, 1)), (10, (1, 2)),
                                        (19, (1, 3)), (20, (1, 3)), (100, (5, 15))])
def test_fallback_sizes(spark, n, expected):
    if n == 0:
        df = spark.createDataFrame([], "drive_id string, day date, risk_score double, risk_bucket string")
        assert RK.rank_fallback(df).count() == 0
        return
    rows = [(f"d{i:03d}", D0, 0.001 * i, "LOW") for i in range(n)]
    df = spark.createDataFrame(rows, "drive_id string, day date, risk_score double, risk_bucket string")
    out = RK.rank_fallback(df)
    c = {r["risk_bucket"]: r["count"] for r in out.groupBy("risk_bucket").count().collect()}
    assert (c.get("HIGH", 0), c.get("MED", 0)) == expected
    assert sum(c.values()) == n
    assert {r["bucket_mode"] for r in out.collect()} == {"rank_fallback"}


def test_fallback_single_is_midpoint(spark):
    df = spark.createDataFrame([("a", D0, 0.1, "LOW")], "drive_id string, day date, risk_score double, risk_bucket string")
    r = RK.rank_fallback(df).first()
    assert r["risk_bucket"] == "HIGH" and r["risk_score"] == 0.85 and r["model_score"] == 0.1


def test_fallback_off_when_med_present(spark):
    df = spark.createDataFrame([("a", D0, 0.5, "MED"), ("b", D0, 0.1, "LOW")],
                               "drive_id string, day date, risk_score double, risk_bucket string")
    got = {r["drive_id"]: (r["risk_bucket"], r["risk_score"], r["bucket_mode"]) for r in RK.rank_fallback(df).collect()}
    assert got == {"a": ("MED", 0.5, "model"), "b": ("LOW", 0.1, "model")}


def test_bucket_edges(spark):
    df = spark.createDataFrame([(0.75,), (0.7499,), (0.4,), (0.3999,)], "s double")
    assert [r[0] for r in df.select(risk_bucket("s")).collect()] == ["HIGH", "MED", "MED", "LOW"]


def test_calibration_bins_edges(spark):
    df = spark.createDataFrame([(0.0, 0), (0.3, 0), (0.30000000000000004, 1), (1.0, 1)], "score double, y int")
    got = sorted(r["bin"] for r in EV.calibration_bins(df).collect())
    assert got == [0, 2, 3, 9]
    assert sum(r["count"] for r in EV.calibration_bins(df).collect()) == 4


def test_recall_small(spark):
    df = spark.createDataFrame([(float(i), 0) for i in range(50)], "score double, y int")
    r = EV.recall_at_top(df, 0.01).first()
    assert r["k"] == 1 and r["recall"] == 0.0


def test_average_precision_example(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "score double, y int")
    assert EV.average_precision(df).first()[0] == pytest.approx(0.5 * 1 + 0.5 * (2 / 3))
    none = spark.createDataFrame([(0.9, 0), (0.1, 0)], "score double, y int")
    assert EV.average_precision(none).first()[0] == 0.0


def test_reasons_order_and_direction(spark):
    names = list("abcdef")
    model = MO.LinearModel(features=names, weights={n: 1.0 for n in names}, intercept=0.0,
                           means={n: 0.0 for n in names}, scales={n: 1.0 for n in names},
                           fills={n: 0.0 for n in names}, version="t")
    df = spark.createDataFrame([("x", D0, 0.0, -2.0, 2.0, 1.0, 3.0, 1.0)],
                               "drive_id string, day date, a double, b double, c double, d double, e double, f double")
    r = MO.score_batch(df, model).first()
    assert [x["code"] for x in r["top_reasons"]] == ["e", "b", "c", "d", "f"]
    zero = spark.createDataFrame([("x", D0) + (0.0,) * 6], df.schema)
    assert MO.score_batch(zero, model).first()["top_reasons"][0]["direction"] == "UP"


def test_upsert_drive(spark):
    schema = "drive_id string, model string, capacity_bytes bigint, datacenter string, first_seen date, last_seen date"
    cur = spark.createDataFrame([("d", "old", 5, "x", dt.date(2024, 1, 5), dt.date(2024, 1, 9))], schema)
    new = spark.createDataFrame([("d", "new", None, "y", dt.date(2024, 1, 1), dt.date(2024, 1, 7))], schema)
    r = MG.merge_drives(cur, new).first()
    assert (r["model"], r["capacity_bytes"], r["first_seen"], r["last_seen"]) == (
        "new", 5, dt.date(2024, 1, 1), dt.date(2024, 1, 9))


def test_class_absent(spark):
    df = spark.createDataFrame([(0,), (0,)], "label_30d int")
    r = MO.class_weights(df).first()
    assert (r["w0"], r["w1"]) == (0.5, 1.0)
    df2 = spark.createDataFrame([(0,), (0,), (1,), (0,)], "label_30d int")
    r2 = MO.class_weights(df2).first()
    assert r2["w0"] == pytest.approx(4 / 6) and r2["w1"] == 2.0


def test_time_split_branches():
    s = MO.resolve_split(dt.date(2024, 1, 1), dt.date(2024, 1, 30), 9)
    assert (s.branch, s.cutoff_date) == ("fraction", dt.date(2024, 1, 24))
    s2 = MO.resolve_split(dt.date(1995, 1, 2), dt.date(2001, 11, 30), 9)
    assert (s2.branch, s2.cutoff_date) == ("months", dt.date(2001, 2, 28))


def test_reasons_scaled_option(spark):
    names = ["a", "b"]
    model = MO.LinearModel(features=names, weights={"a": 1.0, "b": 1.0}, intercept=0.0,
                           means={"a": 100.0, "b": 0.0}, scales={"a": 10.0, "b": 1.0},
                           fills={"a": 0.0, "b": 0.0}, version="t")
    df = spark.createDataFrame([("x", D0, 110.0, 2.0)], "drive_id string, day date, a double, b double")
    raw = MO.score_batch(df, model).first()["top_reasons"]
    scaled = MO.score_batch(df, model, contribution="scaled").first()["top_reasons"]
    assert [r["code"] for r in raw] == ["a", "b"] and raw[0]["contribution"] == 110.0
    assert [r["code"] for r in scaled] == ["b", "a"] and scaled[1]["contribution"] == 1.0


def test_normalize_vector_and_set_null_on_delete(spark):
    from fleetlens.operators import contracts as CT
    from fleetlens.operators import vectors as VE
    df = spark.createDataFrame([({"a": 1.0, "x": 2.0, "b": float("nan")},)], "features map<string,double>")
    v = df.select(VE.normalize_vector(F.col("features"), ["a", "b", "c"]).alias("v")).first()["v"]
    assert v == {"a": 1.0, "b": None, "c": None}
    assert VE.columns_mismatch(["a", "x"], ["a", "b"]) == (["b"], ["x"])
    audit = spark.createDataFrame([("1", "d1"), ("2", "d2"), ("3", None)], "id string, drive_id string")
    gone = spark.createDataFrame([("d1",)], "drive_id string")
    got = {r["id"]: r["drive_id"] for r in CT.null_parent_on_delete(audit, gone).collect()}
    assert got == {"1": None, "2": "d2", "3": None}


def test_recommended_partitions():
    from fleetlens.session import recommended_partitions
    big = recommended_partitions(100 * 2**40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 122880  # 30 TB of shuffle in 256 MB tasks
    small = recommended_partitions(10 * 2**20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24     # at least 3 waves per core


def test_merges_keep_one_row_per_key_and_find_null_parts(spark):
    import datetime as dt
    from fleetlens.operators import merge as MG
    day = dt.date(2024, 1, 1)
    cur = spark.createDataFrame([("A", "m", 5, "d", day, day)], "drive_id string, model string, capacity_bytes long, datacenter string, "
                                                                "first_seen date, last_seen date")
    twice = cur.unionByName(cur)
    assert MG.merge_drives(cur, twice).count() == 1
    late = cur.selectExpr("drive_id", "'new' AS model", "CAST(NULL AS LONG) AS capacity_bytes", "datacenter", "first_seen", "date_add(last_seen, 3) AS last_seen")
    (row,) = MG.merge_drives(cur, twice.unionByName(late)).collect()
    assert (row["model"], row["capacity_bytes"], row["last_seen"]) == ("new", 5, day + dt.timedelta(days=3))
    rows = spark.createDataFrame([("A", None, 1.0), (None, None, 2.0), ("B", "v", 3.0)], "k string, v string, x double")
    once = MG.merge_by_key(rows, rows, ["k", "v"])
    assert sorted(map(str, once.collect())) == sorted(map(str, rows.collect()))
    assert MG.insert_if_absent(rows, rows, ["k", "v"]).count() == 3


def test_upsert_keeps_columns_that_the_incoming_rows_lack(spark, tmp_path):
    from fleetlens.operators import merge as MG
    path = str(tmp_path / "t")
    full = spark.createDataFrame([("A", "2024-01-01", 1, "note"), ("B", "2024-01-01", 2, "kept")], "k string, day string, v int, note string")
    MG.upsert_partitions(full, path, ["k", "day"])
    MG.upsert_partitions(full.where("k = 'A'").selectExpr("k", "day", "v + 10 AS v"), path, ["k", "day"])
    back = spark.read.parquet(path).select("k", "v", "note").orderBy("k").collect()
    assert [tuple(r) for r in back] == [("A", 11, None), ("B", 2, "kept")]
    import pytest as _p
    with _p.raises(ValueError):
        MG.upsert_partitions(full.selectExpr("k", "day", "v", "1 AS unknown"), path, ["k", "day"])


def test_fallback_keeps_rows_without_a_day(spark):
    from fleetlens.operators import risk as RK
    rows = spark.range(200).selectExpr("CAST(id AS STRING) AS drive_id", "CASE WHEN id % 10 > 0 THEN DATE '2024-01-01' END AS day",
                                       "0.1D + id / 10000 AS risk_score", "'LOW' AS risk_bucket")
    out = RK.rank_fallback(rows)
    assert out.count() == 200 and out.where("day IS NULL AND risk_bucket = 'HIGH'").count() == 1


def test_loaded_telemetry_is_in_drive_order(spark, tmp_path):
    from fleetlens.sources import warehouse as WH
    import pyarrow.parquet as pq
    rows = spark.range(0, 20_000, 1, 4).selectExpr("sha2(CAST(id AS STRING), 256) AS drive_id", "date_add(DATE '2024-01-01', CAST(id % 10 AS INT)) AS day")
    WH.load_telemetry(rows, str(tmp_path / "t"))
    files = spark.read.parquet(str(tmp_path / "t")).inputFiles()
    assert len(files) >= 10
    for f in files:
        ids = pq.ParquetFile(f.removeprefix("file://").replace("file:", "")).read().column("drive_id").to_pylist()
        assert ids == sorted(ids)


def test_ordered_bits_are_those_of_the_double(spark):
    import math
    import random
    import struct
    from fleetlens.operators.histogram import ordered_bits
    rng = random.Random(1)
    xs = [0.0, -0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, math.inf, -math.inf]
    xs += [f(2.0 ** e) for e in range(-1073, 1023, 7) for f in (float, lambda v: math.nextafter(v, 0), lambda v: math.nextafter(v, math.inf))]
    xs += [struct.unpack("d", struct.pack("Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    xs = [x for x in xs if x == x]

    def want(x):
        bits = struct.unpack("q", struct.pack("d", abs(x)))[0]
        return -bits if x < 0 else bits

    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", ordered_bits(F.col("x")).alias("b")).collect()
    assert [r["b"] for r in got] == [want(r["x"]) for r in got]


def test_top_cuts_and_average_precision_on_heavy_ties(spark):
    """Equal to the full rank and to the plain sum, where a third of the rows share the score at the cut."""
    import random
    from fleetlens.operators import evaluate as EV
    rng = random.Random(5)
    rows = [(f"k{i:05d}", 0.5 if i % 3 == 0 else rng.choice([None, float("nan"), rng.random(), rng.random() * 1e-9]), int(rng.random() < 0.2))
            for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, score double, y int")

    def place(r):
        s = r[1]
        return (0 if s != s and s is not None else 1 if s is not None else 2, -(s if s is not None and s == s else 0), r[0])

    ranked = sorted(rows, key=place)
    hits = sum(r[2] for r in rows)
    fractions = [0.0001, 0.01, 0.3, 0.45, 0.5, 0.9, 1.0]
    got = EV.recalls_at_top(df, fractions, key="k")
    for f, (recall, k) in zip(fractions, got):
        assert k == max(1, int(len(rows) * f)) and abs(recall - sum(r[2] for r in ranked[:k]) / hits) < 1e-12
    total, seen, tp = 0.0, 0, 0
    groups: dict = {}
    for r in ranked:
        groups.setdefault(place(r)[:2], []).append(r[2])
    for ys in groups.values():
        seen, tp = seen + len(ys), tp + sum(ys)
        total += sum(ys) * tp / seen
    for leaf_rows in (10, 500, 10_000):
        assert abs(EV.average_precision(df, leaf_rows=leaf_rows).first()[0] - total / hits) < 1e-12
    assert EV.recalls_at_top(df.limit(0), [0.5]) == [(0.0, 1)]
    assert EV.average_precision(df.where("y = 0")).first()[0] == 0.0


def test_rounding_is_that_of_the_exact_double(spark):
    import math
    import random
    from fleetlens.functions.rounding import round_exact
    rng = random.Random(3)
    xs = [j / 128 for j in range(-999, 999)] + [j / 128 + rng.randrange(10 ** 6) for j in range(1, 200, 2)]
    for _ in range(3000):  # next to a tie, on both sides
        t = (rng.randrange(10 ** rng.randint(1, 9)) + 0.5) / 1e6
        xs += [t, math.nextafter(t, 0), math.nextafter(t, math.inf), -t]
    xs += [rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 18) for _ in range(2000)]
    xs += [2.5e-7, 5e-7, 5.000000000000001e-7, 4.999999e-7, 5e-324, 0.0, 1.0000005, 2.0 ** 52 + 0.5, 2.0 ** 51 + 0.5, 9e9 + 0.0000005, 1e300]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", round_exact(F.col("x")).alias("r")).collect()
    bad = [(r["x"], r["r"], round(r["x"], 6)) for r in got if r["r"] != round(r["x"], 6)]
    assert not bad, bad[:5]
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),)], "x double").select(round_exact(F.col("x"))).collect()
    assert odd[0][0] is None and math.isnan(odd[1][0]) and odd[2][0] == math.inf
