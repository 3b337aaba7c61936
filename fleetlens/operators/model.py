"""Model operators: feature discovery, time split, scaler, class weights, logistic fit, scoring.

Scoring and reason codes are plain column expressions over a literal
coefficient table (47 numbers), so a batch of any size is scored inside
whole-stage codegen with no Python on the data path.
"""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from fleetlens.functions.casts import finite_or, is_finite
from fleetlens.functions.risk import risk_bucket, sigmoid  # noqa: F401  (re-exported)
from fleetlens.functions.rounding import round_exact
from fleetlens.schema import IGNORED_COLUMNS, TOP_REASONS


# -- feature set -------------------------------------------------------------
def numeric_features(df: DataFrame, ignored: set[str] = IGNORED_COLUMNS,
                     include_decimal: bool = True) -> list[str]:
    """Every numeric column except the ignored names, in schema order."""
    out = []
    for f in df.schema.fields:
        if f.name in ignored or not isinstance(f.dataType, NumericType):
            continue
        if not include_decimal and f.dataType.typeName() == "decimal":
            continue
        out.append(f.name)
    if not out:
        raise RuntimeError("no numeric features found")
    return out


def training_matrix(df: DataFrame, names: list[str], label: str = "label_30d",
                    keep: list[str] | None = None) -> DataFrame:
    """Features as doubles with NaN, +/-inf and null -> 0 (the training fill)."""
    return df.select(*(keep or []), F.col(label).cast("int").alias(label),
                     *[finite_or(F.col(n).cast("double"), 0.0).alias(n) for n in names])


# -- time split --------------------------------------------------------------
@dataclass
class Split:
    min_date: dt.date
    max_date: dt.date
    cutoff_date: dt.date
    branch: str  # "months" or "fraction"


def _minus_months(d: dt.date, months: int) -> dt.date:
    y, m = divmod(d.year * 12 + (d.month - 1) - months, 12)
    m += 1
    last = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28, 31, 30, 31, 30, 31, 31, 30, 31,
            30, 31][m - 1]
    return dt.date(y, m, min(d.day, last))


def resolve_split(min_date: dt.date, max_date: dt.date, test_months: int = 9) -> Split:
    """Cutoff = max - months (month end clipped); if that is not after min: min + int(max(1, span) * 0.8) days."""
    cutoff = _minus_months(max_date, test_months)
    if cutoff <= min_date:
        span = max(1, (max_date - min_date).days)
        return Split(min_date, max_date, min_date + dt.timedelta(days=int(span * 0.8)), "fraction")
    return Split(min_date, max_date, cutoff, "months")


def time_split(df: DataFrame, test_months: int = 9, date_col: str = "as_of_date",
               label: str = "label_30d", embargo_days: int = 0) -> tuple[DataFrame, DataFrame, Split]:
    """Train = day <= cutoff, test = day > cutoff (+ optional embargo); rows need a label.

    The bounds are one aggregate (a scalar result by contract); the two sides
    are lazy filters with literal cutoffs, so Parquet scans prune on them.
    """
    row = df.agg(F.min(date_col), F.max(date_col)).first()
    if row[0] is None:
        raise RuntimeError("features dataset is empty")
    split = resolve_split(row[0], row[1], test_months)
    cut = F.lit(split.cutoff_date)
    lab = F.col(label).isNotNull()
    train = df.where((F.col(date_col) <= cut) & lab)
    test = df.where((F.col(date_col) > F.date_add(cut, embargo_days)) & lab)
    return train, test, split


# -- scaler and class weights -------------------------------------------------
def feature_moments(df: DataFrame, names: list[str]) -> DataFrame:
    """Long table (feature, mean, std, n) with population std, from one distributed aggregate."""
    aggs = []
    for n in names:
        aggs += [F.avg(n).alias(f"m__{n}"), F.stddev_pop(n).alias(f"s__{n}")]
    wide = df.agg(F.count(F.lit(1)).alias("n"), *aggs)
    pairs = ", ".join(f"'{n}', `m__{n}`, `s__{n}`" for n in names)
    return wide.selectExpr("n", f"stack({len(names)}, {pairs}) AS (feature, mean, std)").select(
        "feature", "mean", "std", "n")


def collect_moments(moments: DataFrame) -> dict[str, tuple[float, float]]:
    """feature -> (mean, std); a bounded result (two numbers per feature)."""
    return {r["feature"]: (r["mean"] or 0.0, r["std"] or 0.0) for r in moments.collect()}


def scale_value(x: Column, mean: float, std: float) -> Column:
    """(x - mean) / std with zero variance -> divisor 1."""
    div = std if std and std > 0 and math.isfinite(std) else 1.0
    return (x - F.lit(float(mean))) / F.lit(float(div))


def scale_features(df: DataFrame, names: list[str], moments: dict[str, tuple[float, float]],
                   keep: list[str] | None = None) -> DataFrame:
    keep = keep if keep is not None else [c for c in df.columns if c not in names]
    return df.select(*keep, *[scale_value(F.col(n), *moments[n]).alias(n) for n in names])


def class_weights(df: DataFrame, label: str = "label_30d") -> DataFrame:
    """One row: n, n0, n1, w0, w1 with w_c = n / (2 n_c), 1.0 when a class is absent."""
    y = F.col(label)
    c = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"))

    def w(nc: str) -> Column:
        return F.when(F.col(nc) > 0, F.col("n") / (F.lit(2.0) * F.col(nc))).otherwise(F.lit(1.0))

    return c.select("n", "n0", "n1", w("n0").alias("w0"), w("n1").alias("w1"))


def weight_column(label: str, w0: float, w1: float) -> Column:
    return F.when(F.col(label) == 1, F.lit(float(w1))).otherwise(F.lit(float(w0)))


# -- the fitted model as a literal coefficient table ----------------------------
@dataclass
class LinearModel:
    features: list[str]
    weights: dict[str, float]
    intercept: float
    means: dict[str, float]
    scales: dict[str, float]
    fills: dict[str, float]
    version: str
    horizon_days: int = 30
    model_type: str = "LogisticRegression(l2)"
    metrics: dict = field(default_factory=dict)

    def coefficient_rows(self) -> list[tuple]:
        return [(i, n, self.weights.get(n, 0.0), self.means.get(n, 0.0), self.scales.get(n, 1.0),
                 self.fills.get(n, 0.0)) for i, n in enumerate(self.features)]

    def coefficients(self, spark) -> DataFrame:
        return spark.createDataFrame(self.coefficient_rows(),
                                     "position int, feature string, weight double, mean double, "
                                     "scale double, fill double")


def fit_logistic(train: DataFrame, names: list[str], label: str = "label_30d", version: str = "model",
                 horizon_days: int = 30, reg_param: float = 1e-5, max_iter: int = 100) -> LinearModel:
    """Scale with population moments, balance classes, fit an L2 logistic regression.

    Non-finite and null features are 0 for training; the fill values used at
    scoring time are the training means (the reference's split behaviour).
    """
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark import StorageLevel

    # the zero-filled training matrix is computed once and read by every pass below
    # (moments, class counts, the optimizer's iterations); it spills to disk if large
    m = training_matrix(train, names, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        moments = collect_moments(feature_moments(m, names))
        cw = class_weights(m, label).first()
        if cw["n"] == 0:
            raise RuntimeError("no training rows available after split")
        scaled = scale_features(m, names, moments, keep=[label]).withColumn(
            "_w", weight_column(label, cw["w0"], cw["w1"]))
        data = VectorAssembler(inputCols=names, outputCol="_x").transform(scaled).select(
            F.col(label).cast("double").alias("_y"), "_x", "_w")
        lr = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="_w", regParam=reg_param,
                                elasticNetParam=0.0, standardization=False, maxIter=max_iter,
                                family="binomial")
        fitted = lr.fit(data)
    finally:
        m.unpersist()
    coef = fitted.coefficients.toArray().tolist()
    means = {n: float(moments[n][0]) for n in names}
    scales = {n: float(moments[n][1]) if moments[n][1] and moments[n][1] > 0 else 1.0 for n in names}
    return LinearModel(features=list(names), weights=dict(zip(names, map(float, coef))),
                       intercept=float(fitted.intercept), means=means, scales=scales, fills=dict(means),
                       version=version, horizon_days=horizon_days)


def optimality(train: DataFrame, model: LinearModel, label: str = "label_30d", reg_param: float = 1e-5) -> DataFrame:
    """One row: rows, positives and the largest slope of the fitted objective (balanced log loss plus L2) at the model.

    At the optimum every slope is zero: one aggregate checks a fit, whatever solver made it.
    """
    names = model.features
    m = training_matrix(train, names, label)
    cw = class_weights(m, label).first()
    x = scale_features(m, names, {n: (model.means[n], model.scales[n]) for n in names}, keep=[label]).withColumn(
        "_w", weight_column(label, cw["w0"], cw["w1"]))
    z = F.lit(float(model.intercept))
    for n in names:
        z = z + F.lit(float(model.weights[n])) * F.col(n)
    x = x.withColumn("_r", F.col("_w") * (sigmoid(z) - F.col(label)))
    sums = x.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(label).cast("bigint")).alias("positives"), F.sum("_w").alias("_t"),
                 F.sum("_r").alias("_b"), *[F.sum(F.col("_r") * F.col(n)).alias(f"_g{i}") for i, n in enumerate(names)])
    slopes = [F.abs(F.col("_b") / F.col("_t"))] + [F.abs(F.col(f"_g{i}") / F.col("_t") + F.lit(reg_param * model.weights[n])) for i, n in enumerate(names)]
    return sums.select("rows", "positives", F.greatest(*slopes).alias("largest_slope"))


# -- scoring ------------------------------------------------------------------
# The expressions below are written as SQL text and parsed once on the JVM side:
# building ~1,000 Column objects one Py4J call at a time costs seconds per
# query, the parsed expression is the same tree.
def _dsql(v: float) -> str:
    v = float(v)
    if not math.isfinite(v):
        return f"CAST('{v}' AS DOUBLE)"
    return f"{v!r}D"


def _filled_sql(name: str, model: LinearModel) -> str:
    return f"coalesce(CAST(`{name}` AS DOUBLE), {_dsql(model.fills.get(name, 0.0))})"


def _scaled_sql(x: str, mean: float, std: float) -> str:
    div = std if std and std > 0 and math.isfinite(std) else 1.0
    return f"(({x} - {_dsql(mean)}) / {_dsql(div)})"


def linear_score_sql(model: LinearModel) -> str:
    z = _dsql(model.intercept)
    for n in model.features:
        scaled = _scaled_sql(_filled_sql(n, model), model.means.get(n, 0.0), model.scales.get(n, 1.0))
        z = f"({z} + {_dsql(model.weights.get(n, 0.0))} * {scaled})"
    return z


def linear_score(model: LinearModel) -> Column:
    """Logit z = intercept + sum(w * (filled - mean) / scale), summed left to right."""
    return F.expr(linear_score_sql(model))


def _contributions_sql(model: LinearModel, contribution: str) -> str:
    if contribution not in ("raw", "scaled"):
        raise ValueError("contribution must be 'raw' or 'scaled'")
    items = []
    for i, n in enumerate(model.features):
        v = _filled_sql(n, model)
        if contribution == "scaled":
            v = _scaled_sql(v, model.means.get(n, 0.0), model.scales.get(n, 1.0))
        items.append(f"named_struct('pos', {i}, 'code', '{n}', 'c', {_dsql(model.weights.get(n, 0.0))} * {v})")
    return f"array({', '.join(items)})"


def top_reasons(model: LinearModel, k: int = TOP_REASONS, contribution: str = "raw") -> Column:
    """Top-k reason codes by |contribution| (the double rounded half-to-even at 6 digits), ties in feature order.

    contribution = weight x filled raw value (``raw``, as the reference) or x scaled value (``scaled``).
    Direction is UP when the unrounded contribution is >= 0.
    """
    rounded = F.transform(F.expr(_contributions_sql(model, contribution)), lambda s: F.struct(
        s["pos"].alias("pos"), s["code"].alias("code"), s["c"].alias("c"), round_exact(s["c"]).alias("contribution")))
    ordered = F.array_sort(F.transform(rounded, lambda s: F.struct(
        (-F.abs(s["contribution"])).alias("k"), s["pos"].alias("pos"), s["code"].alias("code"), s["contribution"].alias("contribution"),
        F.when(s["c"] >= 0, "UP").otherwise("DOWN").alias("direction"))))
    return F.transform(F.slice(ordered, 1, k), lambda s: F.struct(
        s["code"].alias("code"), s["contribution"].alias("contribution"), s["direction"].alias("direction")))


def score_batch(df: DataFrame, model: LinearModel, key: list[str] = ("drive_id", "day"),
                contribution: str = "raw", scored_at: Column | None = None,
                with_reasons: bool = True) -> DataFrame:
    """Score every row: probability, bucket, reasons, version, one scored_at for the batch.

    The input must carry exactly the model's features as columns (check with
    ``schema_mismatch`` first); missing values are filled with the training means.
    """
    missing = [n for n in model.features if n not in df.columns]
    if missing:
        raise ValueError(f"Feature schema mismatch. Missing keys: {sorted(missing)}.")
    p = F.expr(f"1.0D / (1.0D + exp(-({linear_score_sql(model)})))")
    cols = [*key, p.alias("risk_score")]
    out = df.select(*cols, *([top_reasons(model, contribution=contribution).alias("top_reasons")]
                             if with_reasons else []))
    return out.select(*key, "risk_score", risk_bucket("risk_score").alias("risk_bucket"),
                      *(["top_reasons"] if with_reasons else []),
                      F.lit(model.version).alias("model_version"),
                      (scored_at if scored_at is not None else F.current_timestamp()).alias("scored_at"))


def fixed_model(features: list[str], version: str = "fixed-v1") -> LinearModel:
    """A deterministic literal model (rule-generated coefficients) for parity tests and demos."""
    w, mu, sc = {}, {}, {}
    for i, n in enumerate(features):
        w[n] = ((i * 7) % 11 - 5) / 40.0
        mu[n] = float((i * 3) % 5)
        sc[n] = float(1 + (i % 4))
    w["capacity_bytes"] = 1e-13 if "capacity_bytes" in w else 0.0
    mu["capacity_bytes"] = 2.5e12 if "capacity_bytes" in mu else 0.0
    sc["capacity_bytes"] = 1.1e12 if "capacity_bytes" in sc else 1.0
    return LinearModel(features=list(features), weights=w, intercept=-1.5, means=mu, scales=sc,
                       fills=dict(mu), version=version)


def impute(df: DataFrame, columns: list[str], fills: dict[str, float]) -> DataFrame:
    """Nulls and non-finite values of ``columns`` replaced by their fill (a training mean)."""
    return df.withColumns({c: F.coalesce(F.when(is_finite(F.col(c).cast("double")), F.col(c)), F.lit(fills[c])) for c in columns})
