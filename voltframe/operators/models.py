"""Linear models from one Gram aggregate, screening, stationarity, closed-form
forecasts, and Spark ML classifiers.

Only p x p matrices (p = number of regressors) reach the driver: the data are
reduced by one array-valued aggregate of products (``moments``), the normal
equations are solved with NumPy, and the coefficients go back into the plan as
literals.  No loop touches rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import join_small, materialize, scratch_path
from . import moments, series


# --- least squares --------------------------------------------------------------------------

def ols(df: DataFrame, features: Sequence[str], target: str, intercept: bool = True) -> dict:
    """Least squares from X'X, X'y (one pass).  Returns coefficients,
    standard errors, residual variance, n."""
    xs = list(features)
    if intercept:
        g, n, means = moments.co_moments(df, [*xs, target])
    else:
        (g, n), means = moments.products(df, [*xs, target]), None
    return _solve(g, n, means, xs, intercept)


def _square(row: dict, k: int) -> np.ndarray:
    g = np.zeros((k, k))
    for i in range(k):
        for j in range(i, k):
            g[i, j] = g[j, i] = row[f"s_{i}_{j}"] or 0.0
    return g


def _solve(g: np.ndarray, n: int, means: np.ndarray | None, xs: list[str], intercept: bool) -> dict:
    """Normal equations of scaled columns; a column without variation, or one that
    others span, gets the least-norm share instead of an error."""
    k = len(xs)
    scale = np.sqrt(np.maximum(np.diag(g)[:k], 0.0))
    scale[scale == 0] = 1.0
    xtx, xty, yty = g[:k, :k] / np.outer(scale, scale), g[:k, k] / scale, g[k, k]
    inverse = np.linalg.pinv(xtx, rcond=1e-12, hermitian=True)
    scaled = inverse @ xty
    sse = max(float(yty - 2 * scaled @ xty + scaled @ xtx @ scaled), 0.0)
    s2 = sse / max(n - k - intercept, 1)
    beta, cov = scaled / scale, s2 * inverse / np.outer(scale, scale)
    names, var = list(xs), np.diag(cov)
    if intercept:
        mean_x, mean_y = means[:k], means[k]
        names, beta = ["intercept", *names], np.r_[mean_y - mean_x @ beta, beta]
        var = np.r_[s2 / max(n, 1) + mean_x @ cov @ mean_x, var]
    return {"names": names, "beta": beta, "se": np.sqrt(np.maximum(var, 0.0)), "s2": s2, "n": n, "sse": sse}


def linear_expr(fit: dict) -> Column:
    """The fitted linear score as a Catalyst expression of literals."""
    e = F.lit(0.0)
    for name, b in zip(fit["names"], fit["beta"]):
        e = e + (F.lit(float(b)) if name == "intercept" else F.lit(float(b)) * F.col(name).cast("double"))
    return e


def vif_screen(df: DataFrame, features: Sequence[str], limit: float = 10.0, min_features: int = 5) -> list[dict]:
    """A32 (T32): VIF_i = G_ii * (G^-1)_ii with G = X'X (no intercept); columns that
    earlier ones span go first (their VIF is infinite, shown as None), then the
    largest while it exceeds ``limit`` and more than ``min_features`` remain.
    One aggregate; each step is a rank-one update of the small matrix."""
    g, _ = moments.products(df, features)
    return moments.screened(g, features, limit, min_features)


def selected(steps: list[dict]) -> list[str]:
    """The columns left after the last step of a screening."""
    last = max((s["step"] for s in steps if s["vif"] is not None), default=0)
    return [s["feature"] for s in steps if s["step"] == last and s["vif"] is not None]


# --- stationarity -------------------------------------------------------------------------------

def adf_kpss(df: DataFrame, cols: Sequence[str], order: str = "ts", adf_lags: int = 1,
             kpss_lags: int | None = None, adf_crit: float = -2.86, kpss_crit: float = 0.463) -> list[dict]:
    """A33 (re-aimed): ADF t statistic of the lagged level in
    dy_t = a + b y_{t-1} + sum c_j dy_{t-j} + e  (constant, fixed lags), and the
    KPSS level statistic  sum S_t^2 / (T^2 * lrv)  with Bartlett weights.

    All series at once: they are stacked to (series, time, value) without their
    NULLs; lags and running sums are halo windows and two-level prefix sums keyed
    by series; one grouped aggregate leaves a row a series.  The number of jobs
    does not depend on the number of series."""
    long = df.select(order, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot([order], list(cols), "series", "x").filter(F.col("x").isNotNull())
    long = materialize(series.add_row_index(long, order, ["series"], idx="idx"), "stacked")
    sizes = long.groupBy("series").agg(F.count("x").alias("n"), F.avg("x").alias("mean"))
    lags = {r["series"]: int(4 * (r["n"] / 100.0) ** 0.25) if kpss_lags is None else kpss_lags for r in sizes.collect()}
    most = max(lags.values(), default=0)
    d = join_small(long, sizes.select("series", "mean"), "series").withColumn("e", F.col("x") - F.col("mean"))

    def build(w):
        back = {f"d{j}": F.lag("x", j).over(w) - F.lag("x", j + 1).over(w) for j in range(1, adf_lags + 1)}
        return {"l1": F.lag("x", 1).over(w), "dy": F.col("x") - F.lag("x", 1).over(w), **back,
                **{f"e{k}": F.lag("e", k).over(w) for k in range(1, most + 1)}}

    d = series.ordered(d, build, order=order, keys=["series"], reach=max(adf_lags + 1, most), idx="idx")
    d = series.prefix_sums(d, ["e"], "idx", ["series"], block=F.floor(F.col("idx") / F.lit(series.DEFAULT_BLOCK_ROWS)))
    xs = ["l1", *[f"d{j}" for j in range(1, adf_lags + 1)], "dy"]
    d = d.withColumns({f"_{c}": F.when(F.col(f"d{adf_lags}").isNotNull() if adf_lags else F.col("l1").isNotNull(), F.col(c)) for c in xs})
    aggs = [F.covar_pop(f"_{a}", f"_{b}").alias(f"s_{i}_{j}") for i, a in enumerate(xs) for j, b in enumerate(xs) if i <= j]
    stats = d.groupBy("series").agg(
        F.count("x").alias("T"), F.count("_dy").alias("n"), *aggs, *[F.avg(f"_{c}").alias(f"m_{i}") for i, c in enumerate(xs)],
        F.sum(F.col("e_cum") * F.col("e_cum")).alias("ss"), F.sum(F.col("e") * F.col("e")).alias("g0"),
        *[F.sum(F.col("e") * F.col(f"e{k}")).alias(f"g{k}") for k in range(1, most + 1)])
    found = {r["series"]: r.asDict() for r in stats.collect()}
    return [_decided(c, found.get(c), xs, adf_lags, lags.get(c, 0), adf_crit, kpss_crit) for c in cols]


def _decided(name: str, stats: dict | None, xs: list[str], adf_lags: int, lags: int, adf_crit: float, kpss_crit: float) -> dict:
    """Statistics and decisions of one series; NaN (not stationary) where a
    statistic is not defined: a constant series, or too few rows."""
    adf = kpss = float("nan")
    if stats is not None:
        k = len(xs) - 1
        g = _square(stats, k + 1) * stats["n"]
        left = np.linalg.matrix_rank(g[:k, :k] / np.outer(*[np.sqrt(np.maximum(np.diag(g)[:k], 1e-300))] * 2), tol=1e-10) if stats["n"] > k + 1 else 0
        if left == k:
            fit = _solve(g, stats["n"], np.array([stats[f"m_{i}"] for i in range(k + 1)]), xs[:k], True)
            adf = float(fit["beta"][1] / fit["se"][1]) if fit["se"][1] > 0 else adf
        t = float(stats["T"])
        lrv = stats["g0"] / t + sum(2.0 * (1.0 - j / (lags + 1.0)) * (stats[f"g{j}"] or 0.0) / t for j in range(1, lags + 1))
        kpss = stats["ss"] / (t * t * lrv) if lrv > 0 else kpss
    return {"series": name, "adf_stat": adf, "adf_stationary": bool(adf < adf_crit), "kpss_stat": float(kpss), "kpss_stationary": bool(kpss < kpss_crit),
            "stationary": bool(adf < adf_crit and kpss < kpss_crit), "lags_adf": adf_lags, "lags_kpss": lags, "rows": int(stats["T"]) if stats else 0}


# --- closed-form multi-step forecasts ---------------------------------------------------------

def var_select_and_fit(df: DataFrame, cols: Sequence[str], max_order: int = 4, order: str = "ts",
                       train_filter: Column | None = None) -> dict:
    """VAR(p) for p <= max_order chosen by AIC on one common sample; one
    Gram aggregate over [1, lags 1..max_order of every series, targets]."""
    cols = list(cols)
    k = len(cols)

    def build(w):
        return {f"_v{j}_{c}": F.lag(c, j).over(w) for c in cols for j in range(1, max_order + 1)}

    d = series.ordered(df, build, order=order, reach=max_order)
    if train_filter is not None:
        d = d.filter(train_filter)
    d = d.withColumn("_one", F.lit(1.0))
    lag_names = [f"_v{j}_{c}" for j in range(1, max_order + 1) for c in cols]
    g, n = moments.products(d, ["_one"] + lag_names + cols)
    best = None
    for p in range(1, max_order + 1):
        xs = [0] + [1 + (j - 1) * k + i for j in range(1, p + 1) for i in range(k)]
        ys = [1 + max_order * k + i for i in range(k)]
        xtx = g[np.ix_(xs, xs)]
        xty = g[np.ix_(xs, ys)]
        yty = g[np.ix_(ys, ys)]
        b = np.linalg.solve(xtx, xty)
        sigma = (yty - b.T @ xty - xty.T @ b + b.T @ xtx @ b) / n
        sign, logdet = np.linalg.slogdet(sigma)
        aic = logdet + 2.0 * p * k * k / n
        if best is None or aic < best["aic"]:
            best = {"order": p, "aic": float(aic), "coef": b, "n": n, "cols": cols}
    return best


def var_two_step_expr(fit: dict, target: str) -> Column:
    """Two-step-ahead sum of the target change from lags at t (W14 closed form).

    Needs columns ``_v{j}_{c}`` (lag j) and ``c`` (value at t) for j < p.
    """
    cols, p, b = fit["cols"], fit["order"], fit["coef"]
    k = len(cols)
    ti = cols.index(target)

    def lagged(c, j):  # value of series c at t + 1 - j (j >= 1 means t+1-j)
        return F.col(c) if j == 1 else F.col(f"_v{j - 1}_{c}")

    # one-step forecasts of every series at t+1
    step1 = {}
    for i, ci in enumerate(cols):
        e = F.lit(float(b[0, i]))
        for j in range(1, p + 1):
            for m, cm in enumerate(cols):
                e = e + F.lit(float(b[1 + (j - 1) * k + m, i])) * lagged(cm, j)
        step1[ci] = e
    # two-step forecast of the target at t+2: lag 1 is the forecast at t+1
    e2 = F.lit(float(b[0, ti]))
    for j in range(1, p + 1):
        for m, cm in enumerate(cols):
            v = step1[cm] if j == 1 else lagged(cm, j - 1)
            e2 = e2 + F.lit(float(b[1 + (j - 1) * k + m, ti])) * v
    return step1[target] + e2


# --- Spark ML classifiers ----------------------------------------------------------------------

def filled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles, a NULL or NaN as 0: every row in gets a score."""
    zero = F.lit(0.0)
    return df.withColumns({c: F.nanvl(F.coalesce(F.col(c).cast("double"), zero), zero) for c in features})


def fit_classifier(train: DataFrame, features: Sequence[str], label: str, kind: str = "logistic",
                   weight: str | None = None, reg_param: float = 0.0, seed: int = 607):
    """Pipeline(VectorAssembler, StandardScaler, LogisticRegression | GBT)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    asm = VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="error")
    sc = StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True)
    if kind == "logistic":
        clf = LogisticRegression(featuresCol="_features", labelCol=label, maxIter=100, regParam=reg_param)
    else:
        clf = GBTClassifier(featuresCol="_features", labelCol=label, maxIter=20, maxDepth=3, seed=seed)
    if weight:
        clf.setWeightCol(weight)
    return Pipeline(stages=[asm, sc, clf]).fit(filled(train, features).withColumn(label, F.col(label).cast("double")))


def score(model, df: DataFrame) -> DataFrame:
    """``df`` with the positive-class probability as ``y_prob`` (vector_to_array, no
    UDF); as many rows as ``df`` has, its columns as they are."""
    from pyspark.ml.functions import vector_to_array

    features = model.stages[0].getInputCols()
    inputs = {c: f"_in_{k}" for k, c in enumerate(features)}
    kept = df.withColumns({inputs[c]: F.col(c) for c in features})
    out = model.transform(filled(kept, features))
    out = out.withColumn("y_prob", vector_to_array("probability")[1]).drop(*features, "_raw", "_features", "probability", "rawPrediction", "prediction")
    return out.withColumnsRenamed({v: k for k, v in inputs.items()}).select(*[c for c in df.columns if c != "y_prob"], "y_prob")


def store_model(model, spark, name: str) -> str:
    """Writes a fitted pipeline to the shared folder; its path."""
    path = scratch_path(spark, f"models/{name}-{uuid.uuid4().hex[:12]}")
    model.write().overwrite().save(path)
    return path


def stored_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


# --- permutation importance --------------------------------------------------------------------

def linear_weights(model) -> list[float]:
    """What one unit of each raw feature adds to the margin of a fitted logistic pipeline."""
    scale, fitted = model.stages[1].std.toArray(), model.stages[2].coefficients.toArray()
    return [float(w / s) if s > 0 else 0.0 for w, s in zip(fitted, scale)]


def donors(rows: DataFrame, repeats: int, seed: int, idx: str = "idx") -> DataFrame:
    """``rep``, ``idx`` and ``donor``: a permutation of the row numbers for each
    repeat, the order of ``xxhash64(seed, rep, idx)`` by a two-level row index."""
    reps = rows.select(idx, F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("rep"))
    reps = reps.withColumn("_h", F.xxhash64(F.lit(seed), F.col("rep"), F.col(idx)))
    ranked = series.add_row_index(reps, "_h", keys=["rep"], idx="pos", block_width=float(2 ** 58))
    return ranked.select("rep", F.col("pos").alias(idx), F.col(idx).alias("donor"))


def permuted_counts(rows: DataFrame, weights: dict[str, float], label: str, cut: float, repeats: int, seed: int,
                    margin: str = "margin", idx: str = "idx") -> DataFrame:
    """``feature``, ``rep`` and the confusion counts at ``cut`` where that one
    feature's values are permuted.

    A permuted feature moves the margin of a linear model by weight * (donor's
    value - own value), so a row and repeat is one array of margins, whatever the
    number of features; the counts of all features are one aggregate a repeat."""
    features = list(weights)
    values = filled(rows, features).select(idx, label, margin, F.array(*features).alias("x"))
    given = values.select(F.col(idx).alias("donor"), F.col("x").alias("given"))
    pairs = values.join(donors(rows, repeats, seed, idx), idx).join(given, "donor")
    moved = F.zip_with(F.array(*[F.lit(weights[c]) for c in features]), F.zip_with("given", "x", lambda a, b: a - b), lambda w, d: w * d)
    hits = pairs.select("rep", (F.col(label) == 1).alias("pos"),
                        F.transform(moved, lambda m: 1.0 / (1.0 + F.exp(-(F.col(margin) + m))) >= F.lit(cut)).alias("hit"))
    counts = [F.count_if(F.col("hit")[k] & F.col("pos")).alias(f"tp{k}") for k in range(len(features))]
    counts += [F.count_if(F.col("hit")[k]).alias(f"pp{k}") for k in range(len(features))]
    sums = hits.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.count_if("pos").alias("p"), *counts)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"tp{k}").alias("tp"), F.col(f"pp{k}").alias("pp")) for k, c in enumerate(features)]))
    c = sums.select("rep", "n", "p", each.alias("c"))
    return c.select("c.feature", "rep", "c.tp", (F.col("c.pp") - F.col("c.tp")).alias("fp"), (F.col("p") - F.col("c.tp")).alias("fn"),
                    (F.col("n") - F.col("p") - F.col("c.pp") + F.col("c.tp")).alias("tn"))
