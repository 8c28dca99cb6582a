"""Hand-computable cases for the rows-only model operators (Gram-aggregate fits)."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltframe.operators import models as M


def _series(spark, values, cols):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=i), *map(float, v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, " + ", ".join(f"{c} double" for c in cols))


def test_ols_recovers_exact_coefficients(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 2))
    y = 2.0 + 3.0 * x[:, 0] - 1.0 * x[:, 1]
    df = _series(spark, np.column_stack([x, y]), ["x1", "x2", "y"])
    fit = M.ols(df, ["x1", "x2"], "y")
    assert fit["names"] == ["intercept", "x1", "x2"]
    assert fit["beta"] == pytest.approx([2.0, 3.0, -1.0], abs=1e-9)
    assert fit["s2"] == pytest.approx(0.0, abs=1e-12)
    pred = df.select((F.col("y") - M.linear_expr(fit)).alias("r")).agg(F.max(F.abs("r"))).first()[0]
    assert pred < 1e-9


def test_vif_of_orthogonal_columns_is_one(spark):
    vals = [(1, 0, 1), (0, 1, 1), (1, 0, -1), (0, 1, -1)] * 5
    df = _series(spark, vals, ["a", "b", "c"])
    steps = M.vif_screen(df, ["a", "b", "c"], limit=10.0, min_features=1)
    assert [round(s["vif"], 9) for s in steps] == [1.0, 1.0, 1.0]


def test_vif_drops_collinear_feature(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=300)
    b = rng.normal(size=300)
    c = a + b + rng.normal(scale=0.01, size=300)
    d = rng.normal(size=300)
    df = _series(spark, np.column_stack([a, b, c, d]), ["a", "b", "c", "d"])
    steps = M.vif_screen(df, ["a", "b", "c", "d"], limit=10.0, min_features=2)
    last = max(s["step"] for s in steps)
    kept = {s["feature"] for s in steps if s["step"] == last}
    assert last >= 1 and len(kept) == 3 and all(s["vif"] <= 10 for s in steps if s["step"] == last)


def test_adf_kpss_separate_noise_from_random_walk(spark):
    rng = np.random.default_rng(3)
    noise = rng.normal(size=500)
    walk = np.cumsum(rng.normal(size=500))
    df = _series(spark, np.column_stack([noise, walk]), ["noise", "walk"])
    out = {r["series"]: r for r in M.adf_kpss(df, ["noise", "walk"])}
    assert out["noise"]["adf_stationary"] and out["noise"]["kpss_stationary"]
    assert not out["walk"]["adf_stationary"] and not out["walk"]["kpss_stationary"]


def _numpy_var(y, max_order):
    """Reference VAR order selection on the common sample: (order, coefficients)."""
    n = len(y) - max_order
    best = None
    for p in range(1, max_order + 1):
        x = np.column_stack([np.ones(n)] + [y[max_order - j:len(y) - j] for j in range(1, p + 1)])
        b = np.linalg.lstsq(x, y[max_order:], rcond=None)[0]
        e = y[max_order:] - x @ b
        aic = np.linalg.slogdet(e.T @ e / n)[1] + 2 * p * y.shape[1] ** 2 / n
        if best is None or aic < best[0]:
            best = (aic, p, b)
    return best[1], best[2]


def test_var_order_and_coefficients_match_numpy(spark):
    rng = np.random.default_rng(4)
    a = np.array([[0.5, 0.2], [-0.3, 0.4]])
    y = np.zeros((1500, 2))
    for t in range(1, 1500):
        y[t] = a @ y[t - 1] + rng.normal(scale=0.1, size=2)
    df = _series(spark, y, ["u", "v"])
    fit = M.var_select_and_fit(df, ["u", "v"], max_order=3)
    order, coef = _numpy_var(y, 3)
    assert fit["order"] == order
    assert np.allclose(fit["coef"], coef, atol=1e-8)


def test_classifier_pipeline_scores_probabilities(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 2))
    y = (x[:, 0] + 0.5 * x[:, 1] > 0).astype(float)
    df = _series(spark, np.column_stack([x, y]), ["a", "b", "y"]).withColumn("y", F.col("y").cast("int"))
    model = M.fit_classifier(df, ["a", "b"], "y")
    s = M.score(model, df)
    acc = s.select(((F.col("y_prob") >= 0.5).cast("int") == F.col("y")).cast("double").alias("ok")).agg(
        F.avg("ok")).first()[0]
    assert acc > 0.95
    assert s.agg(F.min("y_prob"), F.max("y_prob")).first()[0] >= 0.0
