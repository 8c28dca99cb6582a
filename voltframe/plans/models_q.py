"""Queries: fitted models (the fits are small driver maths on one aggregate of
products, or Spark ML estimators) -- A31-A33, M02, M05-M07, M09, M10."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import params as P
from ..functions import calendar as cal
from ..functions.columns import nan_to_null, normal_sf, r6
from ..operators import evaluate as E
from ..operators import models as M
from ..operators import prepare, series
from ..session import materialize
from . import linear_sql
from .inputs import hourly_system, wide_features
from .registry import register

#: changes that are candidates beside the engineered columns: source, hours
CHANGES = (("price", 1), ("price", 6), ("price", 24), ("load", 24), ("wind_total", 24), ("solar_total", 1), ("gas_total", 1),
           ("net_load", 1), ("reserve_margin", 1), ("net_export", 1), ("renewables_share", 1))
CHANGE_COLUMNS = tuple(f"{c}_change_{k}h" for c, k in CHANGES)
#: calendar terms and flags that enter the price equation without screening
ALWAYS = ("sin_day", "cos_day", "sin_week", "cos_week", "is_weekend", "is_event")
TARGET = "target_change_2h"


def candidates(columns) -> list[str]:
    """Every column that the role rules call continuous, and the changes."""
    own = {*CHANGE_COLUMNS, TARGET, "price_lead_2"}
    return [c for _, c, role in prepare.feature_catalog([c for c in columns if c not in own]) if role == "continuous"] + list(CHANGE_COLUMNS)


def equation_frame(spark, sf_dir):
    """The engineered table with the changes, the price two hours on and the
    target; rows where a candidate is missing go, as before a fit.  Written once."""
    w = wide_features(spark, sf_dir)
    build = series.combine(series.leads("price", [P.HORIZON], name="price_lead_2"),
                           lambda win: {f"{c}_change_{k}h": F.col(c) - F.lag(c, k).over(win) for c, k in CHANGES})
    w = series.ordered(w, build, reach=max(k for _, k in CHANGES)).withColumn(TARGET, F.col("price_lead_2") - F.col("price"))
    xs = candidates(w.columns)
    w = w.select("ts", "price_lead_2", TARGET, *xs, *ALWAYS).na.drop()
    return materialize(prepare.assign_split(w, P.HOURLY_SPLITS), "equation"), xs


def _stationary(w, xs):
    return M.adf_kpss(w.filter(F.col("split") == "train"), [TARGET, *xs], adf_crit=P.ADF_CRITICAL_5PCT, kpss_crit=P.KPSS_CRITICAL_5PCT)


def _screened(w, xs):
    """A33 -> A32: the stationary candidates, screened on the train rows."""
    held = [r["series"] for r in _stationary(w, xs) if r["stationary"] and r["series"] != TARGET]
    return M.vif_screen(w.filter(F.col("split") == "train"), held, P.VIF_LIMIT, P.VIF_MIN_FEATURES)


def _fitted(w, xs):
    """A33 -> A32 -> A31: the price equation."""
    return M.ols(w.filter(F.col("split") == "train"), [*M.selected(_screened(w, xs)), *ALWAYS], TARGET)


@register("stationarity", linear_sql.stationarity_sql())
def stationarity(spark, sf_dir):
    """ADF (constant, 1 lag) and KPSS (level, Bartlett) statistics with 5 %
    decisions of the target and every candidate, on the train rows, all in one pass."""
    schema = ("series string, adf_stat double, adf_stationary boolean, kpss_stat double, kpss_stationary boolean, "
              "stationary boolean, lags_adf int, lags_kpss int, rows long")
    out = spark.createDataFrame([tuple(r.values()) for r in _stationary(*equation_frame(spark, sf_dir))], schema)
    return out.withColumns({c: r6(nan_to_null(c)) for c in ("adf_stat", "kpss_stat")})


@register("vif_screen", linear_sql.vif_sql())
def vif_screen(spark, sf_dir):
    """Iterative VIF screening (uncentred, no intercept) of the stationary
    candidates on the train rows; a NULL is an infinite value."""
    steps = _screened(*equation_frame(spark, sf_dir))
    out = spark.createDataFrame([(s["step"], s["feature"], s["vif"]) for s in steps], "step int, feature string, vif double")
    return out.withColumn("vif", F.round("vif", 3))


@register("ols_price_change", linear_sql.ols_sql())
def ols_price_change(spark, sf_dir):
    """M09 + A31 + P34 + A26: the price equation of the selected candidates on the
    t+2 price change, price = current + predicted change, regression metrics per split."""
    w, xs = equation_frame(spark, sf_dir)
    pred = w.withColumn("forecast", F.col("price") + M.linear_expr(_fitted(w, xs)))
    out = E.regression_metrics(pred, "price_lead_2", "forecast", ["split"], P.SPIKE_THRESHOLD)
    return out.withColumns({c: r6(c) for c in ("rmse", "mae", "spike_f1", "spike_precision", "spike_recall",
                                              "predicted_spike_rate")})


@register("ols_coefficients", linear_sql.coefficients_sql())
def ols_coefficients(spark, sf_dir):
    """Coefficients and standard errors of the price equation."""
    fit = _fitted(*equation_frame(spark, sf_dir))
    rows = [(n, float(b), float(s)) for n, b, s in zip(fit["names"], fit["beta"], fit["se"])]
    return spark.createDataFrame(rows, "term string, coefficient double, std_error double").select(
        "term", F.round("coefficient", 5).alias("coefficient"), F.round("std_error", 5).alias("std_error"))


FOURIER = ("sin_day_1", "cos_day_1", "sin_day_2", "cos_day_2", "sin_week_1", "cos_week_1")


@register("ar_forecast", linear_sql.train_forecast_sql())
def ar_forecast(spark, sf_dir):
    """M02 (re-aimed SARIMAX(3,1,1)+Fourier): AR(3) on first differences plus 6
    Fourier terms, fitted on train by OLS; leak-free two-step forecast from rows
    up to t; variance s2*((1+phi1)^2+1); spike probability via the normal tail."""
    h = hourly_system(spark, sf_dir).select("ts", "price")

    def build(w):
        lag = lambda k: F.lag("price", k).over(w)
        return {"_d0": F.col("price") - lag(1), "_d1": lag(1) - lag(2), "_d2": lag(2) - lag(3), "_d3": lag(3) - lag(4),
                "price_lead_2": F.lead("price", P.HORIZON).over(w)}

    d = series.ordered(h, build, reach=4).withColumns(cal.fourier_week_hours("ts"))
    d = materialize(prepare.assign_split(d, P.HOURLY_SPLITS), "ar")
    fit = M.ols(d.filter(F.col("split") == "train"), ["_d1", "_d2", "_d3", *FOURIER], "_d0", intercept=False)
    phi = dict(zip(fit["names"], fit["beta"]))

    def fourier_at(hours):
        t = F.col("ts") + F.make_dt_interval(hours=F.lit(hours))
        return cal.fourier_week_hours(t)

    f1, f2 = fourier_at(1), fourier_at(2)
    ex1 = sum((F.lit(float(phi[k])) * f1[k] for k in FOURIER), F.lit(0.0))
    ex2 = sum((F.lit(float(phi[k])) * f2[k] for k in FOURIER), F.lit(0.0))
    p1, p2, p3 = (float(phi[k]) for k in ("_d1", "_d2", "_d3"))
    step1 = F.lit(p1) * F.col("_d0") + F.lit(p2) * F.col("_d1") + F.lit(p3) * F.col("_d2") + ex1
    step2 = F.lit(p1) * step1 + F.lit(p2) * F.col("_d0") + F.lit(p3) * F.col("_d1") + ex2
    se = float(np.sqrt(fit["s2"] * ((1 + p1) ** 2 + 1)))
    out = (d.filter(F.col("split") != "train").filter(F.col("_d2").isNotNull())
            .withColumn("forecast", F.col("price") + step1 + step2))
    z = (F.lit(P.SPIKE_THRESHOLD) - F.col("forecast")) / F.lit(max(se, 1e-6))
    return out.select("ts", "split", "price_lead_2", r6("forecast").alias("forecast"),
                      r6(F.lit(se)).alias("forecast_se"), r6(normal_sf(z)).alias("spike_prob"))


VAR_SERIES = ("d_price", "d_load", "d_wind", "d_gas")


@register("var_forecast")
def var_forecast(spark, sf_dir):
    """VAR on four change series, order <= 4 by AIC, two-step price-change
    sum as a closed-form column expression; the fit on train forecasts
    validation, a refit on train and validation forecasts test."""
    from ..operators.system import system_features
    h = system_features(hourly_system(spark, sf_dir)).select("ts", "price", "load", "wind_total", "gas_total")

    def build(w):
        return {"d_price": F.col("price") - F.lag("price", 1).over(w), "d_load": F.col("load") - F.lag("load", 1).over(w),
                "d_wind": F.col("wind_total") - F.lag("wind_total", 1).over(w),
                "d_gas": F.col("gas_total") - F.lag("gas_total", 1).over(w),
                "price_lead_2": F.lead("price", P.HORIZON).over(w)}

    d = prepare.assign_split(series.ordered(h, build, reach=P.HORIZON), P.HOURLY_SPLITS)
    d = materialize(d.filter(F.col("d_price").isNotNull()), "var")

    def lags(w):
        return {f"_v{j}_{c}": F.lag(c, j).over(w) for c in VAR_SERIES for j in range(1, 5)}

    e = materialize(series.ordered(d, lags, reach=4), "var-lags")
    outs = []
    for split, seen in (("validation", ["train"]), ("test", ["train", "validation"])):
        fit = M.var_select_and_fit(d, VAR_SERIES, max_order=4, train_filter=F.col("split").isin(*seen))
        mine = e.filter((F.col("split") == split) & F.col(f"_v{max(fit['order'] - 1, 1)}_d_price").isNotNull())
        mine = mine.withColumn("forecast", F.col("price") + M.var_two_step_expr(fit, "d_price"))
        outs.append(mine.select("ts", "split", "price_lead_2", r6("forecast").alias("forecast"),
                                F.lit(fit["order"]).alias("var_order"), F.lit(fit["aic"]).alias("aic")))
    return outs[0].unionByName(outs[1])


#: penalty where many features say much the same
REGULARISED = 0.01


def model_features(columns) -> list[str]:
    """Every column that the role rules do not exclude is a model feature."""
    return [c for _, c, role in prepare.feature_catalog(columns) if role != "excluded"]


def _clf_frame(spark, sf_dir):
    """The engineered table with split and label, written once, and its model features."""
    w = prepare.assign_split(wide_features(spark, sf_dir), P.HOURLY_SPLITS)
    features = model_features(w.columns)
    w = w.select("ts", "split", F.col("spike_lead_2").alias("y_true"), *features)
    return materialize(w, "classifier"), features


def _weighted(w, train):
    """``w`` with the class weight of the ``train`` rows alone."""
    cw = prepare.class_weight(train, "y_true", guard_pos=True, floor_one=True).first()
    return w.withColumn("w", F.when(F.col("y_true") == 1, F.lit(float(cw["pos_weight"] or 1.0))).otherwise(F.lit(1.0)))


def _fitted_models(spark, w, features) -> dict[str, str]:
    """Kind -> path of the stored pipeline: class-weighted logistic regression and a
    GBT, fitted on the train rows and written to the shared folder."""
    train = _weighted(w, w.filter(F.col("split") == "train")).filter(F.col("split") == "train")
    return {kind: M.store_model(M.fit_classifier(train, features, "y_true", kind=kind, weight="w", reg_param=REGULARISED), spark, kind)
            for kind in ("logistic", "gbt")}


def _stored_scores(rows, paths: dict[str, str]):
    """Scores of ``rows`` by each stored pipeline, read back from its path."""
    outs = [M.score(M.stored_model(path), rows).select(F.lit(kind).alias("model"), "ts", "split", "y_true", r6("y_prob").alias("y_prob"))
            for kind, path in paths.items()]
    return outs[0].unionByName(outs[1])


@register("classifier_scores")
def classifier_scores(spark, sf_dir):
    """Class-weighted logistic regression and a GBT on the engineered
    features (train fit, standardised inside the pipeline, a missing feature counts
    as 0), stored in the shared folder; validation and test rows scored from there."""
    w, features = _clf_frame(spark, sf_dir)
    return _stored_scores(w.filter(F.col("split") != "train"), _fitted_models(spark, w, features))


@register("fitted_model_comparison")
def fitted_model_comparison(spark, sf_dir):
    """The stored classifiers beside the four baselines: thresholds chosen on
    validation, twelve metrics each, the best test F1 first."""
    from .evaluate_q import baselines_long

    w, features = _clf_frame(spark, sf_dir)
    fitted = _stored_scores(w.filter(F.col("split") != "train"), _fitted_models(spark, w, features))
    base = baselines_long(spark, sf_dir).filter(F.col("split") != "train").select(*fitted.columns)
    scores = materialize(fitted.unionByName(base), "model-scores")
    return E.compared(scores, P.GRID_BASELINE).orderBy(F.desc("test_f1"), "model")


CV_CANDIDATES = (0.001, 0.01, 0.1)


def logistic_factory(candidate, features):
    """Default estimator factory of the search: fits rows with label y_true and weight w."""
    return lambda train: M.fit_classifier(train, features, "y_true", weight="w", reg_param=candidate)


@register("cv_search")
def cv_search(spark, sf_dir, build_fn=logistic_factory):
    """M06/F03 + W13 + A29 + A34: candidates x 5 expanding folds over the train and
    validation rows; mean / std of fold F1; best candidate flagged.
    ``build_fn(candidate, features)`` gives a function that fits the fold's own
    training rows, whose class weight comes from these rows alone."""
    w, features = _clf_frame(spark, sf_dir)
    d = series.add_row_index(w.filter(F.col("split") != "test"), "ts", idx="idx")
    d = materialize(d, "cv")
    n = d.count()
    size = n // (P.CV_SPLITS + 1)

    def run(task):
        cand, fold = task
        start = n - (P.CV_SPLITS - fold) * size
        train = d.filter(F.col("idx") < start)
        m = build_fn(cand, features)(_weighted(train, train))
        s = M.score(m, d.filter((F.col("idx") >= start) & (F.col("idx") < start + size)))
        c = E.confusion(s, [], (F.col("y_prob") >= 0.5).cast("int")).first()
        return (float(cand), fold, float(c["f1"]))

    # independent (candidate, fold) fits are submitted as concurrent Spark jobs
    from concurrent.futures import ThreadPoolExecutor
    tasks = [(c, f) for c in CV_CANDIDATES for f in range(P.CV_SPLITS)]
    with ThreadPoolExecutor(max_workers=4) as pool:
        rows = list(pool.map(run, tasks))
    scores = spark.createDataFrame(rows, "candidate double, fold int, f1 double")
    summ = E.cv_summary(scores, "candidate", "f1")
    # the summary has one row per candidate (a literal list of 3): a global order is fine here
    best = F.row_number().over(Window.orderBy(F.col("mean_f1").desc(), F.col("candidate").asc()))
    return summ.withColumn("is_best", best == 1)


PERM_REPEATS = 3
PERM_TOP = 20
PERM_SEED = 607


@register("permutation_importance")
def permutation_importance(spark, sf_dir):
    """F1 change when one feature's validation values are permuted (3 repeats),
    at the threshold selected on validation; the 20 largest.

    The model is linear, so a permuted feature moves the margin by its weight times
    the difference: one array of margins for each row and repeat, no row of its own
    for each feature (``models.permuted_counts``)."""
    w, features = _clf_frame(spark, sf_dir)
    model = M.fit_classifier(_weighted(w, w.filter(F.col("split") == "train")).filter(F.col("split") == "train"), features, "y_true", weight="w", reg_param=REGULARISED)
    rows = series.add_row_index(w.filter(F.col("split") == "validation"), "ts", idx="idx")
    rows = materialize(M.score(model, rows).withColumn("margin", F.log(F.col("y_prob")) - F.log1p(-F.col("y_prob"))), "validation")
    scored = rows.select(F.lit("m").alias("model"), "y_true", "y_prob")
    best = E.threshold_select(E.threshold_sweep(scored, ["model"], P.GRID_BASELINE), ["model"]).first()
    cut = float(best["threshold"]) if best else 0.5
    permuted = E.with_metrics(M.permuted_counts(rows, dict(zip(features, M.linear_weights(model))), "y_true", cut, PERM_REPEATS, PERM_SEED))
    base = E.confusion(scored.withColumn("y_pred", (F.col("y_prob") >= F.lit(cut)).cast("int")), [], "y_pred").first()
    b_f1, b_f2 = float(base["f1"] or 0.0), float(base["f2"] or 0.0)
    agg = permuted.groupBy("feature").agg(F.avg("f1").alias("permuted_f1"), F.avg("f2").alias("permuted_f2"))
    signed = F.lit(b_f1) - F.col("permuted_f1")
    out = agg.select("feature", F.lit(b_f1).alias("baseline_f1"), r6("permuted_f1").alias("permuted_f1"),
                     F.lit(b_f2).alias("baseline_f2"), r6("permuted_f2").alias("permuted_f2"),
                     r6(signed).alias("signed_importance_f1_change"), r6(F.abs(signed)).alias("absolute_importance_f1_change"),
                     F.when(signed > 0, "+").when(signed < 0, "-").otherwise("0").alias("impact_sign"),
                     F.when(signed > 0, "helps").when(signed < 0, "hurts").otherwise("neutral").alias("impact_direction"))
    return out.orderBy(F.desc("absolute_importance_f1_change"), "feature").limit(PERM_TOP)
