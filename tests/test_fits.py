"""Array aggregates, sweeps, running fits, stacked stationarity, delta scoring and
stored models, each against plain NumPy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltframe.operators import describe as D
from voltframe.operators import models as M
from voltframe.operators import moments, series


def table(spark, values, cols):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(hours=i), *[None if x is None or np.isnan(x) else float(x) for x in v]) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ts timestamp_ntz, " + ", ".join(f"{c} double" for c in cols))


def test_moments_of_many_columns_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(1e6, 3.0, (700, 30))
    x[::50, 4] = np.nan
    df = table(spark, x, [f"c{k}" for k in range(30)]).repartition(23)
    c, n, mean = moments.co_moments(df, [f"c{k}" for k in range(30)])
    full = x[~np.isnan(x).any(1)]
    assert n == len(full) and np.allclose(mean, full.mean(0), rtol=1e-14)
    assert np.allclose(c, (full - full.mean(0)).T @ (full - full.mean(0)), rtol=1e-9, atol=1e-6)
    assert moments.co_moments(df.limit(0), ["c0", "c1"])[1] == 0


def test_sweep_inverts_and_undoes():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(50, 6))
    g = x.T @ x
    a = g.copy()
    for k in range(6):
        moments.sweep(a, k)
    assert np.allclose(a, np.linalg.inv(g))
    for k in (3, 0, 5, 1, 2, 4):
        moments.sweep(a, k)
    assert np.allclose(a, g)


def test_screening_equals_inverse_at_every_step():
    rng = np.random.default_rng(3)
    x = rng.normal(2.0, 1.0, (300, 8))
    x[:, 5] = x[:, 0] + x[:, 1]                     # spanned by earlier columns
    x[:, 6] = x[:, 2] + 0.05 * rng.normal(size=300)
    g, names = x.T @ x, [f"c{k}" for k in range(8)]
    steps = moments.screened(g, names, 10.0, 2)
    assert [s["feature"] for s in steps if s["vif"] is None] == ["c5"]
    inside, step = [0, 1, 2, 3, 4, 6, 7], 0
    while True:
        sub = g[np.ix_(inside, inside)]
        want = np.diag(sub) * np.diag(np.linalg.inv(sub))
        assert [s["vif"] for s in steps if s["step"] == step and s["vif"] is not None] == pytest.approx(want.tolist(), rel=1e-8)
        if want.max() <= 10 or len(inside) <= 2:
            break
        inside.pop(int(want.argmax()))
        step += 1
    assert M.selected(steps) == [names[k] for k in inside]


@pytest.mark.parametrize("block", [8760, 16])
def test_running_fit_equals_a_fit_of_all_rows_so_far(spark, block):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=(90, 3)), np.zeros(90)])
    x[:, 3] = x[:, :3] @ [1.0, -2.0, 0.5] + 0.1 * rng.normal(size=90)
    x[7, 1] = np.nan
    df = table(spark, x, ["a", "b", "c", "y"])
    d = moments.running_products(df, ["a", "b", "c", "y"], block_rows=block, out="g")
    got = d.withColumn("fit", moments.solved(F.col("g"), F.col("g_n"), 3)).orderBy("ts").select("g_n", "fit.beta", "fit.s2").collect()
    for t, row in enumerate(got):
        seen = x[:t + 1][~np.isnan(x[:t + 1]).any(1)]
        assert row.g_n == len(seen)
        if len(seen) <= 6:
            assert row.beta is None
            continue
        beta, sse = np.linalg.lstsq(seen[:, :3], seen[:, 3], rcond=None)[:2]
        assert row.beta == pytest.approx(beta.tolist(), rel=1e-8) and row.s2 == pytest.approx(sse[0] / (len(seen) - 3), rel=1e-6)


def test_walk_forward_uses_no_later_rows(spark):
    rng = np.random.default_rng(5)
    price = np.cumsum(rng.normal(size=120)) + 50
    terms = lambda t: {"s": F.sin(F.hour(t) / 4.0), "c": F.cos(F.hour(t) / 4.0)}
    whole = moments.walk_forward(table(spark, price[:, None], ["p"]), "p", terms).orderBy("ts").collect()
    part = moments.walk_forward(table(spark, price[:80, None], ["p"]), "p", terms).orderBy("ts").collect()
    known = [r for r in part if r.forecast is not None]
    assert len(known) > 50
    for r, w in zip(part, whole):
        assert (r.forecast is None) == (w.forecast is None)
        assert r.forecast is None or (r.forecast == pytest.approx(w.forecast, rel=1e-9) and r.forecast_se == pytest.approx(w.forecast_se, rel=1e-9))
    t, d, hour = 79, np.diff(price[:80]), np.arange(120) % 24 / 4.0
    x = np.column_stack([d[2:-1], d[1:-2], d[:-3], np.sin(hour[4:80]), np.cos(hour[4:80])])
    b = np.linalg.lstsq(x, d[3:], rcond=None)[0]
    one = b @ [d[-1], d[-2], d[-3], np.sin(hour[t + 1]), np.cos(hour[t + 1])]
    two = b @ [one, d[-1], d[-2], np.sin(hour[t + 2]), np.cos(hour[t + 2])]
    assert whole[t].forecast == pytest.approx(price[t] + one + two, rel=1e-8)


def plain_adf_kpss(x):
    dy, l1, d1 = x[2:] - x[1:-1], x[1:-1], x[1:-1] - x[:-2]
    z = np.column_stack([np.ones(len(dy)), l1, d1])
    b = np.linalg.solve(z.T @ z, z.T @ dy)
    s2 = ((dy - z @ b) ** 2).sum() / (len(dy) - 3)
    e, lags = x - x.mean(), int(4 * (len(x) / 100) ** 0.25)
    lrv = e @ e / len(x) + sum(2 * (1 - k / (lags + 1)) * (e[k:] @ e[:-k]) / len(x) for k in range(1, lags + 1))
    return b[1] / np.sqrt(s2 * np.linalg.inv(z.T @ z)[1, 1]), (np.cumsum(e) ** 2).sum() / (len(x) ** 2 * lrv)


def test_stationarity_of_series_of_different_lengths(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(300, 5))
    x[:, 1] = np.cumsum(x[:, 1])
    x[rng.random(300) < 0.3, 2] = np.nan
    x[:, 3], x[3:, 4] = 7.0, np.nan                 # constant; three rows only
    out = {r["series"]: r for r in M.adf_kpss(table(spark, x, list("abcde")), list("abcde"))}
    for k, name in enumerate("abc"):
        adf, kpss = plain_adf_kpss(x[~np.isnan(x[:, k]), k])
        assert (out[name]["adf_stat"], out[name]["kpss_stat"]) == pytest.approx((adf, kpss), rel=1e-8)
    assert np.isnan(out["d"]["adf_stat"]) and not out["d"]["stationary"] and np.isnan(out["e"]["adf_stat"]) and out["e"]["rows"] == 3


def test_jobs_do_not_grow_with_the_series(spark):
    x = np.random.default_rng(7).normal(size=(60, 12))
    df = table(spark, x, [f"c{k}" for k in range(12)])
    tracker, counts = spark.sparkContext.statusTracker(), []
    for n in (2, 12):
        spark.sparkContext.setJobGroup(f"adf-{n}", "stationarity")
        M.adf_kpss(df, [f"c{k}" for k in range(n)])
        counts.append(len(tracker.getJobIdsForGroup(f"adf-{n}")))
    spark.sparkContext.setJobGroup("rest", "")
    assert counts[0] > 0 and counts[1] <= counts[0] + 2


def classified(spark, n=240):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(n, 4))
    x[:, 3] = (x[:, 0] - 0.5 * x[:, 1] + 0.3 * rng.normal(size=n)) > 0
    x[::5, 1] = np.nan
    return table(spark, x, ["a", "b", "k", "y"]).withColumn("k", F.lit(3.0)).withColumn("y", F.col("y").cast("int"))


def test_rows_with_missing_features_are_scored(spark):
    df = classified(spark)
    model = M.fit_classifier(df, ["a", "b", "k"], "y")
    scored = M.score(model, df)
    assert scored.count() == df.count() and scored.columns == [*df.columns, "y_prob"]
    assert scored.filter("y_prob is null").count() == 0 and scored.filter("b is null").count() == df.filter("b is null").count()


def test_stored_model_scores_alike(spark):
    df = classified(spark)
    for kind in ("logistic", "gbt"):
        model = M.fit_classifier(df, ["a", "b"], "y", kind=kind)
        back = M.stored_model(M.store_model(model, spark, kind))
        assert M.score(back, df).orderBy("ts").select("y_prob").collect() == M.score(model, df).orderBy("ts").select("y_prob").collect()


def test_delta_scoring_equals_permuted_rows(spark):
    df, xs = classified(spark), ["a", "b", "k"]
    model = M.fit_classifier(df, xs, "y", reg_param=0.01)
    rows = series.add_row_index(df, "ts", idx="idx")
    rows = M.score(model, rows).withColumn("margin", F.log("y_prob") - F.log1p(-F.col("y_prob")))
    got = {(r.feature, r.rep): (r.tp, r.fp, r.fn, r.tn) for r in M.permuted_counts(rows, dict(zip(xs, M.linear_weights(model))), "y", 0.55, 2, 11).collect()}
    plain = rows.toPandas().set_index("idx").sort_index()
    for rep in range(2):
        order = [r.donor for r in M.donors(rows, 2, 11).filter(F.col("rep") == rep).orderBy("idx").collect()]
        assert sorted(order) == list(range(len(plain)))
        for c in xs:
            moved = plain[["ts", *xs, "y"]].copy()
            moved[c] = plain[c].to_numpy()[order]
            hit = M.score(model, spark.createDataFrame(moved)).orderBy("ts").toPandas().y_prob.to_numpy() >= 0.55
            y = plain.y.to_numpy() == 1
            assert got[c, rep] == ((hit & y).sum(), (hit & ~y).sum(), (~hit & y).sum(), (~hit & ~y).sum()), (c, rep)


# --- profiles of many columns --------------------------------------------------------------------

def measured(spark, n=1500):
    rng = np.random.default_rng(9)
    x = np.column_stack([rng.exponential(100, n), rng.integers(0, 4, n), np.full(n, 5.0), rng.normal(size=n)])
    x[rng.random(n) < 0.2, 3] = np.nan
    return table(spark, x, list("abcd")), x


@pytest.mark.parametrize("block_values", [100_000, 3])
def test_profile_equals_pandas_whatever_the_blocks(spark, block_values):
    df, x = measured(spark)
    got = {(r.period, r.column): r for r in D.period_profile(df, list("abcd"), "week", block_values=block_values).collect()}
    frame = df.toPandas().set_index("ts")
    for week, rows in frame.groupby(frame.index.to_period("W").start_time):
        for c in "abcd":
            r, v = got[week, c], rows[c].dropna()
            assert (r.median, r.mean, r.rows) == pytest.approx((v.median(), v.mean(), len(v)), abs=1e-6)


def test_merged_sketches_stay_within_their_rank_error(spark):
    df, x = measured(spark, 6000)
    sketches = D.column_sketches(df, list("abcd"), "day")
    got = {(r.period, r.column): r for r in D.merged_profile(sketches, df, list("abcd"), "month").collect()}
    frame = df.toPandas().set_index("ts")
    for month, rows in frame.groupby(frame.index.to_period("M").start_time):
        for c in "abcd":
            v, r = np.sort(rows[c].dropna().to_numpy()), got[month, c]
            low, high = np.searchsorted(v, r.median - 1e-6, "left") / len(v), np.searchsorted(v, r.median + 1e-6, "right") / len(v)
            assert low - D.KLL_RANK_ERROR <= 0.5 <= high + D.KLL_RANK_ERROR and r.mean == pytest.approx(v.mean(), abs=1e-6) and r.rows == len(v)


def test_value_blocks_are_cut_from_the_counted_rows(spark):
    df = spark.range(5000).select((F.col("id") * F.col("id")).cast("double").alias("v"))
    assert series.value_cuts(df, "v")[()] == []
    sizes = [r["count"] for r in series.with_value_blocks(df, "v", block_values=50).groupBy("_vblk").count().collect()]
    assert 90 <= len(sizes) <= 110 and max(sizes) <= 120
    many = [r["count"] for r in series.with_value_blocks(df, "v", block_values=2).groupBy("_vblk").count().collect()]
    assert len(many) > 2000 and max(many) <= 6
