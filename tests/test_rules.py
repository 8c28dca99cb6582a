"""Tiny hand tables, one per semantic rule (FIXTURES.md part C)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltframe.functions import calendar as cal
from voltframe.functions.columns import clip_lower_dead_band, flag_above, grid_bucket, grid_value, normal_sf, safe_div
from voltframe.operators import align, describe, evaluate, prepare, system


def test_t5_null_and_nan_price_flags(spark):
    from voltframe.functions.columns import nan_to_null
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (250.0,)], "p double")
    out = df.select(flag_above(nan_to_null("p"), 200.0).alias("f")).collect()
    assert [r["f"] for r in out] == [0, None, None, 1]


def test_t7_all_null_group_sums_to_zero(spark):
    rows = [(dt.datetime(2024, 1, 1, 0, 5), "click", None, 1), (dt.datetime(2024, 1, 1, 0, 9), "view", 2.0, 2)]
    g = spark.createDataFrame(rows, "ts timestamp_ntz, fuel_type string, volume double, unit_id long")
    wide = system.pivot_fuels(system.hourly_by_type(g)).collect()[0]
    assert wide["gas_total"] == 0.0 and wide["wind_total"] == 2.0 and wide["solar_total"] == 0.0


def test_t8_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "x double, y double")
    assert [r[0] for r in df.select(safe_div("x", "y")).collect()] == [None, 0.5]


def test_t9_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    out = describe.correlation_long(df, ["a", "b"]).collect()
    assert out[0]["corr"] is None


def test_t10_one_row_train_std_is_one(spark):
    df = spark.createDataFrame([(3.0,)], "x double")
    s = prepare.scaler_fit(df, ["x"], ddof=1).collect()[0]
    assert s["mean"] == 3.0 and s["std"] == 1.0


def test_t12_weekday_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 7),)], "ts timestamp_ntz")
    assert [r[0] for r in df.select(cal.day_of_week("ts")).collect()] == [0, 6]


def test_t13_leap_adjusted_day_of_year(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 1),), (dt.datetime(2023, 3, 1),)], "ts timestamp_ntz")
    assert [r[0] for r in df.select(cal.adjusted_day_of_year("ts")).collect()] == [60, 60]


def test_t14_event_last_day_counts_only_midnight(spark):
    rows = [(dt.datetime(2024, 1, 8, 0),), (dt.datetime(2024, 1, 8, 1),), (dt.datetime(2024, 1, 5, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    out = cal.event_flag(df, [("2024-01-05", "2024-01-08")]).orderBy("ts").collect()
    assert [r["is_event"] for r in out] == [1, 1, 0]
    whole = cal.event_flag(df, [("2024-01-05", "2024-01-08")], end="whole_day").orderBy("ts").collect()
    assert [r["is_event"] for r in whole] == [1, 1, 1]


def test_event_flag_long_calendar_uses_range_join(spark):
    ranges = [(f"2024-01-{d:02d}", f"2024-01-{d:02d}") for d in range(1, 29)] * 3
    df = spark.createDataFrame([(dt.datetime(2024, 1, 3, 0),), (dt.datetime(2024, 1, 3, 5),)], "ts timestamp_ntz")
    out = cal.event_flag(df, ranges).orderBy("ts").collect()
    assert [r["is_event"] for r in out] == [1, 0]


def test_t15_dead_band(spark):
    df = spark.createDataFrame([(-1.0,), (0.49,), (0.5,)], "v double")
    assert [r[0] for r in df.select(clip_lower_dead_band("v", 0.5)).collect()] == [0.0, 0.0, 0.5]


def test_t17_split_edges(spark):
    rows = [(dt.datetime(2024, 1, 18, 23),), (dt.datetime(2024, 1, 19),), (dt.datetime(2024, 1, 25),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    out = prepare.assign_split(df, ("2024-01-19 00:00:00", "2024-01-25 00:00:00")).orderBy("ts").collect()
    assert [r["split"] for r in out] == ["train", "validation", "test"]


def test_t21_grid_bucket_exact_at_edges(spark):
    grid = (0.05, 0.99, 95)
    scores = [round(0.05 + i * 0.01, 2) for i in range(95)] + [0.0, 1.0, 0.049999, 0.5]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = df.select("s", grid_bucket("s", *grid).alias("b")).collect()
    import numpy as np
    ts = np.linspace(0.05, 0.99, 95)
    for r in got:
        assert r["b"] == int((ts <= r["s"]).sum()), r
    vals = spark.range(95).select(grid_value("id", *grid).alias("t")).collect()
    assert [v["t"] for v in vals] == list(ts)


def _preds(spark, rows):
    return spark.createDataFrame(rows, "model string, y_true int, y_prob double")


def test_t22_tied_thresholds(spark):
    p = _preds(spark, [("m", 1, 0.9), ("m", 0, 0.1), ("m", 1, 0.6), ("m", 0, 0.55)])
    sw = evaluate.threshold_sweep(p, ["model"], (0.5, 0.7, 3))
    hi = evaluate.threshold_select(sw, ["model"], "high").collect()[0]
    lo = evaluate.threshold_select(sw, ["model"], "low").collect()[0]
    # thresholds 0.5 and 0.6 give F1 0.8 and 1.0; 0.6 wins; ties break by the tie rule
    assert hi["threshold"] == 0.6 and lo["threshold"] == 0.6
    p2 = _preds(spark, [("m", 1, 0.9), ("m", 0, 0.1)])
    sw2 = evaluate.threshold_sweep(p2, ["model"], (0.5, 0.7, 3))
    assert evaluate.threshold_select(sw2, ["model"], "high").collect()[0]["threshold"] == 0.7
    assert evaluate.threshold_select(sw2, ["model"], "low").collect()[0]["threshold"] == 0.5


def test_t23_no_positive_predictions_give_zero(spark):
    p = _preds(spark, [("m", 1, 0.1), ("m", 0, 0.2)])
    c = evaluate.confusion(p, ["model"], (F.col("y_prob") >= 0.9).cast("int")).collect()[0]
    assert c["precision"] == 0.0 and c["recall"] == 0.0 and c["f1"] == 0.0


def test_t24_average_precision_and_auc(spark):
    p = _preds(spark, [("m", 0, 0.9), ("m", 1, 0.8), ("m", 0, 0.7), ("m", 1, 0.6)])
    r = evaluate.roc_auc_ap(p, ["model"]).collect()[0]
    assert r["average_precision"] == pytest.approx(0.5)
    assert r["roc_auc"] == pytest.approx(0.25)
    one = evaluate.roc_auc_ap(_preds(spark, [("m", 0, 0.3), ("m", 0, 0.4)]), ["model"]).collect()[0]
    assert one["roc_auc"] is None and one["average_precision"] is None


def test_sweep_equals_brute_force_cross_product(spark):
    import random
    rnd = random.Random(7)
    rows = [("a", rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(300)]
    p = _preds(spark, rows)
    grid = (0.05, 0.99, 95)
    sw = {r["threshold_index"]: (r["tp"], r["fp"]) for r in evaluate.threshold_sweep(p, ["model"], grid).collect()}
    import numpy as np
    ts = np.linspace(*grid)
    for i, t in enumerate(ts):
        tp = sum(1 for _, y, s in rows if y == 1 and s >= t)
        fp = sum(1 for _, y, s in rows if y == 0 and s >= t)
        assert sw[i] == (tp, fp)


def test_auc_equals_pairwise_definition(spark):
    import random
    rnd = random.Random(11)
    rows = [("a", rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(200)]
    r = evaluate.roc_auc_ap(_preds(spark, rows), ["model"]).collect()[0]
    pos = [s for _, y, s in rows if y == 1]
    neg = [s for _, y, s in rows if y == 0]
    pairs = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    assert r["roc_auc"] == pytest.approx(pairs / (len(pos) * len(neg)))


def test_t26_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "v double")
    h = {r["bin"]: r["count"] for r in describe.histogram(df, "v", 5).collect()}
    assert h == {1: 2, 2: 2, 3: 2, 4: 2, 5: 3}


def test_t27_empty_month_kept(spark):
    rows = [(dt.datetime(2024, 1, 5), 1.0), (dt.datetime(2024, 3, 5), 3.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
    out = describe.monthly_resample(df, "v", ["v"]).orderBy("month").collect()
    assert len(out) == 3 and out[1]["median_v"] is None and out[1]["rows"] == 0


def test_t28_linear_quantiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    q = describe.exact_quantiles(df, "v", [0.25, 0.5], names=["q25", "q50"]).collect()[0]
    assert q["q25"] == pytest.approx(1.75) and q["q50"] == pytest.approx(2.5)


def test_s10_inventory_offsets(spark):
    lines = spark.createDataFrame([("f", "1:0:d=20240101:A:0 m:"), ("f", "2:100:d=20240101:B:0 m:"),
                                   ("f", "3:250:d=20240101:A:1 m:")], "file string, value string")
    out = align.parse_inventory(lines, "file").orderBy("n").collect()
    assert [r["end"] for r in out] == [99, 249, None]
    assert [r["level"] for r in out] == ["0 m", "0 m", "1 m"]


def test_normal_tail_matches_reference_values(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (-1.96,), (3.0,)], "z double")
    got = [r[0] for r in df.select(normal_sf("z")).collect()]
    exp = [0.5, 0.15865525393, 0.97500210485, 0.00134989803]
    for g, e in zip(got, exp):
        assert g == pytest.approx(e, abs=2e-7)


def test_p23_required_columns(spark):
    from voltframe.sources.tables import require_columns
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="b"):
        require_columns(df, ["a", "b"])


def test_p24_model_feature_lists():
    cols = ["ts", "price", "spike", "spike_lag_1", "spike_lagging", "spike_lead_2", "price_lag_6h", "price_lags",
            "price_rolling_mean_6h", "is_event", "sin_day", "hour_of_day", "split", "y_true"]
    names = lambda m: [c for _, c, _ in prepare.model_features(cols, m)]
    assert names("mlp") == names("CNN") == ["price", "spike", "spike_lag_1", "spike_lagging", "price_lag_6h", "price_lags",
                                            "price_rolling_mean_6h", "is_event", "sin_day", "hour_of_day"]
    assert names("LSTM") == ["price", "spike", "spike_lagging", "price_lags", "is_event", "sin_day", "hour_of_day"]
    lists = prepare.model_features(cols, "lstm")
    assert [k for k, _, _ in lists] == list(range(7))
    assert [c for _, c, scaled in lists if not scaled] == ["spike", "is_event"]
    assert prepare.model_features([], "mlp") == []
    with pytest.raises(ValueError, match="unknown model"):
        prepare.model_features(cols, "tree")


def test_dedupe_first_keeps_earliest(spark):
    rows = [(1, "2024-01-02", 10, 1.0), (1, "2024-01-01", 11, 2.0), (1, "2024-01-01", 9, 3.0), (2, "2024-01-05", 1, 4.0)]
    df = spark.createDataFrame(rows, "k int, d string, o int, v double")
    out = {r["k"]: (r["d"], r["o"], r["v"]) for r in align.dedupe_first(df, ["k"], ["d", "o"], ["v"]).collect()}
    assert out == {1: ("2024-01-01", 9, 3.0), 2: ("2024-01-05", 1, 4.0)}


def _ref_roc(y, s):
    """Reference ROC points: distinct thresholds descending, collinear points dropped, origin at +inf."""
    import numpy as np
    order = np.argsort(-np.asarray(s), kind="mergesort")
    ys, ss = np.asarray(y)[order], np.asarray(s)[order]
    last = np.r_[np.where(np.diff(ss))[0], len(ss) - 1]
    tps = np.cumsum(ys)[last]
    fps = (1 + last) - tps
    thr = ss[last]
    if len(fps) > 2:
        keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
        fps, tps, thr = fps[keep], tps[keep], thr[keep]
    return sorted([(float("inf"), 0.0, 0.0)] + [(float(t), f / fps[-1], p / tps[-1]) for t, f, p in zip(thr, fps, tps)])


def test_roc_curve_drops_collinear_points(spark):
    import random
    rnd = random.Random(13)
    rows = [("m", rnd.randint(0, 1), round(rnd.random(), 1)) for _ in range(120)]
    got = evaluate.roc_curve(_preds(spark, rows), ["model"]).collect()
    got = sorted((r["threshold"], r["fpr"], r["tpr"]) for r in got)
    exp = _ref_roc([y for _, y, _ in rows], [s for _, _, s in rows])
    assert len(got) == len(exp)
    for g, e in zip(got, exp):
        assert g[0] == e[0] and g[1] == pytest.approx(e[1]) and g[2] == pytest.approx(e[2])
