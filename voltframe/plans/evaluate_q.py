"""Queries: forecast evaluation (A22-A27, A29, A34, M01, M03, M04, M08, M11,
O02-O04, P19, P21, P34-P36, S11, U01, W08, W13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions.columns import flag_above, r6
from ..operators import evaluate as E
from ..operators import prepare, series
from . import sql as S
from ..session import join_small, materialize
from .forecast_q import hourly_forecasts
from .inputs import hourly_system, predictions
from .linear_sql import HOURLY_WALK, upper_tail
from .registry import register

PRED = S.pred_ctes()
GRID = P.GRID_BASELINE
METRICS = ("f1", "f2", "precision", "recall", "accuracy", "predicted_positive_rate")


def _r6m(df, cols=METRICS):
    return df.withColumns({c: r6(c) for c in cols})


def _metric_sql(tp="tp", fp="fp", fn="fn", tn="tn") -> str:
    def r0(a, b):
        return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"
    exprs = {
        "f1": r0(f"2 * {tp}", f"2 * {tp} + {fp} + {fn}"),
        "f2": r0(f"5 * {tp}", f"5 * {tp} + 4 * {fn} + {fp}"),
        "precision": r0(tp, f"{tp} + {fp}"),
        "recall": r0(tp, f"{tp} + {fn}"),
        "accuracy": r0(f"{tp} + {tn}", f"{tp} + {fp} + {fn} + {tn}"),
        "predicted_positive_rate": r0(f"{tp} + {fp}", f"{tp} + {fp} + {fn} + {tn}"),
    }
    return ", ".join(f"{S.r6(e)} AS {k}" for k, e in exprs.items())


def _counts_sql(pred: str, label: str = "y_true") -> str:
    return (f"CAST(sum(CASE WHEN {label} = 1 AND {pred} THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
            f"CAST(sum(CASE WHEN {label} = 0 AND {pred} THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
            f"CAST(sum(CASE WHEN {label} = 1 AND NOT ({pred}) THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
            f"CAST(sum(CASE WHEN {label} = 0 AND NOT ({pred}) THEN 1 ELSE 0 END) AS BIGINT) AS tn")


def _sweep_ctes(src: str = "p", where: str = "split = 'validation'", group: str = "model") -> str:
    start, stop, n = GRID
    return f"""
grid AS (SELECT i, {S.grid_value('i', GRID)} AS t FROM range({n}) r(i)),
sw_c AS (SELECT {group}, i, {_counts_sql('y_prob >= t')}
         FROM (SELECT * FROM {src} WHERE {where} AND y_prob IS NOT NULL) v CROSS JOIN grid GROUP BY {group}, i),
sw AS (SELECT {group}, i AS threshold_index, round({S.grid_value('i', GRID)}, 2) AS threshold, tp, fp, fn, tn,
              {_metric_sql()} FROM sw_c)"""


def _sweep(spark, sf_dir):
    p = predictions(spark, sf_dir).filter(F.col("split") == "validation")
    return E.threshold_sweep(p, ["model"], GRID)


@register("threshold_sweep", S.with_h("SELECT * FROM sw", extra=PRED + "," + _sweep_ctes()), headline=True)
def threshold_sweep(spark, sf_dir):
    """95-point sweep on validation without a cross join."""
    return _r6m(_sweep(spark, sf_dir))


SELECT_SQL = """
sel AS (SELECT * FROM sw QUALIFY row_number() OVER (PARTITION BY model
        ORDER BY f1 DESC, f2 DESC, precision DESC, threshold_index DESC) = 1)"""


@register("threshold_select", S.with_h("SELECT * FROM sel", extra=PRED + "," + _sweep_ctes() + "," + SELECT_SQL))
def threshold_select(spark, sf_dir):
    """Best validation threshold per model (f1, f2, precision, threshold desc)."""
    return _r6m(E.threshold_select(_sweep(spark, sf_dir), ["model"], tie="high"))


@register("confusion", S.with_h(f"""
SELECT c.model, {_counts_sql('y_prob >= sel.threshold')}
FROM p c JOIN sel ON c.model = sel.model WHERE c.split = 'test' GROUP BY c.model""",
    extra=PRED + "," + _sweep_ctes() + "," + SELECT_SQL))
def confusion(spark, sf_dir):
    """A23 at the selected threshold on the test split (TP/FP/TN/FN)."""
    p = predictions(spark, sf_dir)
    sweep = E.threshold_sweep(p.filter(F.col("split") == "validation"), ["model"], GRID)
    sel = E.threshold_select(sweep, ["model"]).select("model", "threshold")
    test = join_small(p.filter(F.col("split") == "test"), sel, "model")
    c = E.confusion(test, ["model"], (F.col("y_prob") >= F.col("threshold")).cast("int"))
    return c.select("model", "tp", "fp", "fn", "tn")


@register("roc_auc_ap", S.with_h("""
SELECT model, split, roc_auc, average_precision, positives, negatives FROM (
  SELECT model, split,
    CASE WHEN sum(y_true) > 0 AND sum(1 - y_true) > 0 THEN
      (sum(CASE WHEN y_true = 1 THEN rk END) - sum(y_true) * (sum(y_true) + 1) / 2.0)
      / (CAST(sum(y_true) AS DOUBLE) * sum(1 - y_true)) END AS roc_auc_raw,
    CAST(sum(y_true) AS BIGINT) AS positives, CAST(sum(1 - y_true) AS BIGINT) AS negatives
  FROM (SELECT *, rank() OVER (PARTITION BY model, split ORDER BY y_prob)
               + (count(*) OVER (PARTITION BY model, split, y_prob) - 1) / 2.0 AS rk FROM p) GROUP BY 1, 2) a
JOIN (
  SELECT model, split, sum(CASE WHEN y_true = 1 THEN CAST(tp_ge AS DOUBLE) / (tp_ge + fp_ge) END)
         / NULLIF(CAST(sum(y_true) AS DOUBLE), 0) AS ap_raw
  FROM (SELECT *, sum(y_true) OVER (PARTITION BY model, split ORDER BY y_prob DESC
                                    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp_ge,
                  sum(1 - y_true) OVER (PARTITION BY model, split ORDER BY y_prob DESC
                                        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp_ge FROM p)
  GROUP BY 1, 2) b USING (model, split)
CROSS JOIN LATERAL (SELECT (round(roc_auc_raw, 6) + 0.0) AS roc_auc, (round(ap_raw, 6) + 0.0) AS average_precision)
""", extra=PRED))
def roc_auc_ap(spark, sf_dir):
    """ROC-AUC with ties and average precision per model and split."""
    r = E.roc_auc_ap(predictions(spark, sf_dir), ["model", "split"])
    return r.withColumns({"roc_auc": r6("roc_auc"), "average_precision": r6("average_precision")})


@register("roc_curve", S.with_h(f"""
SELECT model, score AS threshold, {S.r6('CAST(fps AS DOUBLE) / NULLIF(nn, 0)')} AS fpr,
       {S.r6('CAST(tps AS DOUBLE) / NULLIF(np, 0)')} AS tpr
FROM d WHERE fp_hi IS NULL OR fp_lo IS NULL OR fp_hi - 2 * fps + fp_lo <> 0 OR tp_hi - 2 * tps + tp_lo <> 0
UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM p WHERE split = 'test'""", extra=PRED + """,
s0 AS (SELECT model, y_prob AS score, sum(y_true) AS pos, sum(1 - y_true) AS neg FROM p
       WHERE split = 'test' AND y_prob IS NOT NULL GROUP BY 1, 2),
c0 AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tps,
              sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fps,
              sum(pos) OVER (PARTITION BY model) AS np, sum(neg) OVER (PARTITION BY model) AS nn FROM s0),
d AS (SELECT *, LAG(fps) OVER w AS fp_hi, LEAD(fps) OVER w AS fp_lo, LAG(tps) OVER w AS tp_hi,
             LEAD(tps) OVER w AS tp_lo FROM c0 WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""))
def roc_curve(spark, sf_dir):
    """ROC points on test (collinear points dropped), plus the origin at +inf."""
    r = E.roc_curve(predictions(spark, sf_dir).filter(F.col("split") == "test"), ["model"])
    return r.withColumns({"fpr": r6("fpr"), "tpr": r6("tpr")})


def _baseline_frame(h):
    """Naive, seasonal naive (lag 22 of the current flag), train-mean scores."""
    h = h.select("ts", "price").withColumn("spike", flag_above("price", P.SPIKE_THRESHOLD))
    shift = P.SEASONAL_PERIOD - P.HORIZON
    h = series.ordered(h, series.combine(series.leads("price", [P.HORIZON], name="price_lead"),
                                         series.lags("spike", [shift], name="seasonal")), reach=shift)
    h = h.filter(F.col("price_lead").isNotNull()).withColumn("y_true", flag_above("price_lead", P.SPIKE_THRESHOLD))
    h = prepare.assign_split(h, P.HOURLY_SPLITS)
    rate = h.filter(F.col("split") == "train").agg(F.avg("y_true").alias("mean_prob"))
    h = series.attach_totals(h, rate, [])
    b = h.select("ts", "split", "price", "y_true", F.col("spike").cast("double").alias("naive_prob"),
                 F.col("seasonal").cast("double").alias("seasonal_naive_prob"), "mean_prob")
    return materialize(b, "baselines")


BASE_CTES = f"""
b0 AS (SELECT ts, price, CAST(price > {P.SPIKE_THRESHOLD} AS INTEGER) AS spike,
              LEAD(price, {P.HORIZON}) OVER (ORDER BY ts) AS price_lead,
              LAG(CAST(price > {P.SPIKE_THRESHOLD} AS INTEGER), {P.SEASONAL_PERIOD - P.HORIZON}) OVER (ORDER BY ts) AS seasonal
       FROM h),
b1 AS (SELECT *, CAST(price_lead > {P.SPIKE_THRESHOLD} AS INTEGER) AS y_true, {S.split_case()} AS split
       FROM b0 WHERE price_lead IS NOT NULL),
bs AS (SELECT ts, split, price, y_true, CAST(spike AS DOUBLE) AS naive_prob, CAST(seasonal AS DOUBLE) AS seasonal_naive_prob,
              (SELECT avg(y_true) FROM b1 WHERE split = 'train') AS mean_prob FROM b1),
bl AS (SELECT 'naive' AS model, ts, split, y_true, naive_prob AS y_prob FROM bs
       UNION ALL SELECT 'seasonal_naive', ts, split, y_true, seasonal_naive_prob FROM bs
       UNION ALL SELECT 'mean', ts, split, y_true, mean_prob FROM bs{{walk}})"""
#: the same with the walk-forward forecasts as fourth baseline
WALK_CTES = HOURLY_WALK + BASE_CTES.replace("{walk}", f"""
       UNION ALL SELECT 'walk_forward', ts, split, y_true, {upper_tail('forecast', 'forecast_se', P.SPIKE_THRESHOLD)} FROM bs LEFT JOIN wf USING (ts)""").replace("\nb0", ",\nb0", 1)
BASE_CTES = BASE_CTES.replace("{walk}", "")


@register("baseline_scores", S.with_h(
    "SELECT ts, split, y_true, naive_prob, seasonal_naive_prob, " + S.r6("mean_prob") + " AS mean_prob FROM bs "
    "WHERE split <> 'train'", extra=BASE_CTES))
def baseline_scores(spark, sf_dir):
    """Baseline probabilities on validation and test."""
    b = _baseline_frame(hourly_system(spark, sf_dir)).filter(F.col("split") != "train")
    return b.select("ts", "split", "y_true", "naive_prob", "seasonal_naive_prob", r6("mean_prob").alias("mean_prob"))


def baselines_long(spark, sf_dir):
    """The four baselines, one row for each hour and baseline; hours without a
    walk-forward forecast (J04) have a NULL score of it."""
    h = hourly_system(spark, sf_dir)
    b = _baseline_frame(h).join(hourly_forecasts(h).select("ts", "ar_prob"), "ts", "left")
    m = F.explode(F.array(
        F.struct(F.lit("walk_forward").alias("model"), F.col("ar_prob").alias("y_prob")),
        F.struct(F.lit("naive").alias("model"), F.col("naive_prob").alias("y_prob")),
        F.struct(F.lit("seasonal_naive").alias("model"), F.col("seasonal_naive_prob").alias("y_prob")),
        F.struct(F.lit("mean").alias("model"), F.col("mean_prob").alias("y_prob"))))
    return b.select("ts", "split", "y_true", m.alias("_m")).select("_m.model", "ts", "split", "y_true", "_m.y_prob")


def _cmp_sql():
    sweep = _sweep_ctes("bl", "split = 'validation'")
    auc = lambda s: f"""
  SELECT model, '{s}' AS split,
    CASE WHEN sum(y_true) > 0 AND sum(1 - y_true) > 0 THEN
      (sum(CASE WHEN y_true = 1 THEN rk END) - sum(y_true) * (sum(y_true) + 1) / 2.0)
      / (CAST(sum(y_true) AS DOUBLE) * sum(1 - y_true)) END AS roc_auc
  FROM (SELECT *, rank() OVER (PARTITION BY model ORDER BY y_prob)
               + (count(*) OVER (PARTITION BY model, y_prob) - 1) / 2.0 AS rk
        FROM bl WHERE split = '{s}' AND y_prob IS NOT NULL) GROUP BY 1"""
    ap = lambda s: f"""
  SELECT model, '{s}' AS split, sum(CASE WHEN y_true = 1 THEN CAST(tp_ge AS DOUBLE) / (tp_ge + fp_ge) END)
         / NULLIF(CAST(sum(y_true) AS DOUBLE), 0) AS pr_auc
  FROM (SELECT *, sum(y_true) OVER w AS tp_ge, sum(1 - y_true) OVER w AS fp_ge
        FROM bl WHERE split = '{s}' AND y_prob IS NOT NULL
        WINDOW w AS (PARTITION BY model ORDER BY y_prob DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  GROUP BY 1"""
    return S.with_h(f"""
SELECT sel.model, sel.threshold AS selected_threshold,
  {", ".join(f"{S.r6(f'v.{m}')} AS validation_{m}" for m in ("f1", "f2", "precision", "recall"))},
  {S.r6('va.pr_auc')} AS validation_pr_auc, {S.r6('vr.roc_auc')} AS validation_roc_auc,
  {", ".join(f"{S.r6(f't.{m}')} AS test_{m}" for m in ("f1", "f2", "precision", "recall"))},
  {S.r6('ta.pr_auc')} AS test_pr_auc, {S.r6('tr.roc_auc')} AS test_roc_auc
FROM sel
JOIN mv v ON v.model = sel.model JOIN mt t ON t.model = sel.model
JOIN ({ap('validation')}) va ON va.model = sel.model JOIN ({auc('validation')}) vr ON vr.model = sel.model
JOIN ({ap('test')}) ta ON ta.model = sel.model JOIN ({auc('test')}) tr ON tr.model = sel.model""",
        extra=WALK_CTES + "," + sweep + "," + SELECT_SQL + f""",
mv AS (SELECT model, {_metric_sql()} FROM (SELECT bl.model, {_counts_sql('y_prob >= sel.threshold')}
       FROM bl JOIN sel USING (model) WHERE split = 'validation' AND y_prob IS NOT NULL GROUP BY 1)),
mt AS (SELECT model, {_metric_sql()} FROM (SELECT bl.model, {_counts_sql('y_prob >= sel.threshold')}
       FROM bl JOIN sel USING (model) WHERE split = 'test' AND y_prob IS NOT NULL GROUP BY 1))""").replace("WITH", "WITH RECURSIVE", 1)


@register("baseline_comparison", _cmp_sql(), headline=True)
def baseline_comparison(spark, sf_dir):
    """Per baseline (naive, seasonal naive, mean, walk-forward forecast), threshold tuned on validation, 12 metrics on both splits."""
    return E.compared(baselines_long(spark, sf_dir), GRID)


@register("error_groups", S.with_h("""
SELECT ts, y_true, CAST(y_prob >= 0.5 AS INTEGER) AS y_pred,
       CASE WHEN y_true = 1 AND y_prob >= 0.5 THEN 'TP' WHEN y_true = 1 THEN 'FN'
            WHEN y_prob >= 0.5 THEN 'FP' ELSE 'TN' END AS error_group
FROM p WHERE model = 'load_ratio' AND split = 'test'""", extra=PRED))
def error_groups(spark, sf_dir):
    """TP/FN/FP/TN label of each test prediction at threshold 0.5."""
    p = predictions(spark, sf_dir).filter((F.col("model") == "load_ratio") & (F.col("split") == "test"))
    p = p.withColumn("y_pred", (F.col("y_prob") >= 0.5).cast("int"))
    return p.select("ts", "y_true", "y_pred", E.error_group().alias("error_group"))


@register("error_analysis", S.with_h("""
SELECT error_group, count(*) AS rows, round(avg(price), 3) + 0.0 AS mean_price, round(avg(y_prob), 3) + 0.0 AS mean_y_prob
FROM (SELECT *, CASE WHEN y_true = 1 AND y_prob >= 0.5 THEN 'TP' WHEN y_true = 1 THEN 'FN'
                     WHEN y_prob >= 0.5 THEN 'FP' ELSE 'TN' END AS error_group
      FROM p WHERE split = 'test') GROUP BY 1""", extra=PRED))
def error_analysis(spark, sf_dir):
    """Means by error group (rounded 3) over both models' test rows."""
    p = predictions(spark, sf_dir).filter(F.col("split") == "test")
    p = p.withColumn("y_pred", (F.col("y_prob") >= 0.5).cast("int"))
    out = E.error_analysis(p, ["price", "y_prob"])
    return out.withColumns({c: F.col(c) + F.lit(0.0) for c in ("mean_price", "mean_y_prob")})


def _class_report_sql():
    def r0(a, b):
        return f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"
    per = f"""
pc AS (
  SELECT model, '1' AS class, {r0('tp', 'tp + fp')} AS precision, {r0('tp', 'tp + fn')} AS recall,
         {r0('2 * tp', '2 * tp + fp + fn')} AS f1, CAST(tp + fn AS DOUBLE) AS support FROM c
  UNION ALL
  SELECT model, '0', {r0('tn', 'tn + fn')}, {r0('tn', 'tn + fp')}, {r0('2 * tn', '2 * tn + fn + fp')},
         CAST(tn + fp AS DOUBLE) FROM c)"""
    r = S.r6
    return S.with_h(f"""
SELECT model, class, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1, {r('support')} AS support FROM pc
UNION ALL SELECT model, 'macro avg', {r('avg(precision)')}, {r('avg(recall)')}, {r('avg(f1)')}, {r('sum(support)')}
FROM pc GROUP BY model
UNION ALL SELECT model, 'weighted avg', {r('sum(precision * support) / sum(support)')},
  {r('sum(recall * support) / sum(support)')}, {r('sum(f1 * support) / sum(support)')}, {r('sum(support)')}
FROM pc GROUP BY model""", extra=PRED + f""",
c AS (SELECT model, {_counts_sql('y_prob >= 0.5')} FROM p WHERE split = 'test' GROUP BY 1),""" + per)


@register("class_report", _class_report_sql())
def class_report(spark, sf_dir):
    """Per-class precision/recall/F1/support plus macro/weighted averages."""
    p = predictions(spark, sf_dir).filter(F.col("split") == "test")
    p = p.withColumn("y_pred", (F.col("y_prob") >= 0.5).cast("int"))
    r = E.class_report(p, ["model"])
    return r.withColumns({c: r6(c) for c in ("precision", "recall", "f1", "support")})


def _regression_sql():
    def r0(a, b):
        return S.r6(f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)")
    t = P.SPIKE_THRESHOLD
    return S.with_h(f"""
SELECT split, rows, rmse, mae, {r0('2 * tp', '2 * tp + fp + fn')} AS spike_f1, {r0('tp', 'tp + fp')} AS spike_precision,
       {r0('tp', 'tp + fn')} AS spike_recall, {r0('tp + fp', 'tp + fp + fn + tn')} AS predicted_spike_rate
FROM (
  SELECT split, count(*) AS rows, {S.r6('sqrt(avg((a - f) * (a - f)))')} AS rmse, {S.r6('avg(abs(a - f))')} AS mae,
         {_counts_sql(f'f > {t}', f'CAST(a > {t} AS INTEGER)')}
  FROM (SELECT {S.split_case()} AS split, a, f FROM (
          SELECT ts, LEAD(price, {P.HORIZON}) OVER (ORDER BY ts) AS a, price AS f FROM h) WHERE a IS NOT NULL)
  GROUP BY split)""")


@register("regression_metrics", _regression_sql())
def regression_metrics(spark, sf_dir):
    """Persistence price forecast (price at t for t+2): RMSE, MAE, spike metrics per split."""
    h = hourly_system(spark, sf_dir).select("ts", "price")
    h = series.ordered(h, series.leads("price", [P.HORIZON], name="actual"), reach=P.HORIZON)
    h = prepare.assign_split(h.filter(F.col("actual").isNotNull()), P.HOURLY_SPLITS)
    r = E.regression_metrics(h, "actual", "price", ["split"], P.SPIKE_THRESHOLD)
    return r.withColumns({c: r6(c) for c in ("rmse", "mae", "spike_f1", "spike_precision", "spike_recall",
                                             "predicted_spike_rate")})


# --- parameter variants of the modelled code copies --------------------------------------------

def _first_max_sql():
    grid = P.GRID_PIPELINE
    start, stop, n = grid
    return S.with_h(f"""
SELECT model, threshold_index, threshold, {S.r6('f1')} AS f1 FROM (
  SELECT model, i AS threshold_index, round({S.grid_value('i', grid)}, 2) AS threshold,
         COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1
  FROM (SELECT model, i, {_counts_sql('y_prob >= t')}
        FROM (SELECT * FROM p WHERE split = 'validation') v
        CROSS JOIN (SELECT i, {S.grid_value('i', grid)} AS t FROM range({n}) r(i)) g GROUP BY model, i))
QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, threshold_index ASC) = 1""", extra=PRED)


@register("threshold_select_first_max", _first_max_sql())
def threshold_select_first_max(spark, sf_dir):
    """T21/T22 variant: 81-point grid 0.10..0.90, first maximum of F1 (smallest threshold)."""
    p = predictions(spark, sf_dir).filter(F.col("split") == "validation")
    sw = E.threshold_sweep(p, ["model"], P.GRID_PIPELINE)
    best = E.threshold_select(sw, ["model"], tie="low")
    return best.select("model", "threshold_index", "threshold", r6("f1").alias("f1"))
