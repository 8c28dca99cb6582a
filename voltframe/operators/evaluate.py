"""Forecast evaluation as aggregates (no predictions x thresholds cross join).

* Threshold sweep: every score is mapped once to the number of grid
  thresholds it reaches (``grid_bucket``); counts per (group, bucket) are a
  map-side-combined aggregate with at most ``n + 1`` buckets per group; a
  reverse running sum over those few rows gives TP/FP at every threshold.
* ROC-AUC / average precision / ROC points: one aggregate per distinct score,
  then two-level prefix sums (``series.prefix_sums``) -- never one global
  window over the raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import grid_bucket, grid_value, r6, ratio0
from ..session import join_small
from . import series

SCORE_BLOCKS = 4096


def _metrics(tp: Column, fp: Column, fn: Column, tn: Column) -> dict:
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    return {
        "f1": ratio0(2 * tp, 2 * tp + fp + fn),
        "f2": ratio0(5 * tp, 5 * tp + 4 * fn + fp),
        "precision": ratio0(tp, tp + fp),
        "recall": ratio0(tp, tp + fn),
        "accuracy": ratio0(tp + tn, tp + fp + fn + tn),
        "predicted_positive_rate": ratio0(tp + fp, tp + fp + fn + tn),
    }


def threshold_sweep(preds: DataFrame, groups: Sequence[str] = ("model",), grid=(0.05, 0.99, 95),
                    score: str = "y_prob", label: str = "y_true", round_threshold: int = 2) -> DataFrame:
    """Confusion counts and metrics at every grid threshold (pred = score >= t)."""
    groups = list(groups)
    start, stop, n = grid
    d = preds.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    counts = (d.groupBy(*groups, grid_bucket(score, start, stop, n).alias("bucket"))
                .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                     F.sum((1 - F.col(label)).cast("long")).alias("neg")))
    dense = (counts.select(*groups).distinct()
                   .select(*groups, F.explode(F.sequence(F.lit(0), F.lit(n))).alias("bucket"),
                           F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg")))
    cells = counts.unionByName(dense).groupBy(*groups, "bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    w_cum = Window.partitionBy(*groups).orderBy(F.col("bucket").desc()).rowsBetween(Window.unboundedPreceding, 0)
    w_all = Window.partitionBy(*groups)
    c = cells.select(*groups, "bucket",
                     F.sum("pos").over(w_cum).alias("tp"), F.sum("neg").over(w_cum).alias("fp"),
                     F.sum("pos").over(w_all).alias("_p"), F.sum("neg").over(w_all).alias("_n"))
    c = c.filter(F.col("bucket") >= 1).withColumn("threshold_index", F.col("bucket") - 1)
    c = c.withColumns({"fn": F.col("_p") - F.col("tp"), "tn": F.col("_n") - F.col("fp")})
    thr = grid_value("threshold_index", start, stop, n)
    if round_threshold is not None:
        thr = F.round(thr, round_threshold)
    out = c.withColumn("threshold", thr).withColumns(_metrics(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))
    return out.select(*groups, "threshold_index", "threshold", "tp", "fp", "fn", "tn",
                      "f1", "f2", "precision", "recall", "accuracy", "predicted_positive_rate")


def threshold_select(sweep: DataFrame, groups: Sequence[str] = ("model",), tie: str = "high") -> DataFrame:
    """Best threshold per group.

    ``tie='high'``: order by f1, f2, precision, threshold all descending.
    ``tie='low'``: first maximum of f1, i.e. the smallest threshold.
    """
    if tie == "high":
        order = [F.col("f1").desc(), F.col("f2").desc(), F.col("precision").desc(), F.col("threshold_index").desc()]
    else:
        order = [F.col("f1").desc(), F.col("threshold_index").asc()]
    w = Window.partitionBy(*groups).orderBy(*order)
    return sweep.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1).drop("_rk")


def confusion(preds: DataFrame, groups: Sequence[str], pred: Column | str, label: str = "y_true") -> DataFrame:
    """A23 at one threshold per row (``pred`` 0/1 column or expression)."""
    p = F.col(pred) if isinstance(pred, str) else pred
    y = F.col(label)
    counts = preds.groupBy(*groups).agg(
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"))
    return with_metrics(counts)


def with_metrics(counts: DataFrame) -> DataFrame:
    """Metrics of confusion counts."""
    return counts.withColumns(_metrics(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")))


def compared(scores: DataFrame, grid) -> DataFrame:
    """For each model of (model, split, y_true, y_prob) the threshold chosen on
    validation, and six metrics on validation and on test; NULL scores do not count."""
    bl = scores.filter(F.col("y_prob").isNotNull())
    val = bl.filter(F.col("split") == "validation")
    sel = threshold_select(threshold_sweep(val, ["model"], grid), ["model"]).select("model", F.col("threshold").alias("selected_threshold"))
    scored = join_small(bl.filter(F.col("split") != "train"), sel, "model").withColumn(
        "y_pred", (F.col("y_prob") >= F.col("selected_threshold")).cast("int"))
    m = confusion(scored, ["model", "split"], "y_pred")
    a = roc_auc_ap(scored, ["model", "split"]).select("model", "split", F.col("average_precision").alias("pr_auc"), "roc_auc")
    cols = ("f1", "f2", "precision", "recall", "pr_auc", "roc_auc")
    wide = m.join(a, ["model", "split"]).groupBy("model").pivot("split", ["validation", "test"]).agg(*[F.first(c).alias(c) for c in cols])
    return sel.join(wide, "model").select("model", "selected_threshold",
                                          *[r6(f"{s}_{c}").alias(f"{s}_{c}") for s in ("validation", "test") for c in cols])


def score_table(preds: DataFrame, groups: Sequence[str], score: str = "y_prob", label: str = "y_true") -> DataFrame:
    """Per distinct score: positives, negatives, and ascending inclusive running sums."""
    groups = list(groups)
    d = preds.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    by_score = d.groupBy(*groups, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    by_score = series.with_value_blocks(by_score, "score")     # ~equal distinct scores per block
    cum = series.prefix_sums(by_score, ["pos", "neg"], "score", groups, block=F.col("_vblk")).drop("_vblk")
    totals = by_score.groupBy(*groups).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return series.attach_totals(cum, totals, groups)


def roc_auc_ap(preds: DataFrame, groups: Sequence[str] = ("model",), score: str = "y_prob",
               label: str = "y_true") -> DataFrame:
    """ROC-AUC with ties (rank statistic) and average precision (step sum)."""
    t = score_table(preds, groups, score, label)
    neg_below = F.col("neg_cum") - F.col("neg")
    tp_ge = F.col("n_pos") - F.col("pos_cum") + F.col("pos")
    fp_ge = F.col("n_neg") - F.col("neg_cum") + F.col("neg")
    t = t.withColumns({
        "_auc": F.col("pos").cast("double") * (neg_below.cast("double") + 0.5 * F.col("neg").cast("double")),
        "_ap": F.col("pos").cast("double") * F.try_divide(tp_ge.cast("double"), (tp_ge + fp_ge).cast("double")),
    })
    agg = t.groupBy(*groups).agg(F.sum("_auc").alias("_auc"), F.sum("_ap").alias("_ap"),
                                 F.first("n_pos").alias("n_pos"), F.first("n_neg").alias("n_neg"))
    one_class = (F.col("n_pos") == 0) | (F.col("n_neg") == 0)
    return agg.select(*groups,
                      F.when(~one_class, F.col("_auc") / (F.col("n_pos") * F.col("n_neg")).cast("double")).alias("roc_auc"),
                      F.when(F.col("n_pos") > 0, F.col("_ap") / F.col("n_pos").cast("double")).alias("average_precision"),
                      F.col("n_pos").alias("positives"), F.col("n_neg").alias("negatives"))


def roc_curve(preds: DataFrame, groups: Sequence[str] = ("model",), score: str = "y_prob",
              label: str = "y_true", drop_intermediate: bool = True) -> DataFrame:
    """ROC points (predict positive at score >= threshold) plus the origin
    at threshold +inf.  With ``drop_intermediate`` a point is kept only where
    the cumulative FP or TP counts bend (non-zero second difference in score
    order), the first and last points always -- the usual ROC-curve default.
    Neighbouring points come from a halo window over the distinct scores."""
    groups = list(groups)
    t = score_table(preds, groups, score, label)
    tp_ge = F.col("n_pos") - F.col("pos_cum") + F.col("pos")
    fp_ge = F.col("n_neg") - F.col("neg_cum") + F.col("neg")
    pts = t.select(*groups, "score", tp_ge.alias("tps"), fp_ge.alias("fps"), "n_pos", "n_neg")
    if drop_intermediate:
        def build(w):
            return {"_fp_lo": F.lag("fps").over(w), "_fp_hi": F.lead("fps").over(w),
                    "_tp_lo": F.lag("tps").over(w), "_tp_hi": F.lead("tps").over(w)}

        pts = series.ordered(pts, build, order="score", keys=groups, reach=1,
                             index_block_width=1.0 / SCORE_BLOCKS)
        bend = ((F.col("_fp_hi") - 2 * F.col("fps") + F.col("_fp_lo")) != 0) | \
               ((F.col("_tp_hi") - 2 * F.col("tps") + F.col("_tp_lo")) != 0)
        pts = pts.filter(F.col("_fp_lo").isNull() | F.col("_fp_hi").isNull() | bend)
    out = pts.select(*groups, F.col("score").alias("threshold"),
                     F.try_divide(F.col("fps").cast("double"), F.col("n_neg").cast("double")).alias("fpr"),
                     F.try_divide(F.col("tps").cast("double"), F.col("n_pos").cast("double")).alias("tpr"))
    origin = t.select(*groups).distinct().select(*groups, F.lit(float("inf")).alias("threshold"),
                                                 F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return out.unionByName(origin)


def error_group(y_true="y_true", y_pred="y_pred") -> Column:
    """TP / FN / FP / TN label."""
    y, p = F.col(y_true), F.col(y_pred)
    return (F.when((y == 1) & (p == 1), F.lit("TP")).when((y == 1) & (p == 0), F.lit("FN"))
             .when((y == 0) & (p == 1), F.lit("FP")).otherwise(F.lit("TN")))


def error_analysis(df: DataFrame, measures: Sequence[str], groups: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Means of measures per error group, rounded."""
    return (df.withColumn("error_group", error_group())
              .groupBy(*groups, "error_group")
              .agg(F.count(F.lit(1)).alias("rows"),
                   *[F.round(F.avg(m), digits).alias(f"mean_{m}") for m in measures]))


def regression_metrics(df: DataFrame, actual: str, forecast: str, groups: Sequence[str] = (),
                       threshold: float = 200.0) -> DataFrame:
    """RMSE, MAE and spike metrics derived from a price forecast."""
    e = F.col(actual) - F.col(forecast)
    y = (F.col(actual) > threshold).cast("int")
    p = (F.col(forecast) > threshold).cast("int")
    d = df.filter(F.col(actual).isNotNull() & F.col(forecast).isNotNull())
    agg = d.groupBy(*groups).agg(
        F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.count(F.lit(1)).alias("rows"),
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"))
    m = _metrics(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return agg.select(*groups, "rows", "rmse", "mae", m["f1"].alias("spike_f1"),
                      m["precision"].alias("spike_precision"), m["recall"].alias("spike_recall"),
                      m["predicted_positive_rate"].alias("predicted_spike_rate"))


def class_report(df: DataFrame, groups: Sequence[str] = (), label: str = "y_true", pred: str = "y_pred") -> DataFrame:
    """Per-class precision/recall/F1/support plus macro and weighted means."""
    c = confusion(df, groups, pred, label)
    tp, fp, fn, tn = (F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn"))
    per1 = c.select(*groups, F.lit("1").alias("class"), ratio0(tp, tp + fp).alias("precision"),
                    ratio0(tp, tp + fn).alias("recall"), ratio0(2 * tp, 2 * tp + fp + fn).alias("f1"),
                    (tp + fn).alias("support"))
    per0 = c.select(*groups, F.lit("0").alias("class"), ratio0(tn, tn + fn).alias("precision"),
                    ratio0(tn, tn + fp).alias("recall"), ratio0(2 * tn, 2 * tn + fn + fp).alias("f1"),
                    (tn + fp).alias("support"))
    both = per0.unionByName(per1)
    avgs = both.groupBy(*groups).agg(
        F.avg("precision").alias("m_p"), F.avg("recall").alias("m_r"), F.avg("f1").alias("m_f"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("w_p"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("w_r"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("w_f"),
        F.sum("support").alias("n"))
    macro = avgs.select(*groups, F.lit("macro avg").alias("class"), F.col("m_p").alias("precision"),
                        F.col("m_r").alias("recall"), F.col("m_f").alias("f1"), F.col("n").alias("support"))
    weighted = avgs.select(*groups, F.lit("weighted avg").alias("class"), F.col("w_p").alias("precision"),
                           F.col("w_r").alias("recall"), F.col("w_f").alias("f1"), F.col("n").alias("support"))
    return both.unionByName(macro).unionByName(weighted)


def cv_summary(fold_scores: DataFrame, candidate: str = "candidate", score: str = "f1") -> DataFrame:
    """Mean and population std of fold scores per candidate."""
    return fold_scores.groupBy(candidate).agg(F.avg(score).alias(f"mean_{score}"),
                                              F.stddev_pop(score).alias(f"std_{score}"),
                                              F.count(F.lit(1)).alias("folds"))
