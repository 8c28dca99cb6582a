"""Queries: modelling preparation and scoring helpers (P19, P24, P32-P36, U01,
A21, A22, A29, W09, W13, S09, S11, O03, O04, M11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions.columns import normal_sf, r6, sigmoid
from ..operators import describe as D
from ..operators import evaluate as E
from ..operators import prepare, series
from ..session import scratch_path
from . import sql as S
from .inputs import hourly_system, predictions, wide_features
from .registry import register

WIDE = S.wide_ctes()
PRED = S.pred_ctes()


@register("split_assign", S.with_h(f"SELECT ts, {S.split_case()} AS split FROM h"))
def split_assign(spark, sf_dir):
    """Time-bound split label."""
    return prepare.assign_split(hourly_system(spark, sf_dir, materialized=False).select("ts"), P.HOURLY_SPLITS)


@register("union_splits", S.with_h(f"""
SELECT ts, split FROM (SELECT ts, {S.split_case()} AS split FROM h) WHERE split = 'train'
UNION ALL
SELECT ts, split FROM (SELECT ts, {S.split_case()} AS split FROM h) WHERE split = 'validation'"""))
def union_splits(spark, sf_dir):
    """Concatenation of same-schema frames (train + validation)."""
    s = prepare.assign_split(hourly_system(spark, sf_dir).select("ts"), P.HOURLY_SPLITS)
    return s.filter(F.col("split") == "train").unionByName(s.filter(F.col("split") == "validation"))


SCALED = ("price", "load", "net_load", "reserve_margin", "wind_total", "gas_total")


def _scaler_sql():
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {S.r6(f'avg({c})')} AS mean, "
        f"{S.r6(f'COALESCE(NULLIF(stddev_samp({c}), 0), 1.0)')} AS std FROM wt WHERE ts < TIMESTAMP '{P.HOURLY_SPLITS[0]}'"
        for c in SCALED)
    return S.with_h(parts, extra=WIDE)


def _fit(spark, sf_dir):
    w = prepare.assign_split(wide_features(spark, sf_dir), P.HOURLY_SPLITS)
    return w, prepare.scaler_fit(w.filter(F.col("split") == "train"), SCALED, ddof=1)


@register("scaler_stats", _scaler_sql())
def scaler_stats(spark, sf_dir):
    """A21 + S09: fit on train rows (ddof 1, zero std -> 1), persisted as Parquet and read back."""
    _, stats = _fit(spark, sf_dir)
    import uuid
    path = scratch_path(spark, f"scaler_stats_{uuid.uuid4().hex[:10]}")
    stats.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    return back.select("column", r6("mean").alias("mean"), r6("std").alias("std"))


def _standardize_sql():
    b1 = P.HOURLY_SPLITS[0]
    stats = ", ".join(f"avg({c}) FILTER (WHERE ts < TIMESTAMP '{b1}') AS m_{c}, "
                      f"COALESCE(NULLIF(stddev_samp({c}) FILTER (WHERE ts < TIMESTAMP '{b1}'), 0), 1.0) AS s_{c}"
                      for c in SCALED)
    cols = ", ".join(f"{S.r6(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in SCALED)
    return S.with_h(f"SELECT ts, {S.split_case()} AS split, {cols} FROM wt, st WHERE ts >= TIMESTAMP '{b1}'",
                    extra=WIDE + f",\nst AS (SELECT {stats} FROM wt)")


@register("standardize", _standardize_sql())
def standardize(spark, sf_dir):
    """Scale validation/test rows with the train-fitted stats."""
    w, stats = _fit(spark, sf_dir)
    out = prepare.scaler_apply(w.filter(F.col("split") != "train"), stats, SCALED)
    return out.select("ts", "split", *[r6(c).alias(c) for c in SCALED])


@register("class_weight", S.with_h(f"""
SELECT count(spike_lead_2) AS rows, CAST(sum(spike_lead_2) AS BIGINT) AS positives,
       CAST(count(spike_lead_2) - sum(spike_lead_2) AS BIGINT) AS negatives,
       {S.r6('CAST(count(spike_lead_2) - sum(spike_lead_2) AS DOUBLE) / GREATEST(CAST(sum(spike_lead_2) AS DOUBLE), 1.0)')} AS pos_weight
FROM wt WHERE ts < TIMESTAMP '{P.HOURLY_SPLITS[0]}'""", extra=WIDE))
def class_weight(spark, sf_dir):
    """Neg / max(pos, 1) on the train rows."""
    w = prepare.assign_split(wide_features(spark, sf_dir), P.HOURLY_SPLITS).filter(F.col("split") == "train")
    out = prepare.class_weight(w, "spike_lead_2", guard_pos=True)
    return out.withColumn("pos_weight", r6("pos_weight"))


def _folds_sql():
    n = P.CV_SPLITS
    return S.with_h(f"""
SELECT fold, role, count(*) AS rows, min(idx) AS first_idx, max(idx) AS last_idx FROM (
  SELECT x.idx, CAST(r.fold AS INTEGER) AS fold,
         CASE WHEN idx < n - ({n} - r.fold) * (n // {n + 1}) THEN 'train'
              WHEN idx < n - ({n} - r.fold) * (n // {n + 1}) + n // {n + 1} THEN 'test' END AS role
  FROM (SELECT row_number() OVER (ORDER BY ts) - 1 AS idx, count(*) OVER () AS n FROM h) x, range({n}) r(fold))
WHERE role IS NOT NULL GROUP BY 1, 2""")


def _indexed_with_n(df, order="ts"):
    d = series.add_row_index(df, order, idx="idx")
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return series.attach_totals(d, n, [])


@register("cv_folds", _folds_sql())
def cv_folds(spark, sf_dir):
    """Expanding-window folds (TimeSeriesSplit) from the row index."""
    d = _indexed_with_n(hourly_system(spark, sf_dir).select("ts"))
    f = series.expanding_folds(d, F.col("n_rows"), P.CV_SPLITS)
    return f.groupBy("fold", "role").agg(F.count(F.lit(1)).alias("rows"), F.min("idx").alias("first_idx"),
                                         F.max("idx").alias("last_idx"))


CANDIDATES = (0.3, 0.4, 0.5, 0.6)


def _cv_summary_sql():
    n = P.CV_SPLITS
    cands = ", ".join(f"(CAST({c} AS DOUBLE))" for c in CANDIDATES)
    return S.with_h(f"""
SELECT candidate, {S.r6('avg(f1)')} AS mean_f1, {S.r6('stddev_pop(f1)')} AS std_f1, count(*) AS folds FROM (
  SELECT candidate, fold, COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0.0) AS f1 FROM (
    SELECT candidate, fold,
      sum(CASE WHEN y_true = 1 AND y_prob >= candidate THEN 1 ELSE 0 END) AS tp,
      sum(CASE WHEN y_true = 0 AND y_prob >= candidate THEN 1 ELSE 0 END) AS fp,
      sum(CASE WHEN y_true = 1 AND y_prob < candidate THEN 1 ELSE 0 END) AS fn
    FROM (SELECT x.*, CAST(r.fold AS INTEGER) AS fold FROM
            (SELECT *, row_number() OVER (ORDER BY ts) - 1 AS idx, count(*) OVER () AS n FROM p
             WHERE model = 'load_ratio') x, range({n}) r(fold)
          WHERE idx >= n - ({n} - r.fold) * (n // {n + 1}) AND idx < n - ({n} - r.fold) * (n // {n + 1}) + n // {n + 1}) t,
         (VALUES {cands}) v(candidate)
    GROUP BY 1, 2)) GROUP BY 1""", extra=PRED)


@register("cv_summary", _cv_summary_sql())
def cv_summary(spark, sf_dir):
    """A29 (+W13): F1 of each candidate threshold on every expanding fold's test
    block; mean and population std across folds."""
    p = predictions(spark, sf_dir).filter(F.col("model") == "load_ratio")
    d = _indexed_with_n(p)
    t = series.expanding_folds(d, F.col("n_rows"), P.CV_SPLITS).filter(F.col("role") == "test")
    t = t.withColumn("candidate", F.explode(F.array(*[F.lit(float(c)) for c in CANDIDATES])))
    c = E.confusion(t, ["candidate", "fold"], (F.col("y_prob") >= F.col("candidate")).cast("int"))
    s = E.cv_summary(c, "candidate", "f1")
    return s.withColumns({"mean_f1": r6("mean_f1"), "std_f1": r6("std_f1")})


SEQ_FEATURES = ("price", "load")
SEQ_LEN = 24


@register("sequence_windows", S.with_h(f"""
SELECT end_ts, "window", label FROM (
  SELECT ts AS end_ts, list([CAST(price AS DOUBLE), CAST(load AS DOUBLE)]) OVER w AS "window",
         count(*) OVER w AS n, y_true AS label
  FROM hl WINDOW w AS (ORDER BY ts ROWS BETWEEN {SEQ_LEN - 1} PRECEDING AND CURRENT ROW))
WHERE n = {SEQ_LEN} AND label IS NOT NULL""", extra=PRED))
def sequence_windows(spark, sf_dir):
    """24-row windows of (price, load) ending at each row, label of the last
    row (global scope: windows may reach back across split bounds)."""
    h = hourly_system(spark, sf_dir).select("ts", "price", "load")
    h = h.withColumn("spike", (F.col("price") > P.SPIKE_THRESHOLD).cast("int"))
    h = series.ordered(h, series.leads("spike", [P.HORIZON], name="y_true"), reach=P.HORIZON)
    w = prepare.sequence_windows(h, SEQ_FEATURES, SEQ_LEN, label="y_true")
    return w.filter(F.col("label").isNotNull())


def _role_sql():
    return """CASE
  WHEN column_name IN ('ts', 'split', 'y_true') OR column_name LIKE 'spike\\_lead\\_%' ESCAPE '\\' THEN 'excluded'
  WHEN column_name IN ('spike', 'is_weekend', 'is_event') THEN 'flag'
  WHEN regexp_matches(column_name, '^(hour|dow|month)_[0-9]+$') OR column_name LIKE 'sin\\_%' ESCAPE '\\'
       OR column_name LIKE 'cos\\_%' ESCAPE '\\' OR column_name LIKE 'spike\\_lag\\_%' ESCAPE '\\' THEN 'unscaled'
  ELSE 'continuous' END"""


def _nulls_sql():
    from .features import _wide_columns
    ints, doubles = _wide_columns()
    return " UNION ALL ".join(f"SELECT '{c}' AS c, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM wt" for c in ["ts", *ints, *doubles])


@register("feature_catalog", S.with_h(f"""
SELECT position, column_name AS "column", {_role_sql()} AS role, nulls
FROM (SELECT CAST(row_number() OVER () - 1 AS BIGINT) AS position, column_name FROM (DESCRIBE SELECT * FROM wt)) JOIN ({_nulls_sql()}) n ON n.c = column_name""", extra=WIDE))
def feature_catalog(spark, sf_dir):
    """Column roles by explicit rules, with the NULLs of each column of the engineered table."""
    w = wide_features(spark, sf_dir)
    roles = spark.createDataFrame(prepare.feature_catalog(w.columns), "position bigint, column string, role string")
    return roles.join(D.null_profile(w), "column").select("position", "column", "role", "nulls")


@register("model_feature_lists", S.with_h(f"""
SELECT model, CAST(row_number() OVER (PARTITION BY model ORDER BY place) - 1 AS BIGINT) AS position, column_name AS "column",
  NOT regexp_full_match(column_name, 'spike|is_weekend|is_event|spike_lag_[0-9]+') AS scaled, nulls
FROM (SELECT row_number() OVER () AS place, column_name FROM (DESCRIBE SELECT * FROM wt))
  JOIN ({_nulls_sql()}) n ON n.c = column_name, (VALUES ('mlp'), ('cnn'), ('lstm')) m(model)
WHERE column_name <> 'ts' AND NOT regexp_full_match(column_name, 'spike_lead_[0-9]+')
  AND NOT (model = 'lstm' AND regexp_full_match(column_name, '(spike_lag_[0-9]+)|(price_lag_[0-9]+h)|(price_rolling_mean_[0-9]+h)'))""", extra=WIDE))
def model_feature_lists(spark, sf_dir):
    """The inputs of each kind of model, which of them are scaled, and the
    NULLs to be filled in each."""
    w = wide_features(spark, sf_dir)
    lists = [(m, *f) for m in prepare.MODEL_DROPS for f in prepare.model_features(w.columns, m)]
    inputs = spark.createDataFrame(lists, "model string, position bigint, column string, scaled boolean")
    return inputs.join(D.null_profile(w), "column").select("model", "position", "column", "scaled", "nulls")


DICT_RULES = (  # (predicate kind, pattern, units, definition, transformation)
    ("eq", "ts", "hour", "operating hour (market time)", "floor to hour"),
    ("eq", "price", "currency/MWh", "hourly pool price", "max of readings"),
    ("eq", "load", "MW", "internal load", "sum of readings"),
    ("suffix", "_total", "MW", "generation by fuel type", "sum by hour and type"),
    ("suffix", "_cap", "MW", "system capability by fuel type", "distinct units x 100"),
    ("suffix", "_mix", "share", "share of total generation", "ratio"),
    ("prefix", "spike_lead_", "flag", "spike k hours ahead", "lead"),
    ("prefix", "spike_lag_", "flag", "spike k hours ago", "lag"),
    ("prefix", "price_lag_", "currency/MWh", "lagged price", "lag"),
    ("prefix", "sin_", "unitless", "Fourier term", "sine of phase"),
    ("prefix", "cos_", "unitless", "Fourier term", "cosine of phase"),
    ("prefix", "is_", "flag", "indicator", "calendar rule"),
)


def _dict_case(field: int) -> str:
    parts = []
    for kind, pat, *vals in DICT_RULES:
        cond = {"eq": f"column_name = '{pat}'", "suffix": f"suffix(column_name, '{pat}')",
                "prefix": f"starts_with(column_name, '{pat}')"}[kind]
        parts.append(f"WHEN {cond} THEN '{vals[field]}'")
    return "CASE " + " ".join(parts) + " ELSE '" + ("derived", "derived feature", "formula")[field] + "' END"


@register("data_dictionary", S.with_h(f"""
SELECT column_name AS "column",
  CASE WHEN column_type = 'DOUBLE' THEN 'float' WHEN column_type IN ('INTEGER', 'BIGINT') THEN 'int'
       WHEN column_type LIKE 'TIMESTAMP%' THEN 'timestamp' ELSE 'string' END AS dtype,
  {_dict_case(0)} AS units, {_dict_case(1)} AS definition, {_dict_case(2)} AS transformation,
  'events' AS source, nulls
FROM (DESCRIBE SELECT * FROM wt) JOIN ({_nulls_sql()}) n ON n.c = column_name""", extra=WIDE))
def data_dictionary(spark, sf_dir):
    """One row per column with dtype/units/definition/transformation by ordered rules."""
    w = wide_features(spark, sf_dir)
    meta = spark.createDataFrame(w.dtypes, "column string, spark_type string")
    dtype = (F.when(F.col("spark_type") == "double", "float")
              .when(F.col("spark_type").isin("int", "bigint"), "int")
              .when(F.col("spark_type").startswith("timestamp"), "timestamp").otherwise("string"))
    c = F.col("column")
    out = {}
    for field, name in enumerate(("units", "definition", "transformation")):
        e = None
        for kind, pat, *vals in DICT_RULES:
            cond = {"eq": c == pat, "suffix": c.endswith(pat), "prefix": c.startswith(pat)}[kind]
            e = F.when(cond, vals[field]) if e is None else e.when(cond, vals[field])
        out[name] = e.otherwise(("derived", "derived feature", "formula")[field])
    return meta.join(D.null_profile(w), "column").select("column", dtype.alias("dtype"), *[v.alias(k) for k, v in out.items()],
                                                         F.lit("events").alias("source"), "nulls")


#: features of the report
TOP_FEATURES = 20


def _candidates(columns):
    """Every continuous or flag column may be a feature of the report."""
    return [c for _, c, role in prepare.feature_catalog(columns) if role in ("continuous", "flag")]


def _top_sql():
    from .features import _wide_columns
    ints, doubles = _wide_columns()
    feats = _candidates(["ts", *ints, *doubles])
    parts = []
    for a in feats:
        ma = f"CASE WHEN {a} IS NOT NULL AND spike_lead_2 IS NOT NULL THEN CAST({a} AS DOUBLE) END"
        mb = f"CASE WHEN {a} IS NOT NULL AND spike_lead_2 IS NOT NULL THEN CAST(spike_lead_2 AS DOUBLE) END"
        parts.append(f"SELECT '{a}' AS feature, {S.r6(f'covar_pop({ma}, {mb}) / NULLIF(stddev_pop({ma}) * stddev_pop({mb}), 0)')} AS corr FROM wt")
    return S.with_h(f"SELECT feature, corr, abs(corr) AS score FROM ({' UNION ALL '.join(parts)}) "
                    f"ORDER BY score DESC NULLS LAST, feature LIMIT {TOP_FEATURES}", extra=WIDE)


@register("top_features", _top_sql())
def top_features(spark, sf_dir):
    """Top 20 features by |correlation| with the t+2 label (TakeOrderedAndProject)."""
    w = wide_features(spark, sf_dir)
    c = D.correlation_long(w, (), pairs=[(f, "spike_lead_2") for f in _candidates(w.columns)])
    c = c.select(F.col("feature_a").alias("feature"), "corr")
    return (c.withColumn("score", F.abs("corr"))
             .orderBy(F.col("score").desc_nulls_last(), F.col("feature")).limit(TOP_FEATURES))


@register("prediction_export", S.with_h("""
SELECT a.ts, a.y_true, a.y_prob AS load_ratio_prob, b.y_prob AS naive_prob, a.price
FROM p a JOIN p b ON a.ts = b.ts AND b.model = 'naive'
WHERE a.model = 'load_ratio' AND a.split = 'test'""", extra=PRED))
def prediction_export(spark, sf_dir):
    """Wide test-set predictions of both models, one aggregate an hour."""
    p = predictions(spark, sf_dir).filter(F.col("split") == "test")
    of = lambda m, c: F.max(F.when(F.col("model") == m, F.col(c)))
    wide = p.groupBy("ts").agg(of("load_ratio", "y_true").alias("y_true"), of("load_ratio", "y_prob").alias("load_ratio_prob"),
                               of("naive", "y_prob").alias("naive_prob"), of("load_ratio", "price").alias("price"),
                               F.count_distinct("model").alias("_models"))
    return wide.filter("_models = 2").drop("_models")


@register("model_comparison", S.with_h(f"""
SELECT model, tp, fp, fn, tn, {S.r6('COALESCE(CAST(2 * tp AS DOUBLE) / NULLIF(2 * tp + fp + fn, 0), 0.0)')} AS test_f1
FROM (SELECT model, {
    "CAST(sum(CASE WHEN y_true = 1 AND y_prob >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp, "
    "CAST(sum(CASE WHEN y_true = 0 AND y_prob >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fp, "
    "CAST(sum(CASE WHEN y_true = 1 AND y_prob < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fn, "
    "CAST(sum(CASE WHEN y_true = 0 AND y_prob < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tn"}
      FROM p WHERE split = 'test' GROUP BY 1)
ORDER BY test_f1 DESC, model""", extra=PRED))
def model_comparison(spark, sf_dir):
    """Metric rows of every model, ordered by test F1."""
    p = predictions(spark, sf_dir).filter(F.col("split") == "test")
    c = E.confusion(p, ["model"], (F.col("y_prob") >= 0.5).cast("int"))
    return (c.select("model", "tp", "fp", "fn", "tn", r6("f1").alias("test_f1"))
             .orderBy(F.col("test_f1").desc(), "model"))


@register("sigmoid_label", S.with_h(f"""
SELECT ts, {S.r6('1.0 / (1.0 + exp(-((price - 200.0) / 50.0)))')} AS y_prob,
       CAST(1.0 / (1.0 + exp(-((price - 200.0) / 50.0))) >= 0.5 AS INTEGER) AS y_pred FROM h"""))
def sigmoid_label(spark, sf_dir):
    """Logistic score of a linear index and the hard label at 0.5 (>=)."""
    h = hourly_system(spark, sf_dir, materialized=False).select("ts", "price")
    p = sigmoid((F.col("price") - 200.0) / 50.0)
    return h.select("ts", r6(p).alias("y_prob"), (p >= 0.5).cast("int").alias("y_pred"))


def _erf_sql(x: str) -> str:
    from ..functions.columns import _AS_A, _AS_P
    a1, a2, a3, a4, a5 = _AS_A
    t = f"(1.0 / (1.0 + {_AS_P} * abs({x})))"
    poly = f"(((({a5} * {t} + {a4}) * {t} + {a3}) * {t} + {a2}) * {t} + {a1})"
    y = f"(1.0 - {poly} * {t} * exp(-abs({x}) * abs({x})))"
    return f"(CASE WHEN {x} < 0 THEN -{y} ELSE {y} END)"


def _exceed_sql():
    z = f"(({P.SPIKE_THRESHOLD} - f) / GREATEST(se, 1e-6))"
    prob = f"(0.5 * (1.0 - {_erf_sql(f'({z} / sqrt(2.0))')}))"
    return S.with_h(f"""
SELECT ts, {S.r6('f')} AS forecast, {S.r6('se')} AS forecast_se, {S.r6(prob)} AS exceed_prob FROM (
  SELECT ts, CASE WHEN count(price) OVER w = 6 THEN avg(price) OVER w END AS f,
         CASE WHEN count(price) OVER w = 6 THEN stddev_samp(price) OVER w END AS se
  FROM h WINDOW w AS (ORDER BY ts ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))
WHERE f IS NOT NULL""")


@register("exceed_probability", _exceed_sql())
def exceed_probability(spark, sf_dir):
    """P(price > 200) under a normal forecast (rolling mean, rolling std of the
    previous 6 hours), via the A&S 7.1.26 erf approximation as a column expression."""
    h = hourly_system(spark, sf_dir).select("ts", "price")

    def build(w):
        fr = w.rowsBetween(-6, -1)
        full = F.count("price").over(fr) == 6
        return {"f": F.when(full, F.avg("price").over(fr)), "se": F.when(full, F.stddev_samp("price").over(fr))}

    d = series.ordered(h, build, reach=6).filter(F.col("f").isNotNull())
    z = (F.lit(P.SPIKE_THRESHOLD) - F.col("f")) / F.greatest(F.col("se"), F.lit(1e-6))
    return d.select("ts", r6("f").alias("forecast"), r6("se").alias("forecast_se"), r6(normal_sf(z)).alias("exceed_prob"))


LINEAR_COEF = {"price_lag_1h": 0.6, "price_lag_24h": 0.25, "load": 0.01}   # illustrative fixed coefficients
LINEAR_INTERCEPT = 5.0


@register("linear_score", S.with_h(
    f"SELECT ts, {S.r6(' + '.join([str(LINEAR_INTERCEPT)] + [f'{b} * {c}' for c, b in LINEAR_COEF.items()]))} AS price_hat "
    f"FROM wt", extra=WIDE))
def linear_score(spark, sf_dir):
    """Linear score of each row with given coefficients."""
    w = wide_features(spark, sf_dir)
    s = F.lit(LINEAR_INTERCEPT)
    for c, b in LINEAR_COEF.items():
        s = s + F.lit(b) * F.col(c)
    return w.select("ts", r6(s).alias("price_hat"))


# --- parameter variants of the modelled code copies --------------------------------------------

@register("sequence_windows_split", S.with_h(f"""
SELECT split, end_ts, "window", label FROM (
  SELECT split, ts AS end_ts, list([CAST(price AS DOUBLE), CAST(load AS DOUBLE)]) OVER w AS "window",
         count(*) OVER w AS n, y_true AS label
  FROM (SELECT *, {S.split_case()} AS split FROM hl)
  WINDOW w AS (PARTITION BY split ORDER BY ts ROWS BETWEEN {SEQ_LEN - 1} PRECEDING AND CURRENT ROW))
WHERE n = {SEQ_LEN} AND label IS NOT NULL""", extra=PRED))
def sequence_windows_split(spark, sf_dir):
    """T19 variant: windows cut per split (each split loses its first L-1 rows)."""
    h = hourly_system(spark, sf_dir).select("ts", "price", "load")
    h = h.withColumn("spike", (F.col("price") > P.SPIKE_THRESHOLD).cast("int"))
    h = series.ordered(h, series.leads("spike", [P.HORIZON], name="y_true"), reach=P.HORIZON)
    h = prepare.assign_split(h, P.HOURLY_SPLITS)
    w = prepare.sequence_windows(h, SEQ_FEATURES, SEQ_LEN, label="y_true", scope_col="split")
    return w.filter(F.col("label").isNotNull())


@register("class_weight_variants", S.with_h(f"""
SELECT {S.r6('neg / NULLIF(pos, 0)')} AS weight_unguarded, {S.r6('neg / GREATEST(pos, 1.0)')} AS weight_guarded,
       {S.r6('GREATEST(neg / GREATEST(pos, 1.0), 1.0)')} AS weight_floored
FROM (SELECT CAST(sum(spike_lead_2) AS DOUBLE) AS pos, CAST(count(spike_lead_2) - sum(spike_lead_2) AS DOUBLE) AS neg
      FROM wt WHERE ts < TIMESTAMP '{P.HOURLY_SPLITS[0]}')""", extra=WIDE))
def class_weight_variants(spark, sf_dir):
    """neg/pos unguarded, neg/max(pos,1), max(neg/max(pos,1), 1) on the train rows."""
    w = prepare.assign_split(wide_features(spark, sf_dir), P.HOURLY_SPLITS).filter(F.col("split") == "train")
    a = prepare.class_weight(w, "spike_lead_2", guard_pos=False).select(r6("pos_weight").alias("weight_unguarded"))
    b = prepare.class_weight(w, "spike_lead_2", guard_pos=True).select(r6("pos_weight").alias("weight_guarded"))
    c = prepare.class_weight(w, "spike_lead_2", guard_pos=True, floor_one=True).select(
        r6("pos_weight").alias("weight_floored"))
    # three single-row aggregates: attach b and c to a as scalar subqueries (no join)
    return a.select("weight_unguarded", b.scalar().alias("weight_guarded"), c.scalar().alias("weight_floored"))


def _scaler0_sql():
    b1 = P.HOURLY_SPLITS[0]
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {S.r6(f'avg(COALESCE({c}, 0.0))')} AS mean, "
        f"{S.r6(f'COALESCE(NULLIF(stddev_pop(COALESCE({c}, 0.0)), 0), 1.0)')} AS std FROM wt "
        f"WHERE ts < TIMESTAMP '{b1}'" for c in SCALED_NULLABLE)
    return S.with_h(parts, extra=WIDE)


SCALED_NULLABLE = ("price", "reserve_margin", "capacity_gas", "price_lag_24h", "price_rolling_mean_6h")


@register("scaler_stats_ddof0", _scaler0_sql())
def scaler_stats_ddof0(spark, sf_dir):
    """T10 variant: StandardScaler-style ddof 0 with NULL filled as 0 before the fit."""
    w = prepare.assign_split(wide_features(spark, sf_dir), P.HOURLY_SPLITS).filter(F.col("split") == "train")
    stats = prepare.scaler_fit(w, SCALED_NULLABLE, ddof=0, fill_na=0.0)
    return stats.select("column", r6("mean").alias("mean"), r6("std").alias("std"))
