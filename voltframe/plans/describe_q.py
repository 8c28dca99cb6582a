"""Queries: descriptive tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions import calendar as cal
from ..functions.columns import flag_above, r6
from ..operators import describe as D
from ..operators import system
from ..operators.prepare import assign_split
from ..session import materialize
from . import sql as S
from .inputs import daily_system, hourly_system, wide_features
from .registry import register

WIDE = S.wide_ctes()
HOURS = list(range(24))


def _h_cal(spark, sf_dir, materialized=True):
    h = hourly_system(spark, sf_dir, materialized)
    return h.withColumns(cal.calendar_parts("ts")).withColumn("spike", flag_above("price", P.SPIKE_THRESHOLD))


def _pivot_sql(expr: str) -> str:
    cols = ", ".join(f"{S.r6(f'avg({expr}) FILTER (WHERE hour(ts) = {h})')} AS h{h:02d}" for h in HOURS)
    return S.with_h(f"SELECT CAST(month(ts) AS INTEGER) AS month, {cols} FROM h GROUP BY 1")


@register("heatmap_month_hour", _pivot_sql("price"))
def heatmap_month_hour(spark, sf_dir):
    """Mean price, month x hour (fixed 24 hour columns)."""
    return D.pivot_mean(_h_cal(spark, sf_dir, False), "month", "hour_of_day", "price", HOURS)


@register("spike_heatmap", _pivot_sql(f"CAST(price > {P.SPIKE_THRESHOLD} AS INTEGER) * 100.0"))
def spike_heatmap(spark, sf_dir):
    """Spike rate in percent, month x hour."""
    return D.pivot_mean(_h_cal(spark, sf_dir, False), "month", "hour_of_day", "spike", HOURS, scale=100.0)


def _mean_by_sql():
    parts = []
    for d, e in (("hour_of_day", "hour(ts)"), ("day_of_week", S.weekday()), ("month", "month(ts)")):
        parts.append(f"SELECT '{d}' AS dimension, CAST({e} AS INTEGER) AS key, {S.r6('avg(load)')} AS mean_load "
                     f"FROM h GROUP BY 1, 2")
    return S.with_h(" UNION ALL ".join(parts))


@register("mean_by_calendar", _mean_by_sql())
def mean_by_calendar(spark, sf_dir):
    """Mean load by hour, weekday, month."""
    return D.mean_by(_h_cal(spark, sf_dir), "load", ["hour_of_day", "day_of_week", "month"])


@register("spike_by_year", "WITH " + S.d_ctes() + f""",
y AS (SELECT CAST(year(ts) AS INTEGER) AS year, sum(CAST(price > {P.DAILY_SPIKE_THRESHOLD} AS INTEGER)) AS spike_count,
             avg(CAST(price > {P.DAILY_SPIKE_THRESHOLD} AS INTEGER)) AS rate FROM d GROUP BY 1)
SELECT year, CAST(spike_count AS BIGINT) AS spike_count, {S.r6('rate')} AS spike_rate,
       printf('%.2f%%', round(rate * 100, 2)) AS spike_rate_pct FROM y""")
def spike_by_year(spark, sf_dir):
    """A06 + P37: yearly spike count and rate, with a percent label."""
    d = daily_system(spark, sf_dir, materialized=False).withColumn("spike", flag_above("price", P.DAILY_SPIKE_THRESHOLD))
    y = d.groupBy(F.year("ts").alias("year")).agg(F.sum("spike").cast("long").alias("spike_count"),
                                                  F.avg("spike").alias("rate"))
    return y.select("year", "spike_count", r6("rate").alias("spike_rate"),
                    F.format_string("%.2f%%", F.round(F.col("rate") * 100, 2)).alias("spike_rate_pct"))


_COND = ("price", "net_load", "wind_total", "renewables_share", "reserve_margin")


@register("conditions_by_label", S.with_h(
    "SELECT spike_lead_2 AS label, count(*) AS rows, " + ", ".join(f"{S.r6(f'avg({c})')} AS mean_{c}" for c in _COND)
    + " FROM wt GROUP BY 1", extra=WIDE))
def conditions_by_label(spark, sf_dir):
    """Mean conditions by the t+2 label."""
    w = wide_features(spark, sf_dir)
    return w.groupBy(F.col("spike_lead_2").alias("label")).agg(
        F.count(F.lit(1)).alias("rows"), *[r6(F.avg(c)).alias(f"mean_{c}") for c in _COND])


def _split_sql():
    return S.with_h(f"""
SELECT split, count(*) AS rows, min(ts) AS start, max(ts) AS "end", {S.r6('avg(spike_lead_2)')} AS spike_rate_lead_2
FROM (SELECT *, {S.split_case()} AS split FROM wt) GROUP BY split""", extra=WIDE)


@register("split_summary", _split_sql())
def split_summary(spark, sf_dir):
    """Rows, start, end and t+2 spike rate per split."""
    w = assign_split(wide_features(spark, sf_dir), P.HOURLY_SPLITS)
    return w.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min("ts").alias("start"),
                                  F.max("ts").alias("end"), r6(F.avg("spike_lead_2")).alias("spike_rate_lead_2"))


def _null_sql():
    from .features import _wide_columns
    ints, doubles = _wide_columns()
    cols = ["ts", *ints, *doubles]
    body = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM wt"
                              for c in cols)
    return S.with_h(f"SELECT * FROM ({body}) ORDER BY nulls DESC, \"column\" LIMIT 10", extra=WIDE)


@register("null_profile", _null_sql())
def null_profile(spark, sf_dir):
    """A10: NULL counts per column of the engineered table, top 10."""
    return D.null_profile(wide_features(spark, sf_dir), top=10)


@register("value_counts", S.with_h("SELECT spike_lead_2, count(*) AS count FROM wt GROUP BY 1", extra=WIDE))
def value_counts(spark, sf_dir):
    """Value counts of the target."""
    return D.value_counts(wide_features(spark, sf_dir, materialized=False), "spike_lead_2")


def _quality_sql():
    lo, hi = P.QUALITY_ROWS
    slo, shi = P.QUALITY_SPIKE_HOURS
    base = ("ts", "price", "load", "spike", "total_generation", "total_capability", "net_load")
    nulls = " + ".join(f"(count(*) - count({c}))" for c in base)
    q = (f"q AS (SELECT count(*) AS n, {nulls} AS nulls, sum(CAST(price > {P.SPIKE_THRESHOLD} AS INTEGER)) AS high, "
         f"avg(spike) AS rate, epoch(min(ts)) AS t0, epoch(max(ts)) AS t1, "
         f"(SELECT count(*) FROM (DESCRIBE SELECT * FROM wt)) AS cols FROM wt)")
    return S.with_h(f"""
SELECT 'rows' AS "check", CAST(n AS DOUBLE) AS value, n BETWEEN {lo} AND {hi} AS ok FROM q
UNION ALL SELECT 'null_base_values', CAST(nulls AS DOUBLE), nulls = 0 FROM q
UNION ALL SELECT 'price_above_threshold', CAST(high AS DOUBLE), high BETWEEN {slo} AND {shi} FROM q
UNION ALL SELECT 'spike_rate', {S.r6('rate')}, TRUE FROM q
UNION ALL SELECT 'columns', CAST(cols AS DOUBLE), TRUE FROM q
UNION ALL SELECT 'first_time', CAST(t0 AS DOUBLE), t0 IS NOT NULL FROM q
UNION ALL SELECT 'last_time', CAST(t1 AS DOUBLE), t1 IS NOT NULL FROM q""", extra=WIDE + "," + q)


@register("quality_report", _quality_sql())
def quality_report(spark, sf_dir):
    """Validation report of the engineered table as (check, value, ok) rows."""
    w = wide_features(spark, sf_dir)
    lo, hi = P.QUALITY_ROWS
    slo, shi = P.QUALITY_SPIKE_HOURS
    base = ("ts", "price", "load", "spike", "total_generation", "total_capability", "net_load")
    q = w.agg(F.count(F.lit(1)).alias("n"),
              sum((F.count(F.lit(1)) - F.count(c) for c in base), F.lit(0)).alias("nulls"),
              F.sum((F.col("price") > P.SPIKE_THRESHOLD).cast("long")).alias("high"),
              F.avg("spike").alias("rate"), *[F.unix_timestamp(f("ts").cast("timestamp")).alias(n) for n, f in (("t0", F.min), ("t1", F.max))])

    def check(name, value, ok):
        return F.struct(F.lit(name).alias("check"), value.cast("double").alias("value"), ok.alias("ok"))

    checks = F.array(check("rows", F.col("n"), F.col("n").between(lo, hi)),
                     check("null_base_values", F.col("nulls"), F.col("nulls") == 0),
                     check("price_above_threshold", F.col("high"), F.col("high").between(slo, shi)),
                     check("spike_rate", r6("rate"), F.lit(True)),
                     check("columns", F.lit(len(w.columns)), F.lit(True)),
                     check("first_time", F.col("t0"), F.col("t0").isNotNull()),
                     check("last_time", F.col("t1"), F.col("t1").isNotNull()))
    return q.select(F.explode(checks).alias("_c")).select("_c.*")


@register("price_describe", S.with_h(
    "SELECT stat, " + S.r6("value") + " AS value FROM ("
    "SELECT 'count' AS stat, CAST(count(price) AS DOUBLE) AS value FROM h UNION ALL "
    "SELECT 'mean', avg(price) FROM h UNION ALL SELECT 'std', stddev_samp(price) FROM h UNION ALL "
    "SELECT 'min', min(price) FROM h UNION ALL SELECT 'max', max(price) FROM h UNION ALL "
    + " UNION ALL ".join(f"SELECT 'p{round(p * 1000):04d}', quantile_cont(price, {p}) FROM h"
                         for p in P.DESCRIBE_PERCENTILES) + ")"))
def price_describe(spark, sf_dir):
    """describe(percentiles=[.5, .9, .95, .99, .999]) with exact quantiles."""
    return D.describe(hourly_system(spark, sf_dir), "price", P.DESCRIBE_PERCENTILES)


@register("price_quantiles", S.with_h(
    "SELECT " + ", ".join(f"round(quantile_cont(price, {p}), 2) AS q_{str(p).replace('.', '_')}"
                          for p in P.REPORT_QUANTILES) + " FROM h"))
def price_quantiles(spark, sf_dir):
    """Quantiles rounded to 2 places (T28: linear interpolation, exact)."""
    q = D.exact_quantiles(hourly_system(spark, sf_dir), "price", P.REPORT_QUANTILES)
    return q.select(*[F.round(c, 2).alias(c) for c in q.columns])


@register("monthly_resample", "WITH " + S.d_ctes() + f""",
m AS (SELECT CAST(date_trunc('month', ts) AS TIMESTAMP) AS month, price, load FROM d),
sp AS (SELECT unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS month FROM m),
a AS (SELECT month, quantile_cont(price, 0.5) AS med, avg(load) AS ml, count(*) AS rows FROM m GROUP BY 1)
SELECT sp.month, {S.r6('med')} AS median_price, {S.r6('ml')} AS mean_load, COALESCE(rows, 0) AS rows
FROM sp LEFT JOIN a ON sp.month = a.month""")
def monthly_resample(spark, sf_dir):
    """A15 (T27): monthly median price and mean load; empty months kept."""
    return D.monthly_resample(daily_system(spark, sf_dir), "price", ["load"])


def _profile_sql(ctes: str, src: str, cols, period: str) -> str:
    rows = " UNION ALL ".join(f"SELECT date_trunc('{period}', ts) AS p, '{c}' AS col, CAST({c} AS DOUBLE) AS v FROM {src}" for c in cols)
    return f"""WITH {ctes},
lg AS ({rows}),
sp AS (SELECT unnest(generate_series(min(p), max(p), INTERVAL 1 {period.upper()})) AS p FROM lg),
nm AS (SELECT DISTINCT col FROM lg),
ag AS (SELECT p, col, quantile_cont(v, 0.5) AS med, avg(v) AS mean, count(v) AS rows FROM lg GROUP BY ALL)
SELECT CAST(sp.p AS TIMESTAMP) AS period, nm.col AS "column", {S.r6('med')} AS median, {S.r6('mean')} AS mean, coalesce(rows, 0) AS rows
FROM sp CROSS JOIN nm LEFT JOIN ag ON ag.p = sp.p AND ag.col = nm.col"""


DAILY_COLUMNS = ("price", "load", *[f"type{i}_total" for i in range(1, len(P.PRIORITIES) + 1)])
SYSTEM_COLUMNS = (*P.BASE_COLUMNS, "net_export", "total_generation", "total_capability", "renewable_generation", "gas_mix", "solar_mix",
                  "renewables_share", "capacity_gas", "net_load", "reserve_margin")


@register("monthly_profile", _profile_sql(S.d_ctes(), "d", DAILY_COLUMNS, "month"))
def monthly_profile(spark, sf_dir):
    """A15 (T27): exact median and mean of every daily column in every month."""
    return D.period_profile(daily_system(spark, sf_dir), DAILY_COLUMNS, "month")


@register("daily_profile", _profile_sql(S.h_ctes() + "," + S.sys_cte("h", "s"), "s", SYSTEM_COLUMNS, "day"))
def daily_profile(spark, sf_dir):
    """A15 on the hourly table: exact median and mean of 27 columns (some with NULLs) in every day."""
    return D.period_profile(system.system_features(hourly_system(spark, sf_dir)), SYSTEM_COLUMNS, "day")


@register("monthly_sketch")
def monthly_sketch(spark, sf_dir):
    """A15 at scale: the monthly profile from stored daily KLL sketches; medians
    within a stated share of ranks, means exact."""
    d = daily_system(spark, sf_dir)
    sketches = materialize(D.column_sketches(d, DAILY_COLUMNS, "day"), "sketches")
    return D.merged_profile(sketches, d, DAILY_COLUMNS, "month")


_CORR = ("price", "load", "total_generation", "total_capability", "gas_total", "wind_total", "solar_total",
         "renewable_generation", "net_load", "reserve_margin", "renewables_share", "gas_ratio", "net_export",
         "price_lag_1h", "price_lag_24h", "spike_lead_2")


def _corr_sql():
    parts = []
    for i, a in enumerate(_CORR):
        for b in _CORR[:i]:
            ma = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
            mb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
            e = f"covar_pop({ma}, {mb}) / NULLIF(stddev_pop({ma}) * stddev_pop({mb}), 0)"
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {S.r6(e)} AS corr FROM wt")
    return S.with_h(" UNION ALL ".join(parts), extra=WIDE)


@register("correlation_matrix", _corr_sql())
def correlation_matrix(spark, sf_dir):
    """Lower-triangle correlation matrix of 16 key features, long form."""
    return D.correlation_long(wide_features(spark, sf_dir, columns=_CORR), _CORR)


def _hist_sql():
    n = P.HIST_BINS
    return S.with_h(f"""
SELECT bins.bin, {S.r6(f'mn + CAST(bins.bin - 1 AS DOUBLE) * w / {float(n)}')} AS lower,
       {S.r6(f'mn + CAST(bins.bin AS DOUBLE) * w / {float(n)}')} AS upper, COALESCE(count, 0) AS count
FROM bins CROSS JOIN mm LEFT JOIN cnt ON bins.bin = cnt.bin""", extra=f"""
c AS (SELECT LEAST(price, {P.HIST_CLIP_UPPER}) AS v FROM h WHERE price IS NOT NULL),
mm AS (SELECT min(v) AS mn, CASE WHEN max(v) > min(v) THEN max(v) - min(v) ELSE 1.0 END AS w FROM c),
b AS (SELECT LEAST(CAST(floor((v - mn) * {float(n)} / w) AS INTEGER) + 1, {n}) AS bin FROM c, mm),
cnt AS (SELECT bin, count(*) AS count FROM b GROUP BY 1),
bins AS (SELECT CAST(unnest(generate_series(1, {n})) AS INTEGER) AS bin)""")


@register("price_histogram", _hist_sql())
def price_histogram(spark, sf_dir):
    """A17 + P08: price clipped at 800, 80 equal bins, last bin closed."""
    return D.histogram(hourly_system(spark, sf_dir), "price", P.HIST_BINS, clip_upper=P.HIST_CLIP_UPPER)


def _box_sql():
    inside = "v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)"
    return S.with_h(f"""
SELECT label, {S.r6('q1')} AS q1, {S.r6('median')} AS median, {S.r6('q3')} AS q3,
       {S.r6(f'min(v) FILTER (WHERE {inside})')} AS whisker_low,
       {S.r6(f'max(v) FILTER (WHERE {inside})')} AS whisker_high, count(*) AS rows
FROM j GROUP BY label, q1, median, q3""", extra=WIDE + """,
q AS (SELECT spike_lead_2 AS label, quantile_cont(load, 0.25) AS q1, quantile_cont(load, 0.5) AS median,
             quantile_cont(load, 0.75) AS q3 FROM wt GROUP BY 1),
j AS (SELECT q.label, CAST(wt.load AS DOUBLE) AS v, q1, median, q3 FROM wt JOIN q ON wt.spike_lead_2 = q.label)""")


@register("box_stats", _box_sql())
def box_stats(spark, sf_dir):
    """Box statistics of load by the t+2 label."""
    w = wide_features(spark, sf_dir, columns=["load", "spike_lead_2"]).withColumn("label", F.col("spike_lead_2"))
    return D.box_stats(w, "load", "label")


_UNPIV = ("price", "net_load", "wind_total", "reserve_margin")


@register("unpivot_conditions", S.with_h(
    "SELECT ts, spike_lead_2 AS label, measure, " + S.r6("value") + " AS value FROM ("
    + " UNION ALL ".join(f"SELECT ts, spike_lead_2, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM wt"
                         for m in _UNPIV) + ")", extra=WIDE))
def unpivot_conditions(spark, sf_dir):
    """Melt measures to long form by label."""
    w = wide_features(spark, sf_dir, columns=["ts", "spike_lead_2", *_UNPIV], materialized=False).withColumnRenamed("spike_lead_2", "label")
    return D.unpivot_measures(w, ["ts", "label"], _UNPIV).withColumn("value", r6("value"))
