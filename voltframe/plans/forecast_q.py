"""Queries: walk-forward forecasts joined to the splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import params as P
from ..functions import calendar as cal
from ..functions.columns import col, flag_above, normal_sf, r6
from ..operators import moments, prepare, series
from ..session import materialize
from . import linear_sql as L
from . import sql as S
from .inputs import daily_system, hourly_system
from .registry import register


def exceed(forecast: str = "forecast", se: str = "forecast_se", threshold: float = P.SPIKE_THRESHOLD):
    """Probability of a value above ``threshold``, to 6 places."""
    return r6(normal_sf((F.lit(threshold) - F.col(forecast)) / F.greatest(F.col(se), F.lit(1e-6))))


def hourly_forecasts(h: DataFrame) -> DataFrame:
    """``ts``, ``forecast``, ``forecast_se``, ``ar_prob`` of each hour that has enough before it."""
    out = moments.walk_forward(h.select("ts", "price"), "price", cal.fourier_week_hours)
    return out.filter(F.col("forecast").isNotNull()).select("ts", "forecast", "forecast_se", exceed().alias("ar_prob"))


def year_day_terms(t) -> dict:
    """Weekly and yearly Fourier terms of a day (leap-adjusted)."""
    terms = cal.fourier_terms(t, leap_adjust=True)
    return {k: terms[k] for k in ("sin_week", "cos_week", "sin_year_1", "cos_year_1")}


def _joined(rows: DataFrame, forecasts: DataFrame, splits, threshold: float) -> DataFrame:
    """Validation and test rows with a known outcome two steps on, each with its forecast or NULL."""
    rows = series.ordered(rows.select("ts", "price"), series.leads("price", [P.HORIZON], name="price_lead_2"), reach=P.HORIZON)
    rows = prepare.assign_split(rows.filter(F.col("price_lead_2").isNotNull()), splits).filter(F.col("split") != "train")
    out = rows.join(forecasts, "ts", "left")
    return out.select("ts", "split", flag_above("price_lead_2", threshold).alias("y_true"), "price_lead_2", F.round("forecast", 3).alias("forecast"),
                      F.round("forecast_se", 3).alias("forecast_se"), F.col("prob").alias("spike_prob"))


def _walk_sql(src: str, walk: str, ctes: str, splits, threshold: float) -> str:
    return f"""WITH RECURSIVE {ctes}, {walk},
l AS (SELECT ts, LEAD(price, {P.HORIZON}) OVER (ORDER BY ts) AS price_lead_2 FROM {src})
SELECT ts, {S.split_case(bounds=splits)} AS split, CAST(price_lead_2 > {threshold} AS INTEGER) AS y_true, price_lead_2,
  round(forecast, 3) AS forecast, round(forecast_se, 3) AS forecast_se, {L.upper_tail('forecast', 'forecast_se', threshold)} AS spike_prob
FROM l LEFT JOIN wf USING (ts) WHERE price_lead_2 IS NOT NULL AND ts >= TIMESTAMP '{splits[0]}'"""


@register("walk_forward_forecast", _walk_sql("h", L.HOURLY_WALK, S.h_ctes(), P.HOURLY_SPLITS, P.SPIKE_THRESHOLD))
def walk_forward_forecast(spark, sf_dir):
    """Every validation and test hour, left-joined with its leak-free two-step
    forecast: the fit of all hours up to it, from running sums of products."""
    h = hourly_system(spark, sf_dir)
    f = hourly_forecasts(h).withColumnRenamed("ar_prob", "prob")
    return _joined(h, f, P.HOURLY_SPLITS, P.SPIKE_THRESHOLD)


@register("walk_forward_daily", _walk_sql("d", L.DAILY_WALK, S.d_ctes(), P.DAILY_SPLITS, P.DAILY_SPIKE_THRESHOLD))
def walk_forward_daily(spark, sf_dir):
    """J04 on the daily table (weekly and yearly terms, leap days, gaps)."""
    d = materialize(daily_system(spark, sf_dir).select("ts", "price"), "daily-price")
    f = moments.walk_forward(d, "price", year_day_terms, step=lambda t, k: col(t) + F.make_dt_interval(days=F.lit(k)))
    f = f.filter(F.col("forecast").isNotNull()).select("ts", "forecast", "forecast_se", exceed(threshold=P.DAILY_SPIKE_THRESHOLD).alias("prob"))
    return _joined(d, f, P.DAILY_SPLITS, P.DAILY_SPIKE_THRESHOLD)
