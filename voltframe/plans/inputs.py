"""Derived inputs shared by the registered queries.

* ``hourly_system``  -- H: the integrated wide hourly table (S01 + S02 -> A01 ->
  A02 -> J01).
* ``wide_features``  -- the engineered hourly table (spike flags, leads/lags,
  totals, ratios, rolling, calendar, Fourier, event flag, edge trim).
* ``predictions``    -- P: long prediction frame (model, ts, split, y_true,
  y_prob) that feeds the evaluation operators.
* ``daily_system``   -- D: the daily table with leap days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import params as P
from ..functions import calendar as cal
from ..functions.columns import flag_above
from ..operators import series, system
from ..operators.prepare import assign_split
from ..session import materialize
from ..sources import tables


def hourly_system(spark: SparkSession, sf_dir: str, materialized: bool = True) -> DataFrame:
    """H, written once as a stage table by default: window and quantile operators
    consume their input in several differently pruned branches, which Catalyst
    cannot dedupe, so a lazy H would re-scan the raw table per branch.  Plain
    single-consumer projections pass ``materialized=False`` and fuse it instead."""
    h = system.hourly_wide(tables.events(spark, sf_dir))
    return materialize(h, "hourly") if materialized else h


def daily_system(spark: SparkSession, sf_dir: str, materialized: bool = True) -> DataFrame:
    d = tables.daily_system(spark, sf_dir)
    return materialize(d, "daily") if materialized else d


def wide_features(spark: SparkSession, sf_dir: str, drop_leap: str = "after",
                  leap_adjust: bool = True, event_ranges=P.HOURLY_EVENT_RANGES,
                  threshold: float = P.SPIKE_THRESHOLD, columns=None, materialized: bool = True) -> DataFrame:
    """The engineered table, written once by default.  A reader of some columns names
    them, and neither the others nor the windows behind them are computed; a plan
    that reads it once passes ``materialized=False``."""
    h = hourly_system(spark, sf_dir)
    if drop_leap == "before":
        h = h.filter(~cal.is_leap_day("ts"))
    h = system.system_features(h).withColumn("spike", flag_above("price", threshold))
    n = P.LEAD_LAG_HOURS
    build = series.combine(
        series.leads("spike", range(1, n + 1), name="spike_lead_{k}"),
        series.lags("spike", range(1, n + 1), name="spike_lag_{k}"),
        series.diffs("net_load", [P.NET_LOAD_DIFF], name="net_load_3h_change"),
        series.lags("price", P.PRICE_LAGS, name="price_lag_{k}h"),
        series.shifted_rolling_mean("price", P.ROLLING_WINDOW, "price_rolling_mean_6h"),
    )
    w = series.ordered(h, build, order="ts", reach=n)
    w = w.withColumns(cal.calendar_parts("ts"))
    if drop_leap == "after":
        w = w.filter(~cal.is_leap_day("ts"))
    w = w.withColumns(cal.fourier_terms("ts", leap_adjust=leap_adjust))
    w = cal.event_flag(w, event_ranges, "ts", "is_event")
    w = w.filter(F.col(f"spike_lead_{n}").isNotNull() & F.col(f"spike_lag_{n}").isNotNull())
    if columns is not None:
        w = w.select(*columns)
    return materialize(w, "wide") if materialized else w


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P: two models scored on every hour with a known t+2 outcome."""
    h = hourly_system(spark, sf_dir).select("ts", "price", "load")
    h = h.withColumn("spike", flag_above("price", P.SPIKE_THRESHOLD))
    h = series.ordered(h, series.leads("spike", [P.HORIZON], name="y_true"), reach=P.HORIZON)
    h = h.filter(F.col("y_true").isNotNull())
    h = assign_split(h, P.HOURLY_SPLITS)
    prob = F.round(F.col("load") / (F.col("load") + F.lit(P.PROB_SCALE)), 2).cast("double")
    models = F.array(
        F.struct(F.lit("load_ratio").alias("model"), prob.alias("y_prob")),
        F.struct(F.lit("naive").alias("model"), F.col("spike").cast("double").alias("y_prob")),
    )
    p = (h.withColumn("_m", F.explode(models))
          .select(F.col("_m.model").alias("model"), "ts", "split", "price",
                  F.col("y_true").cast("int").alias("y_true"), F.col("_m.y_prob").alias("y_prob")))
    return materialize(p, "predictions")
