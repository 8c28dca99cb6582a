"""Queries: engineered hourly features."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import params as P
from ..functions import calendar as cal
from ..functions.columns import flag_above, r6
from ..operators import series, system
from . import sql as S
from .inputs import daily_system, hourly_system, wide_features
from .registry import register

N = P.LEAD_LAG_HOURS


def _sys(spark, sf_dir, materialized=True):
    return system.system_features(hourly_system(spark, sf_dir, materialized))


def _r6_all(df, keep=("ts",)):
    types = dict(df.dtypes)
    return df.select(*[F.col(c) if c in keep or types[c] != "double" else r6(c).alias(c) for c in df.columns])


SYS = S.sys_cte("h", "s")


@register("spike_flag", S.with_h(f"SELECT ts, price, CAST(price > {P.SPIKE_THRESHOLD} AS INTEGER) AS spike FROM h"))
def spike_flag(spark, sf_dir):
    """Strict price > threshold as int."""
    return hourly_system(spark, sf_dir, materialized=False).select("ts", "price", flag_above("price", P.SPIKE_THRESHOLD).alias("spike"))


_TOTALS = ("net_export", "total_generation", "total_capability", "dispatchable_generation",
           "dispatchable_capability", "renewable_generation", "renewable_capability")


@register("system_totals", S.with_h("SELECT ts, " + ", ".join(f"{S.r6(c)} AS {c}" for c in _TOTALS) + " FROM s",
                                    extra=SYS))
def system_totals(spark, sf_dir):
    return _r6_all(system.system_totals(hourly_system(spark, sf_dir, materialized=False)).select("ts", *_TOTALS))


_MIX = tuple(f"{f}_mix" for f in P.FUELS)


@register("generation_mix", S.with_h("SELECT ts, " + ", ".join(f"{S.r6(c)} AS {c}" for c in _MIX) + " FROM s",
                                     extra=SYS))
def generation_mix(spark, sf_dir):
    return _r6_all(_sys(spark, sf_dir, False).select("ts", *_MIX))


_DEM = ("renewables_share", "dispatchable_ratio", "gas_ratio", "intertie_support")


@register("demand_ratios", S.with_h("SELECT ts, " + ", ".join(f"{S.r6(c)} AS {c}" for c in _DEM) + " FROM s",
                                    extra=SYS))
def demand_ratios(spark, sf_dir):
    return _r6_all(_sys(spark, sf_dir, False).select("ts", *_DEM))


_CAP = ("capacity_renewable", "capacity_dispatchable", "capacity_gas")


@register("capacity_ratios", S.with_h("SELECT ts, " + ", ".join(f"{S.r6(c)} AS {c}" for c in _CAP) + " FROM s",
                                      extra=SYS))
def capacity_ratios(spark, sf_dir):
    return _r6_all(_sys(spark, sf_dir, False).select("ts", *_CAP))


_RES = ("net_load", "resilience_buffer", "reserve_margin")


@register("reserve_margin", S.with_h("SELECT ts, " + ", ".join(f"{S.r6(c)} AS {c}" for c in _RES) + " FROM s",
                                     extra=SYS))
def reserve_margin(spark, sf_dir):
    return _r6_all(_sys(spark, sf_dir, False).select("ts", *_RES))


WIN = SYS + "," + S.window_ctes("s")


@register("spike_leads", S.with_h("SELECT ts, spike, " + ", ".join(f"spike_lead_{k}" for k in range(1, N + 1))
                                  + " FROM wl", extra=WIN))
def spike_leads(spark, sf_dir):
    """Lead flags 1..24 (one Window exec for all offsets)."""
    h = hourly_system(spark, sf_dir).select("ts", flag_above("price", P.SPIKE_THRESHOLD).alias("spike"))
    return series.ordered(h, series.leads("spike", range(1, N + 1), name="spike_lead_{k}"), reach=N)


@register("spike_lags", S.with_h("SELECT ts, spike, " + ", ".join(f"spike_lag_{k}" for k in range(1, N + 1))
                                 + " FROM wl", extra=WIN))
def spike_lags(spark, sf_dir):
    """Lag flags 1..24."""
    h = hourly_system(spark, sf_dir).select("ts", flag_above("price", P.SPIKE_THRESHOLD).alias("spike"))
    return series.ordered(h, series.lags("spike", range(1, N + 1), name="spike_lag_{k}"), reach=N)


@register("price_lags", S.with_h("SELECT ts, price, " + ", ".join(f"price_lag_{k}h" for k in P.PRICE_LAGS)
                                 + " FROM wl", extra=WIN))
def price_lags(spark, sf_dir):
    """Price lags 1, 6, 24 rows."""
    h = hourly_system(spark, sf_dir).select("ts", "price")
    return series.ordered(h, series.lags("price", P.PRICE_LAGS, name="price_lag_{k}h"), reach=max(P.PRICE_LAGS))


def _multi_lag_sql():
    cols = ", ".join(f"{S.r6(f'LAG({s}, {k}) OVER w')} AS {s}_lag_{k}h" for s in P.LAG_SOURCES for k in P.LAG_HOURS)
    return S.with_h(f"SELECT ts, {cols} FROM s WINDOW w AS (ORDER BY ts)", extra=SYS)


@register("multi_lags", _multi_lag_sql())
def multi_lags(spark, sf_dir):
    """8 sources x lags 1, 6, 24."""
    d = _sys(spark, sf_dir).select("ts", *P.LAG_SOURCES)
    b = series.combine(*[series.lags(s, P.LAG_HOURS, name="{src}_lag_{k}h") for s in P.LAG_SOURCES])
    out = series.ordered(d, b, reach=max(P.LAG_HOURS))
    return _r6_all(out.drop(*P.LAG_SOURCES))


def _multi_change_sql():
    cols = ", ".join(f"{S.r6(f'{s} - LAG({s}, {k}) OVER w')} AS {s}_change_{k}h"
                     for s in P.CHANGE_SOURCES for k in P.CHANGE_HOURS)
    return S.with_h(f"SELECT ts, {cols}, {S.r6(f'net_load - LAG(net_load, {P.NET_LOAD_DIFF}) OVER w')} "
                    f"AS net_load_3h_change FROM s WINDOW w AS (ORDER BY ts)", extra=SYS)


@register("multi_changes", _multi_change_sql())
def multi_changes(spark, sf_dir):
    """Differences over k rows (6 sources x 1, 24; net load over 3)."""
    d = _sys(spark, sf_dir).select("ts", *P.CHANGE_SOURCES)
    b = series.combine(*[series.diffs(s, P.CHANGE_HOURS, name="{src}_change_{k}h") for s in P.CHANGE_SOURCES],
                       series.diffs("net_load", [P.NET_LOAD_DIFF], name="net_load_3h_change"))
    out = series.ordered(d, b, reach=max(P.CHANGE_HOURS))
    return _r6_all(out.drop(*P.CHANGE_SOURCES))


@register("price_rolling_mean", S.with_h(f"SELECT ts, {S.r6('price_rolling_mean_6h')} AS price_rolling_mean_6h FROM wl",
                                         extra=WIN))
def price_rolling_mean(spark, sf_dir):
    """shift(1).rolling(6).mean() -- full windows only."""
    h = hourly_system(spark, sf_dir).select("ts", "price")
    out = series.ordered(h, series.shifted_rolling_mean("price", P.ROLLING_WINDOW, "price_rolling_mean_6h"),
                         reach=P.ROLLING_WINDOW)
    return out.select("ts", r6("price_rolling_mean_6h").alias("price_rolling_mean_6h"))


@register("target_lead2", S.with_h(f"""
SELECT ts, price, price_lead_2, CAST(price_lead_2 > {P.SPIKE_THRESHOLD} AS INTEGER) AS spike_lead_2
FROM (SELECT ts, price, LEAD(price, {P.HORIZON}) OVER (ORDER BY ts) AS price_lead_2 FROM h)
WHERE price_lead_2 IS NOT NULL"""))
def target_lead2(spark, sf_dir):
    """W07 + T5: lead price at the horizon, its flag; rows without a lead dropped."""
    h = hourly_system(spark, sf_dir).select("ts", "price")
    out = series.ordered(h, series.leads("price", [P.HORIZON], name="price_lead_2"), reach=P.HORIZON)
    return (out.filter(F.col("price_lead_2").isNotNull())
               .withColumn("spike_lead_2", flag_above("price_lead_2", P.SPIKE_THRESHOLD)))


def _wide_columns():
    ints = ["spike", *[f"spike_lead_{k}" for k in range(1, N + 1)], *[f"spike_lag_{k}" for k in range(1, N + 1)],
            "hour_of_day", "day_of_week", "month", "year", "is_weekend", "is_event"]
    doubles = [*P.BASE_COLUMNS, *_TOTALS, *_MIX, *_DEM, *_CAP, *_RES, "net_load_3h_change",
               *[f"price_lag_{k}h" for k in P.PRICE_LAGS], "price_rolling_mean_6h", *P.CYCLICAL]
    return ints, doubles


def _wide_sql():
    ints, doubles = _wide_columns()
    return S.with_h("SELECT ts, " + ", ".join(ints) + ", " + ", ".join(f"{S.r6(c)} AS {c}" for c in doubles)
                    + " FROM wt", extra=S.wide_ctes())


@register("wide_features", _wide_sql(), headline=True)
def wide_features_q(spark, sf_dir):
    """Entry point A: the full engineered hourly table (leap day removed after
    the shifts, Fourier with leap adjustment, event flag, edge rows trimmed)."""
    return _r6_all(wide_features(spark, sf_dir, materialized=False))


@register("complete_rows", S.with_h("SELECT count(*) AS rows_kept, min(ts) AS first_ts, max(ts) AS last_ts FROM wt",
                                    extra=S.wide_ctes()))
def complete_rows(spark, sf_dir):
    """Edge trim on the lead/lag 24 columns."""
    w = wide_features(spark, sf_dir, columns=["ts"], materialized=False)
    return w.agg(F.count(F.lit(1)).alias("rows_kept"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@register("calendar_parts", "WITH " + S.d_ctes() + f" SELECT ts, {S.calendar_sql()} FROM d")
def calendar_parts(spark, sf_dir):
    """P26 on the daily table (several calendar years)."""
    return daily_system(spark, sf_dir, materialized=False).select("ts", *[v.alias(k) for k, v in cal.calendar_parts("ts").items()])


@register("fourier_calendar", "WITH " + S.d_ctes() + ", f AS (SELECT ts, " + S.fourier_sql() + " FROM d) SELECT ts, "
          + ", ".join(f"{S.r6(c)} AS {c}" for c in P.CYCLICAL) + " FROM f")
def fourier_calendar(spark, sf_dir):
    """P27 (T13 leap adjustment) on the daily table."""
    d = daily_system(spark, sf_dir, materialized=False).select("ts")
    return d.select("ts", *[r6(v).alias(k) for k, v in cal.fourier_terms("ts", leap_adjust=True).items()])


_FWH = ("sin_day_1", "cos_day_1", "sin_day_2", "cos_day_2", "sin_week_1", "cos_week_1")


def _fwh_sql():
    hour = "(CAST(hour(ts) AS DOUBLE) + CAST(minute(ts) AS DOUBLE) / 60.0)"
    how = f"CAST({S.weekday()} * 24 + hour(ts) AS DOUBLE)"
    exprs = [f"sin((2 * pi()) * {hour} / 24.0)", f"cos((2 * pi()) * {hour} / 24.0)",
             f"sin((2 * (2 * pi())) * {hour} / 24.0)", f"cos((2 * (2 * pi())) * {hour} / 24.0)",
             f"sin((2 * pi()) * {how} / 168.0)", f"cos((2 * pi()) * {how} / 168.0)"]
    return S.with_h("SELECT ts, " + ", ".join(f"{S.r6(e)} AS {n}" for e, n in zip(exprs, _FWH)) + " FROM h")


@register("fourier_week_hours", _fwh_sql())
def fourier_week_hours(spark, sf_dir):
    """Daily k=1,2 on the fractional hour, weekly on hour of week."""
    h = hourly_system(spark, sf_dir, materialized=False).select("ts")
    return h.select("ts", *[r6(v).alias(k) for k, v in cal.fourier_week_hours("ts").items()])


def _one_hot_sql():
    parts = []
    for prefix, (src, cats) in cal.ONE_HOT_CATEGORIES.items():
        expr = {"hour_of_day": "hour(ts)", "day_of_week": S.weekday(), "month": "month(ts)"}[src]
        parts += [f"CAST({expr} = {k} AS INTEGER) AS {prefix}_{k}" for k in cats]
    return S.with_h("SELECT ts, " + ", ".join(parts) + " FROM h")


@register("calendar_one_hot", _one_hot_sql())
def calendar_one_hot(spark, sf_dir):
    """P25: 43 fixed-category indicators (hour 0-23, weekday 0-6, month 1-12)."""
    h = hourly_system(spark, sf_dir, materialized=False).select("ts").withColumns(cal.calendar_parts("ts"))
    return h.select("ts", *[v.alias(k) for k, v in cal.one_hot().items()])


@register("event_flag", S.with_h(f"SELECT ts, {S.event_sql()} FROM h"))
def event_flag(spark, sf_dir):
    """Inclusive date ranges; last day counts for its 00:00 row only."""
    h = hourly_system(spark, sf_dir, materialized=False).select("ts")
    return cal.event_flag(h, P.HOURLY_EVENT_RANGES, "ts", "is_event")


@register("drop_leap_day", "WITH " + S.d_ctes() + """
SELECT count(*) AS rows_before, CAST(sum(CASE WHEN month(ts) = 2 AND day(ts) = 29 THEN 1 ELSE 0 END) AS BIGINT) AS leap_rows,
       CAST(sum(CASE WHEN month(ts) = 2 AND day(ts) = 29 THEN 0 ELSE 1 END) AS BIGINT) AS rows_after FROM d""")
def drop_leap_day(spark, sf_dir):
    """Rows removed by the Feb 29 filter (counted in one pass)."""
    d = daily_system(spark, sf_dir, materialized=False)
    leap = cal.is_leap_day("ts")
    return d.agg(F.count(F.lit(1)).alias("rows_before"), F.sum(leap.cast("long")).alias("leap_rows"),
                 F.sum((~leap).cast("long")).alias("rows_after"))


@register("row_index", S.with_h("SELECT ts, row_number() OVER (ORDER BY ts) - 1 AS idx FROM h"))
def row_index(spark, sf_dir):
    """Two-level row position (no single-partition window)."""
    return series.add_row_index(hourly_system(spark, sf_dir).select("ts"), "ts", idx="idx")


@register("axis_gaps", "WITH " + S.d_ctes() + """,
x AS (SELECT ts, LAG(ts) OVER (ORDER BY ts) AS prev_ts FROM d)
SELECT prev_ts, ts AS next_ts, CAST(date_diff('second', prev_ts, ts) / 86400 - 1 AS BIGINT) AS missing_steps
FROM x WHERE date_diff('second', prev_ts, ts) > 86400""")
def axis_gaps(spark, sf_dir):
    """Missing days on the daily axis (row semantics would silently skip them)."""
    return series.axis_gaps(daily_system(spark, sf_dir), "ts", step_seconds=86400)


@register("lag_by_time", "WITH " + S.d_ctes() + """
SELECT a.ts, a.price, LAG(a.price) OVER (ORDER BY a.ts) AS price_lag_row, b.price AS price_lag_time
FROM d a LEFT JOIN d b ON b.ts = a.ts - INTERVAL 1 DAY""")
def lag_by_time(spark, sf_dir):
    """Row lag next to the time lag (equi self-join on ts - 1 day)."""
    d = daily_system(spark, sf_dir).select("ts", "price")
    by_row = series.ordered(d, series.lags("price", [1], name="price_lag_row"), reach=1)
    prev = d.select((F.col("ts") + F.expr("INTERVAL 1 DAY")).alias("ts"), F.col("price").alias("price_lag_time"))
    return by_row.join(prev, "ts", "left")


@register("history_tail", S.with_h("SELECT ts, price FROM h QUALIFY row_number() OVER (ORDER BY ts DESC) <= 48"))
def history_tail(spark, sf_dir):
    """Last n rows of the history (TakeOrderedAndProject, n = 48)."""
    h = hourly_system(spark, sf_dir).select("ts", "price")
    return h.orderBy(F.desc("ts")).limit(48)


@register("time_axis", S.with_h("SELECT DISTINCT ts FROM pr"))
def time_axis(spark, sf_dir):
    """Distinct time axis; raises on empty input (isEmpty is a 1-row probe)."""
    from ..sources.tables import events, hour_floor
    axis = events(spark, sf_dir, ("ts",)).select(hour_floor("ts").alias("ts")).distinct()
    if axis.isEmpty():
        raise ValueError("empty time axis")
    return axis
