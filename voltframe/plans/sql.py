"""DuckDB oracle building blocks (ANSI SQL over the pre-registered views).

Each oracle re-derives its inputs from the raw tables, independently of the
Spark code, so the driver's side-by-side check compares two implementations.
"""

from __future__ import annotations

from .. import params as P


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fuel_cols(prefix: str = "") -> str:
    return ", ".join(f"{prefix}{f}_total" for f in P.FUELS) + ", " + ", ".join(f"{prefix}{f}_cap" for f in P.FUELS)


def h_ctes() -> str:
    """CTEs g (hour x type), gw (pivot), pr (price table) and h (merged)."""
    types = ", ".join(_q(t) for t in P.FUEL_MAP)
    vol, cap = [], []
    for t, f in P.FUEL_MAP.items():
        v = f"COALESCE(SUM(volume) FILTER (WHERE event_type = {_q(t)}), 0.0)"
        if f == "solar":
            v = f"CASE WHEN GREATEST({v}, 0.0) < {P.SOLAR_DEAD_BAND} THEN 0.0 ELSE GREATEST({v}, 0.0) END"
        vol.append(f"{v} AS {f}_total")
        cap.append(f"COALESCE(SUM(capability) FILTER (WHERE event_type = {_q(t)}), 0.0) AS {f}_cap")
    return f"""
g AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, event_type,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS volume,
         CAST(COUNT(DISTINCT user_id) * 100 AS DOUBLE) AS capability
  FROM events WHERE event_type IN ({types})
  GROUP BY 1, 2),
gw AS (
  SELECT ts, {", ".join(vol)}, {", ".join(cap)}
  FROM g GROUP BY ts),
pr AS (
  SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, MAX(value) AS price,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS load,
         CAST(COALESCE(SUM(CAST(value AS DECIMAL(18,2))) FILTER (WHERE user_id % 10 = 0), 0) AS DOUBLE) AS imp,
         CAST(COALESCE(SUM(CAST(value AS DECIMAL(18,2))) FILTER (WHERE user_id % 10 = 1), 0) AS DOUBLE) AS exp
  FROM events GROUP BY 1),
h AS (
  SELECT pr.ts, price, load, {fuel_cols("gw.")}, imp, exp
  FROM pr JOIN gw ON pr.ts = gw.ts)"""


def r6(expr: str) -> str:
    """round to 6 places; + 0.0 turns DuckDB's -0.0 into 0.0 like Spark's round."""
    return f"(round({expr}, 6) + 0.0)"


def _sum(cols) -> str:
    return "(" + " + ".join(cols) + ")"


def sys_cte(src: str = "h", name: str = "s") -> str:
    """System features (P10-P14) on top of ``src``."""
    fuels = P.FUELS
    tot_gen = _sum([f"{f}_total" for f in fuels])
    tot_cap = _sum([f"{f}_cap" for f in fuels])
    disp_gen = _sum([f"{f}_total" for f in P.DISPATCHABLE] + ["imp"])
    disp_cap = _sum([f"{f}_cap" for f in P.DISPATCHABLE])
    ren_gen = _sum([f"{f}_total" for f in P.RENEWABLE])
    ren_cap = _sum([f"{f}_cap" for f in P.RENEWABLE])
    mix = ", ".join(f"{f}_total / NULLIF({tot_gen}, 0) AS {f}_mix" for f in fuels)
    return f"""
{name} AS (
  SELECT *,
    exp - imp AS net_export,
    {tot_gen} AS total_generation,
    {tot_cap} AS total_capability,
    {disp_gen} AS dispatchable_generation,
    {disp_cap} AS dispatchable_capability,
    {ren_gen} AS renewable_generation,
    {ren_cap} AS renewable_capability,
    {mix},
    {ren_gen} / NULLIF(load, 0) AS renewables_share,
    {disp_gen} / NULLIF(load, 0) AS dispatchable_ratio,
    gas_total / NULLIF(load, 0) AS gas_ratio,
    imp / NULLIF(load, 0) AS intertie_support,
    {ren_gen} / NULLIF({tot_cap}, 0) AS capacity_renewable,
    {disp_gen} / NULLIF({tot_cap}, 0) AS capacity_dispatchable,
    gas_total / NULLIF(gas_cap, 0) AS capacity_gas,
    load - {ren_gen} AS net_load,
    {tot_cap} - load AS resilience_buffer,
    ({tot_cap} - load) / NULLIF(load, 0) AS reserve_margin
  FROM {src})"""


def with_h(body: str, extra: str = "") -> str:
    ctes = h_ctes()
    if extra:
        ctes += "," + extra
    return f"WITH {ctes}\n{body}"


def split_case(ts: str = "ts", bounds=P.HOURLY_SPLITS) -> str:
    b1, b2 = bounds
    return (f"CASE WHEN {ts} < TIMESTAMP '{b1}' THEN 'train' "
            f"WHEN {ts} < TIMESTAMP '{b2}' THEN 'validation' ELSE 'test' END")


def weekday(ts: str = "ts") -> str:
    return f"CAST(isodow({ts}) - 1 AS INTEGER)"


def leap(ts: str = "ts") -> str:
    y = f"year({ts})"
    return f"(({y} % 4 = 0 AND {y} % 100 <> 0) OR {y} % 400 = 0)"


def grid_value(i: str, grid) -> str:
    start, stop, n = grid
    step = (stop - start) / (n - 1)
    return (f"(CASE WHEN {i} = {n - 1} THEN CAST({stop!r} AS DOUBLE) "
            f"ELSE CAST({i} AS DOUBLE) * CAST({step!r} AS DOUBLE) + CAST({start!r} AS DOUBLE) END)")


def pred_ctes() -> str:
    """p: long predictions (model, ts, split, price, y_true, y_prob) from h."""
    return f"""
hs AS (SELECT ts, price, load, CAST(price > {P.SPIKE_THRESHOLD} AS INTEGER) AS spike FROM h),
hl AS (SELECT *, LEAD(spike, {P.HORIZON}) OVER (ORDER BY ts) AS y_true FROM hs),
hp AS (SELECT *, {split_case()} AS split FROM hl WHERE y_true IS NOT NULL),
p AS (
  SELECT 'load_ratio' AS model, ts, split, price, CAST(y_true AS INTEGER) AS y_true,
         CAST(round(load / (load + {P.PROB_SCALE}), 2) AS DOUBLE) AS y_prob FROM hp
  UNION ALL
  SELECT 'naive' AS model, ts, split, price, CAST(y_true AS INTEGER) AS y_true,
         CAST(spike AS DOUBLE) AS y_prob FROM hp)"""


def d_ctes() -> str:
    """d: daily table from orders."""
    types = ", ".join(
        f"CAST(COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (WHERE o_orderpriority = {_q(p)}), 0) AS DOUBLE) AS type{i}_total"
        for i, p in enumerate(P.PRIORITIES, start=1))
    return f"""
d AS (
  SELECT CAST(o_orderdate AS TIMESTAMP) AS ts, MAX(o_totalprice) AS price,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS load, {types}
  FROM orders GROUP BY 1)"""


def window_ctes(src: str = "s") -> str:
    """sp (spike flag) and wl (all row-position window features) over ``src``."""
    n = P.LEAD_LAG_HOURS
    leads = ", ".join(f"LEAD(spike, {k}) OVER w AS spike_lead_{k}" for k in range(1, n + 1))
    lags = ", ".join(f"LAG(spike, {k}) OVER w AS spike_lag_{k}" for k in range(1, n + 1))
    plags = ", ".join(f"LAG(price, {k}) OVER w AS price_lag_{k}h" for k in P.PRICE_LAGS)
    m = P.ROLLING_WINDOW
    frame = f"(w ROWS BETWEEN {m} PRECEDING AND 1 PRECEDING)"
    return f"""
sp AS (SELECT *, CAST(price > {P.SPIKE_THRESHOLD} AS INTEGER) AS spike FROM {src}),
wl AS (
  SELECT *, {leads}, {lags},
    net_load - LAG(net_load, {P.NET_LOAD_DIFF}) OVER w AS net_load_3h_change,
    {plags},
    CASE WHEN count(price) OVER {frame} = {m} THEN avg(price) OVER {frame} END AS price_rolling_mean_6h
  FROM sp WINDOW w AS (ORDER BY ts))"""


def calendar_sql(ts: str = "ts") -> str:
    return (f"CAST(hour({ts}) AS INTEGER) AS hour_of_day, {weekday(ts)} AS day_of_week, "
            f"CAST(month({ts}) AS INTEGER) AS month, CAST(year({ts}) AS INTEGER) AS year, "
            f"CAST({weekday(ts)} >= 5 AS INTEGER) AS is_weekend")


def fourier_sql(ts: str = "ts", leap_adjust: bool = True) -> str:
    doy = f"CAST(dayofyear({ts}) AS DOUBLE)"
    if leap_adjust:
        doy = f"({doy} - CAST({leap(ts)} AND month({ts}) >= 3 AS INTEGER))"
    h = f"CAST(hour({ts}) AS DOUBLE)"
    d = f"CAST({weekday(ts)} AS DOUBLE)"
    two_pi = "(2 * pi())"
    parts = [f"sin({two_pi} * {h} / 24.0) AS sin_day", f"cos({two_pi} * {h} / 24.0) AS cos_day",
             f"sin({two_pi} * {d} / 7.0) AS sin_week", f"cos({two_pi} * {d} / 7.0) AS cos_week"]
    for k in (1, 2):
        parts.append(f"sin((2 * pi() * {k}) * {doy} / {float(P.YEAR_PERIOD_DAYS)}) AS sin_year_{k}")
        parts.append(f"cos((2 * pi() * {k}) * {doy} / {float(P.YEAR_PERIOD_DAYS)}) AS cos_year_{k}")
    return ", ".join(parts)


def event_sql(ranges=P.HOURLY_EVENT_RANGES, ts: str = "ts") -> str:
    conds = " OR ".join(f"({ts} >= TIMESTAMP '{s} 00:00:00' AND {ts} <= TIMESTAMP '{e} 00:00:00')" for s, e in ranges)
    return f"CAST(({conds}) AS INTEGER) AS is_event"


def wide_ctes() -> str:
    """wt: the engineered wide hourly table (after leap drop and edge trim)."""
    n = P.LEAD_LAG_HOURS
    return (sys_cte("h", "s") + "," + window_ctes("s") + f""",
wc AS (SELECT *, {calendar_sql()} FROM wl WHERE NOT (month(ts) = 2 AND day(ts) = 29)),
wt AS (SELECT *, {fourier_sql()}, {event_sql()} FROM wc
       WHERE spike_lead_{n} IS NOT NULL AND spike_lag_{n} IS NOT NULL)""")
