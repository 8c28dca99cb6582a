"""DuckDB SQL of least squares: elimination and sweeps on lists of lists."""

from __future__ import annotations

from .. import params as P
from . import sql as S


def eliminated(source: str, keys: str, k: int, name: str = "solved") -> str:
    """Recursive CTE ``name``: ``source`` has ``keys`` and ``m``, k rows of k + 1
    numbers; after k steps the last of each row is the solution."""
    return f"""
{name} AS (
  SELECT {keys}, 0 AS c, m FROM {source}
  UNION ALL
  SELECT {keys}, c + 1, list_transform(m, lambda r, i: list_transform(r, lambda v, j:
           CASE WHEN i = c + 1 THEN v / m[c + 1][c + 1] ELSE v - r[c + 1] * m[c + 1][j] / m[c + 1][c + 1] END))
  FROM {name} WHERE c < {k})"""


def walk_ctes(src: str, value: str, terms, later: str, origins: str, lags: int = 3, name: str = "wf", one_fit: bool = False) -> str:
    """``name``: ts, forecast, forecast_se of each row of ``src`` that ``origins``
    takes, by the fit of all rows up to it; with ``one_fit`` of every row, by the
    fit at the one origin.  ``terms(t)`` lists the known terms at time t;
    ``later`` is the time ``{k}`` steps on."""
    joined = f"CROSS JOIN (SELECT b, s2 FROM {name}_s) q" if one_fit else f"JOIN {name}_s USING (ts)"
    n_terms = len(terms("ts"))
    k = lags + n_terms
    back = [value] + [f"LAG({value}, {j}) OVER w" for j in range(1, lags + 2)]
    diffs = ", ".join(f"{a} - {b} AS d{j}" for j, (a, b) in enumerate(zip(back, back[1:])))
    xs = [f"d{j}" for j in range(1, lags + 1)] + [f"f{j}" for j in range(n_terms)] + ["d0"]
    whole = " AND ".join(f"{x} IS NOT NULL" for x in xs)
    sums = ", ".join(f"sum(CASE WHEN {whole} THEN {xs[i]} * {xs[j]} END) OVER w AS g{i}_{j}" for i in range(k + 1) for j in range(i, k + 1))
    at = lambda i, j: f"g{min(i, j)}_{max(i, j)}"
    matrix = "[" + ", ".join("[" + ", ".join(at(i, j) for j in range(k + 1)) + "]" for i in range(k)) + "]"
    beta = [f"b[{i + 1}]" for i in range(k)]
    ahead = lambda changes, j: " + ".join([f"{b} * {x}" for b, x in zip(beta, changes)]
                                          + [f"{b} * {t}" for b, t in zip(beta[lags:], terms("(" + later.format(k=j) + ")"))])
    return f"""
{name}_d AS (SELECT ts, {value}, {diffs} FROM {src} WINDOW w AS (ORDER BY ts)),
{name}_f AS (SELECT *, {", ".join(f"{t} AS f{j}" for j, t in enumerate(terms("ts")))} FROM {name}_d),
{name}_g AS (SELECT *, {sums}, count(CASE WHEN {whole} THEN 1 END) OVER w AS n FROM {name}_f WINDOW w AS (ORDER BY ts)),
{name}_m AS (SELECT ts, {matrix} AS m FROM {name}_g WHERE ({origins}) AND n > {2 * k}),
{eliminated(f"{name}_m", "ts", k, f"{name}_e")},
{name}_b AS (SELECT ts, list_transform(m, lambda r: r[{k + 1}]) AS b FROM {name}_e WHERE c = {k}),
{name}_s AS (SELECT ts, b, ({at(k, k)} - ({" + ".join(f"{beta[i]} * {at(i, k)}" for i in range(k))})) / (n - {k}) AS s2
             FROM {name}_g JOIN {name}_b USING (ts)),
{name}_1 AS (SELECT g.*, b, s2, {ahead([f"d{j}" for j in range(lags)], 1)} AS s1 FROM {name}_g g {joined}),
{name} AS (SELECT ts, {value} + s1 + ({ahead(["s1", *[f"d{j}" for j in range(lags - 1)]], 2)}) AS forecast,
             sqrt(s2 * ((1 + b[1]) * (1 + b[1]) + 1)) AS forecast_se FROM {name}_1)"""


def week_hour_terms(t: str) -> list[str]:
    hour = f"(CAST(hour({t}) AS DOUBLE) + CAST(minute({t}) AS DOUBLE) / 60.0)"
    how = f"CAST({S.weekday(t)} * 24 + hour({t}) AS DOUBLE)"
    day = [f"{f}(({m} * pi()) * {hour} / 24.0)" for m in (2, 4) for f in ("sin", "cos")]
    return day + [f"sin((2 * pi()) * {how} / 168.0)", f"cos((2 * pi()) * {how} / 168.0)"]


def year_day_terms(t: str) -> list[str]:
    day = f"CAST({S.weekday(t)} AS DOUBLE)"
    doy = f"(CAST(dayofyear({t}) AS DOUBLE) - CAST({S.leap(t)} AND month({t}) >= 3 AS INTEGER))"
    week = [f"sin((2 * pi()) * {day} / 7.0)", f"cos((2 * pi()) * {day} / 7.0)"]
    return week + [f"{f}((2 * pi()) * {doy} / {float(P.YEAR_PERIOD_DAYS)})" for f in ("sin", "cos")]


def upper_tail(forecast: str, se: str, threshold: float) -> str:
    from .prepare_q import _erf_sql

    z = f"(({threshold} - {forecast}) / GREATEST({se}, 1e-6))"
    return S.r6(f"0.5 * (1.0 - {_erf_sql(f'({z} / sqrt(2.0))')})")


HOURLY_WALK = walk_ctes("h", "price", week_hour_terms, "ts + INTERVAL {k} HOUR", f"ts >= TIMESTAMP '{P.HOURLY_SPLITS[0]}'")
TRAIN_FIT = walk_ctes("h", "price", week_hour_terms, "ts + INTERVAL {k} HOUR",
                      f"ts = (SELECT max(ts) FROM h WHERE ts < TIMESTAMP '{P.HOURLY_SPLITS[0]}')", one_fit=True)
DAILY_WALK = walk_ctes("d", "price", year_day_terms, "ts + INTERVAL {k} DAY", f"ts >= TIMESTAMP '{P.DAILY_SPLITS[0]}'")


# --- the price equation: stationarity, screening, least squares -------------------------------

#: columns of the engineered table that the role rules call continuous, in its order
CONTINUOUS = ("price", "load", *[f"{f}_total" for f in P.FUELS], *[f"{f}_cap" for f in P.FUELS], "imp", "exp", "net_export", "total_generation",
              "total_capability", "dispatchable_generation", "dispatchable_capability", "renewable_generation", "renewable_capability",
              *[f"{f}_mix" for f in P.FUELS], "renewables_share", "dispatchable_ratio", "gas_ratio", "intertie_support", "capacity_renewable",
              "capacity_dispatchable", "capacity_gas", "net_load", "resilience_buffer", "reserve_margin", "net_load_3h_change",
              *[f"price_lag_{k}h" for k in P.PRICE_LAGS], "price_rolling_mean_6h", "hour_of_day", "day_of_week", "month", "year")
SPANNED, MOST_LAGS = 1e-8, 12


def _equation_ctes() -> tuple[str, tuple[str, ...]]:
    """fr: complete rows with ``x`` (candidates), ``z`` (terms always in) and the target ``y``."""
    from .models_q import ALWAYS, CHANGES

    xs = (*CONTINUOUS, *[f"{c}_change_{k}h" for c, k in CHANGES])
    diffs = ", ".join(f"{c} - LAG({c}, {k}) OVER w AS {c}_change_{k}h" for c, k in CHANGES)
    full = " AND ".join(f"{c} IS NOT NULL" for c in (*xs, *ALWAYS, "price_lead_2"))
    as_list = lambda cols: "[" + ", ".join(f"CAST({c} AS DOUBLE)" for c in cols) + "]"
    return f"""{S.h_ctes()}, {S.wide_ctes()},
ch AS (SELECT *, {diffs}, LEAD(price, {P.HORIZON}) OVER w AS price_lead_2 FROM wt WINDOW w AS (ORDER BY ts)),
fr AS (SELECT ts, price, price_lead_2, price_lead_2 - price AS y, {as_list(xs)} AS x, {as_list(ALWAYS)} AS z, {S.split_case()} AS split FROM ch WHERE {full}),
tr AS (SELECT *, row_number() OVER (ORDER BY ts) AS r FROM fr WHERE split = 'train'),
names AS (SELECT unnest({list(xs)}) AS name, unnest(range(1, {len(xs) + 1})) AS i),
lo AS (SELECT i, r, x[i] AS v FROM tr, names UNION ALL SELECT 0, r, y FROM tr),
la AS (SELECT *, LAG(v) OVER w AS l1, LAG(v) OVER w - LAG(v, 2) OVER w AS d1, v - avg(v) OVER (PARTITION BY i) AS e,
         count(*) OVER (PARTITION BY i) AS n FROM lo WINDOW w AS (PARTITION BY i ORDER BY r)),
lb AS (SELECT *, v - l1 AS dy, sum(e) OVER (PARTITION BY i ORDER BY r) AS cum, {", ".join(f"LAG(e, {k}) OVER w AS e{k}" for k in range(1, MOST_LAGS + 1))}
       FROM la WINDOW w AS (PARTITION BY i ORDER BY r)),
ad AS (SELECT i, count(*) AS m, var_pop(l1) AS s11, covar_pop(l1, d1) AS s12, var_pop(d1) AS s22, covar_pop(l1, dy) AS s1y, covar_pop(d1, dy) AS s2y,
         var_pop(dy) AS syy FROM lb WHERE d1 IS NOT NULL GROUP BY i),
ae AS (SELECT *, s11 * s22 - s12 * s12 AS det FROM ad),
af AS (SELECT i, CASE WHEN det > 1e-10 * s11 * s22 THEN (s22 * s1y - s12 * s2y) / det
             / sqrt((syy - (s22 * s1y - s12 * s2y) / det * s1y - (s11 * s2y - s12 * s1y) / det * s2y) / (m - 3) * s22 / det) END AS adf FROM ae),
kp AS (SELECT i, any_value(n) AS n, CAST(floor(4 * pow(any_value(n) / 100.0, 0.25)) AS INTEGER) AS l, sum(cum * cum) AS ss, sum(e * e) AS g0,
         {", ".join(f"coalesce(sum(e * e{k}), 0) AS g{k}" for k in range(1, MOST_LAGS + 1))} FROM lb GROUP BY i),
kq AS (SELECT *, (g0 {" ".join(f"+ CASE WHEN l >= {k} THEN 2 * (1 - {k} / (l + 1.0)) * g{k} ELSE 0 END" for k in range(1, MOST_LAGS + 1))}) / n AS lrv FROM kp),
st AS (SELECT kq.i, adf, l, n, CASE WHEN lrv > 0 THEN ss / (CAST(n AS DOUBLE) * n * lrv) END AS kpss,
         coalesce(adf < {P.ADF_CRITICAL_5PCT}, false) AS a_ok, coalesce(ss / (CAST(n AS DOUBLE) * n * nullif(lrv, 0)) < {P.KPSS_CRITICAL_5PCT}, false) AS k_ok
       FROM kq LEFT JOIN af ON kq.i = af.i)""", xs


def stationarity_sql() -> str:
    ctes, _ = _equation_ctes()
    return f"""WITH {ctes}
SELECT coalesce(name, 'target_change_2h') AS series, {S.r6('adf')} AS adf_stat, a_ok AS adf_stationary, {S.r6('kpss')} AS kpss_stat, k_ok AS kpss_stationary,
       a_ok AND k_ok AS stationary, 1 AS lags_adf, l AS lags_kpss, n AS rows FROM st LEFT JOIN names ON st.i = names.i"""


def _screen_ctes() -> str:
    """sw: sweeps that bring the stationary columns in, then take the worst out."""
    ctes, xs = _equation_ctes()
    p = len(xs)
    swept = """list_transform(a, lambda r, i: list_transform(r, lambda v, j: CASE WHEN i = k AND j = k THEN 1 / a[k][k] WHEN i = k THEN v / a[k][k]
                 WHEN j = k THEN -v / a[k][k] ELSE v - r[k] * a[k][j] / a[k][k] END))"""
    return f"""{ctes},
ok AS (SELECT list(a_ok AND k_ok ORDER BY i) AS ok FROM st WHERE i > 0),
xx AS (SELECT a.i, b.i AS j, sum(x[a.i] * x[b.i]) AS g FROM tr, names a, names b GROUP BY ALL),
di AS (SELECT i, sqrt(g) AS s FROM xx WHERE i = j),
ro AS (SELECT xx.i, list(g / (CASE WHEN a.s > 0 THEN a.s ELSE 1 END * CASE WHEN b.s > 0 THEN b.s ELSE 1 END) ORDER BY j) AS r
       FROM xx JOIN di a ON a.i = xx.i JOIN di b ON b.i = xx.j GROUP BY xx.i),
sw AS (
  SELECT 0 AS it, list(r ORDER BY i) AS a, CAST([] AS BIGINT[]) AS inside, (SELECT ok FROM ok) AS ok FROM ro
  UNION ALL
  SELECT it + 1, CASE WHEN k IS NULL THEN a ELSE {swept} END,
         CASE WHEN it >= {p} THEN list_filter(inside, lambda v: v <> k) WHEN k IS NULL THEN inside ELSE list_append(inside, k) END, ok
  FROM (SELECT *, CASE WHEN it < {p} THEN CASE WHEN ok[it + 1] AND a[it + 1][it + 1] > {SPANNED} THEN it + 1 END
                       ELSE inside[list_position(vifs, list_max(vifs))] END AS k
        FROM (SELECT *, list_transform(inside, lambda v: a[v][v]) AS vifs FROM sw))
  WHERE it < {p} OR (list_max(vifs) > {P.VIF_LIMIT} AND len(inside) > {P.VIF_MIN_FEATURES}))"""


def vif_sql() -> str:
    _, xs = _equation_ctes()
    p = len(xs)
    return f"""WITH RECURSIVE {_screen_ctes()}
SELECT step, name AS feature, round(vif, 3) AS vif FROM (
  SELECT CAST(it - {p} AS INTEGER) AS step, i, a[i][i] AS vif FROM (SELECT it, a, unnest(inside) AS i FROM sw WHERE it >= {p})
  UNION ALL SELECT 0, i, NULL FROM sw, names WHERE it = {p} AND ok[i] AND NOT list_contains(inside, i)) JOIN names USING (i)"""


def _ols_ctes() -> str:
    """ft: beta (list), means and the fitted intercept; v are candidates, terms and target in one list."""
    from .models_q import ALWAYS

    _, xs = _equation_ctes()
    p, q = len(xs), len(ALWAYS)
    y = p + q + 1
    return f"""{_screen_ctes()},
kept AS (SELECT inside || {list(range(p + 1, p + q + 1))} AS f FROM sw ORDER BY it DESC LIMIT 1),
tv AS (SELECT r, x || z || [y] AS v FROM tr),
ix AS (SELECT unnest(f || [{y}]) AS i FROM kept),
cm AS (SELECT a.i, b.i AS j, count(*) * covar_pop(v[a.i], v[b.i]) AS g FROM tv, ix a, ix b GROUP BY ALL),
mu AS (SELECT i, avg(v[i]) AS m, count(*) AS n FROM tv, ix GROUP BY i),
ma AS (SELECT 1 AS one, list(r ORDER BY i) AS m FROM (SELECT i, list(g ORDER BY j) AS r FROM cm WHERE i < {y} GROUP BY i)),
{eliminated("ma", "one", "(SELECT len(f) FROM kept)", "so")},
be AS (SELECT list_transform(m, lambda r: r[len(r)]) AS b FROM so ORDER BY c DESC LIMIT 1),
ft AS (SELECT b, list_sort(f) AS f, (SELECT m FROM mu WHERE i = {y}) - list_sum(list_transform(list_zip(b, (SELECT list(m ORDER BY i) FROM mu WHERE i < {y})),
         lambda t: t[1] * t[2])) AS b0 FROM be, kept)"""


def ols_sql() -> str:
    from .evaluate_q import _counts_sql

    def r0(a, b):
        return S.r6(f"COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)")
    t = P.SPIKE_THRESHOLD
    return f"""WITH RECURSIVE {_ols_ctes()},
pd AS (SELECT split, price_lead_2 AS a, price + b0 + list_sum(list_transform(list_zip(b, f), lambda t: t[1] * (x || z)[t[2]])) AS f FROM fr, ft)
SELECT split, rows, rmse, mae, {r0('2 * tp', '2 * tp + fp + fn')} AS spike_f1, {r0('tp', 'tp + fp')} AS spike_precision,
       {r0('tp', 'tp + fn')} AS spike_recall, {r0('tp + fp', 'tp + fp + fn + tn')} AS predicted_spike_rate
FROM (SELECT split, count(*) AS rows, {S.r6('sqrt(avg((a - f) * (a - f)))')} AS rmse, {S.r6('avg(abs(a - f))')} AS mae,
             {_counts_sql(f'f > {t}', f'CAST(a > {t} AS INTEGER)')} FROM pd GROUP BY split)"""


def coefficients_sql() -> str:
    """Standard errors from the inverse: each unit vector is eliminated beside the target."""
    from .models_q import ALWAYS

    ctes, (_, xs) = _ols_ctes(), _equation_ctes()
    y = len(xs) + len(ALWAYS) + 1
    return f"""WITH RECURSIVE {ctes},
un AS (SELECT i AS e, list(r ORDER BY k) AS m FROM (
         SELECT u.i, cm.i AS k, list(g ORDER BY j) FILTER (j < {y}) || [CASE WHEN cm.i = u.i THEN 1.0 ELSE 0.0 END] AS r
         FROM cm, ix u WHERE cm.i < {y} AND u.i < {y} GROUP BY u.i, cm.i) GROUP BY i),
{eliminated("un", "e", "(SELECT len(f) FROM kept)", "iv")},
inv AS (SELECT e, list_transform(m, lambda r: r[len(r)]) AS c FROM iv WHERE c = (SELECT len(f) FROM kept)),
s2 AS (SELECT ((SELECT g FROM cm WHERE i = {y} AND j = {y}) - list_sum(list_transform(list_zip(b, (SELECT list(g ORDER BY i) FROM cm WHERE j = {y} AND i < {y})),
         lambda t: t[1] * t[2]))) / ((SELECT max(n) FROM mu) - len(f) - 1) AS s2 FROM ft),
mm AS (SELECT list(m ORDER BY i) AS m FROM mu WHERE i < {y}),
q0 AS (SELECT sum((SELECT m FROM mu WHERE i = e) * list_sum(list_transform(list_zip(c, (SELECT m FROM mm)), lambda t: t[1] * t[2]))) AS q FROM inv),
al AS (SELECT {list(xs) + list(ALWAYS)} AS nm)
SELECT nm[e] AS term, round(b[list_position(f, e)], 5) + 0.0 AS coefficient, round(sqrt(c[list_position(f, e)] * s2), 5) AS std_error FROM inv, ft, s2, al
UNION ALL SELECT 'intercept', round(b0, 5) + 0.0, round(sqrt(s2 / (SELECT max(n) FROM mu) + s2 * q), 5) FROM ft, s2, q0"""


def train_forecast_sql() -> str:
    return f"""WITH RECURSIVE {S.h_ctes()}, {TRAIN_FIT},
l AS (SELECT ts, LEAD(price, {P.HORIZON}) OVER (ORDER BY ts) AS price_lead_2 FROM h)
SELECT ts, {S.split_case()} AS split, price_lead_2, {S.r6('forecast')} AS forecast, {S.r6('forecast_se')} AS forecast_se,
       {upper_tail('forecast', 'forecast_se', P.SPIKE_THRESHOLD)} AS spike_prob
FROM wf JOIN l USING (ts) WHERE ts >= TIMESTAMP '{P.HOURLY_SPLITS[0]}'"""
