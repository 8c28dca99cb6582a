"""Queries: forecast alignment, coverage, grid points, inventories, backfill,
dedupe, scalar function families, sinks (S06-S08, S10, J03, J05, J09, P29-P31,
A20, A30, U03, O05, M12)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions.columns import r6
from ..operators import align as A
from ..operators import evaluate as E
from ..session import scratch_path
from ..sources import tables
from . import sql as S
from .inputs import daily_system, hourly_system, predictions
from .evaluate_q import SELECT_SQL, _sweep_ctes
from .registry import register

PRED = S.pred_ctes()


def _tag(sf_dir: str) -> str:
    """Unique scratch name per run (scale factor + random suffix): concurrent runs never share a folder."""
    import uuid
    return os.path.basename(os.path.normpath(sf_dir)).replace(".", "_") + "_" + uuid.uuid4().hex[:10]


def _view_forecast(spark, sf_dir):
    ev = tables.events(spark, sf_dir, ("ts", "event_type", "value"))
    return (ev.filter(F.col("event_type") == "view").groupBy(tables.hour_floor("ts").alias("ts"))
              .agg(F.avg("value").alias("wind_speed_forecast")))


PROVENANCE = {"forecast_source": "events", "forecast_variable": "view", "forecast_statistic": "hourly_mean"}

VIEW_CTES = """
vf AS (SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, avg(value) AS wind_speed_forecast
       FROM events WHERE event_type = 'view' GROUP BY 1),
al AS (SELECT h.ts, vf.wind_speed_forecast FROM h LEFT JOIN vf ON h.ts = vf.ts)"""


@register("forecast_align", S.with_h(
    f"SELECT ts, {S.r6('wind_speed_forecast')} AS wind_speed_forecast, "
    + ", ".join(f"'{v}' AS {k}" for k, v in PROVENANCE.items()) + " FROM al", extra=VIEW_CTES))
def forecast_align(spark, sf_dir):
    """J03 + P29 + M12: hourly forecast left-joined onto the reference axis."""
    axis = hourly_system(spark, sf_dir).select("ts")
    out = A.align_to_axis(axis, _view_forecast(spark, sf_dir), "ts", PROVENANCE)
    return out.withColumn("wind_speed_forecast", r6("wind_speed_forecast"))


@register("coverage_summary", S.with_h("""
SELECT 'view_mean' AS dataset, min(ts) AS requested_start, max(ts) AS requested_end, count(*) AS rows_in_output,
       count(wind_speed_forecast) AS non_null_rows, min(ts) FILTER (WHERE wind_speed_forecast IS NOT NULL) AS available_start,
       max(ts) FILTER (WHERE wind_speed_forecast IS NOT NULL) AS available_end FROM al
UNION ALL
SELECT 'price', min(ts), max(ts), count(*), count(price), min(ts) FILTER (WHERE price IS NOT NULL),
       max(ts) FILTER (WHERE price IS NOT NULL) FROM h""", extra=VIEW_CTES))
def coverage_summary(spark, sf_dir):
    """Per-dataset coverage of the reference axis."""
    h = hourly_system(spark, sf_dir)
    al = A.align_to_axis(h.select("ts"), _view_forecast(spark, sf_dir), "ts")
    return A.coverage_rows(al, "view_mean", "wind_speed_forecast").unionByName(A.coverage_rows(h, "price", "price"))


# --- wind components on a lattice (stand-in for the gridded forecast) -----------------

TARGET_LAT, TARGET_LON = 50.6, -113.4


def _wind(spark, sf_dir):
    """u = value, v = value of event_id - 1: a halo window over the dense id
    (one shuffle, blocks of bounded size) instead of a self-join of the raw table;
    the id check keeps the exact ``event_id - 1`` meaning if ids have holes."""
    from ..operators import series
    ev = tables.read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "value"])

    def build(w):
        prev_ok = F.lag("event_id", 1).over(w) == F.col("event_id") - 1
        return {"v": F.when(prev_ok, F.lag("value", 1).over(w))}

    d = series.ordered(ev, build, order="event_id", reach=1, idx="event_id", block_rows=1 << 20)
    d = d.withColumnRenamed("value", "u")
    lat = F.lit(49.0) + (F.col("user_id") % 10).cast("double") * 0.25
    lon360 = F.lit(245.0) + F.floor(F.col("user_id") / 10).cast("double") * 0.25
    return d.select("event_id", F.to_date("ts").alias("run_date"), lat.alias("lat"),
                    A.wrap_longitude(lon360).alias("lon"), "u", "v")


WIND_CTES = """
wd AS (SELECT e.event_id, CAST(e.ts AS DATE) AS run_date, 49.0 + CAST(e.user_id % 10 AS DOUBLE) * 0.25 AS lat,
              CASE WHEN (245.0 + CAST(e.user_id // 10 AS DOUBLE) * 0.25) % 360.0 > 180.0
                   THEN (245.0 + CAST(e.user_id // 10 AS DOUBLE) * 0.25) % 360.0 - 360.0
                   ELSE (245.0 + CAST(e.user_id // 10 AS DOUBLE) * 0.25) % 360.0 END AS lon,
              e.value AS u, p.value AS v
       FROM events e LEFT JOIN events p ON p.event_id = e.event_id - 1)"""


@register("wind_speed", f"WITH {WIND_CTES} SELECT event_id, lat, lon, "
          f"{S.r6('sqrt(u * u + v * v) * 3.6')} AS speed_kmh FROM wd")
def wind_speed(spark, sf_dir):
    """P30 + P31: speed from u/v (km/h) at wrapped longitudes."""
    d = _wind(spark, sf_dir)
    return d.select("event_id", "lat", "lon", r6(A.wind_speed("u", "v")).alias("speed_kmh"))


@register("nearest_grid", f"""WITH {WIND_CTES}
SELECT run_date, {S.r6(f'sqrt(b.d2)')} AS distance_deg, b.lat AS lat, b.lon AS lon, b.u AS u, b.v AS v FROM (
  SELECT run_date, min({{'d2': (lat - {TARGET_LAT}) * (lat - {TARGET_LAT}) + (lon - ({TARGET_LON})) * (lon - ({TARGET_LON})),
                        'lat': lat, 'lon': lon, 'u': u, 'v': v}}) AS b FROM wd GROUP BY 1)""")
def nearest_grid(spark, sf_dir):
    """Nearest lattice point to a target coordinate per run date."""
    d = _wind(spark, sf_dir)
    out = A.nearest_point(d, ["run_date"], "lat", "lon", TARGET_LAT, TARGET_LON, extra=("u", "v"))
    return out.withColumn("distance_deg", r6("distance_deg"))


# --- byte-range inventory text files -------------------------------------------------

INVENTORY_VARS = ("click", "view")
INVENTORY_LEVEL = "0 m"


def write_inventories(spark, sf_dir) -> str:
    """One text file per day of readings: ``n:offset:d=yyyyMMdd:var:level m:``.

    Line numbers come from the two-level row index per day (blocks of event ids),
    so a day holding a third of all readings is still numbered in bounded tasks.
    """
    from ..operators import series
    ev = tables.read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "user_id"])
    ev = ev.withColumn("day", F.to_date("ts"))
    ev = series.add_row_index(ev, "event_id", keys=["day"], idx="n0", block_width=float(1 << 20))
    # every other number is missing: an end must come from the next line, not the next number
    lines = ev.withColumn("n", F.col("n0") * 2 + 1).select(
        "day", F.concat_ws(":", F.col("n").cast("string"), (F.col("n0") * 1000 + 1000).cast("string"),
                           F.concat(F.lit("d="), F.date_format("day", "yyyyMMdd")), F.col("event_type"),
                           F.concat((F.col("user_id") % 3).cast("string"), F.lit(" m")), F.lit("")).alias("value"))
    path = scratch_path(spark, f"inventory_{_tag(sf_dir)}")
    lines.write.mode("overwrite").partitionBy("day").text(path)
    return path


@register("inventory_ranges", f"""
WITH l AS (SELECT CAST(ts AS DATE) AS day, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS n,
                  event_type AS var, CAST(user_id % 3 AS VARCHAR) || ' m' AS level FROM events),
r AS (SELECT day, 2 * n - 1 AS n, strftime(day, '%Y%m%d') AS run, var, level, n * 1000 AS start,
             LEAD(n * 1000) OVER (PARTITION BY day ORDER BY n) - 1 AS "end" FROM l)
SELECT day, n, run, var, level, start, "end" FROM r
WHERE var IN ({", ".join(f"'{v}'" for v in INVENTORY_VARS)}) AND level = '{INVENTORY_LEVEL}'""")
def inventory_ranges(spark, sf_dir):
    """S10 + W12: parse inventory lines, end = next start - 1, keep two variables on one level."""
    path = write_inventories(spark, sf_dir)
    lines = spark.read.text(path)
    inv = A.parse_inventory(lines, "day")
    return inv.filter(F.col("var").isin(*INVENTORY_VARS) & (F.col("level") == INVENTORY_LEVEL)).select(
        "day", "n", "run", "var", "level", "start", "end")


# --- resumable backfill ---------------------------------------------------------------------

@register("backfill_resume", "WITH " + S.d_ctes() + """,
dd AS (SELECT CAST(ts AS DATE) AS date, price FROM d),
ex AS (SELECT date, price, 'existing' AS source FROM dd WHERE dayofyear(date) % 2 = 0),
rq AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM dd),
pe AS (SELECT date FROM rq WHERE date NOT IN (SELECT date FROM ex))
SELECT date, price, source FROM ex
UNION ALL SELECT pe.date, dd.price, 'backfilled' FROM pe LEFT JOIN dd ON pe.date = dd.date""")
def backfill_resume(spark, sf_dir):
    """Resume from earlier output: pending dates = requested
    anti-join existing, all of them computed, appended, deduplicated."""
    d = daily_system(spark, sf_dir).select(F.to_date("ts").alias("date"), "price")
    path = scratch_path(spark, f"backfill_{_tag(sf_dir)}")
    (d.filter(F.dayofyear("date") % 2 == 0).withColumn("source", F.lit("existing"))
      .write.mode("overwrite").parquet(path))
    existing = spark.read.parquet(path)
    bounds = d.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    requested = bounds.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date"))

    def compute(pending):
        return pending.join(d, "date", "left").withColumn("source", F.lit("backfilled"))

    return A.resume_backfill(requested, existing, "date", compute).select("date", "price", "source")


@register("dedupe_first", """
SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def dedupe_first(spark, sf_dir):
    """First order per customer in (date, key) order, skew-proof aggregate."""
    o = tables.read_table(spark, sf_dir, "orders", ["o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"])
    return A.dedupe_first(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_totalprice"])


# --- scalar function families -----------------------------------------------------------------

@register("scalar_calendar", f"""
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute,
  {S.weekday()} AS weekday, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
  CAST(year(ts) AS INTEGER) AS year, CAST(dayofyear(ts) AS INTEGER) AS day_of_year, {S.leap()} AS is_leap_year,
  CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_floor, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso,
  CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS epoch_s,
  make_timestamp(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) * 1000000) AS from_epoch,
  ts - INTERVAL 7 HOUR AS market_ts, CAST(ts AS DATE) + INTERVAL 1 DAY AS next_day
FROM events""")
def scalar_calendar(spark, sf_dir):
    """Date/time scalar family: parts, leap test, floor, format, epoch round trip, shifts."""
    from ..functions import calendar as cal
    ev = tables.read_table(spark, sf_dir, "events", ["event_id", "ts"])
    t = F.col("ts")
    epoch = F.unix_timestamp(t.cast("timestamp"))
    return ev.select("event_id", F.hour(t).alias("hour"), F.minute(t).alias("minute"), F.weekday(t).alias("weekday"),
                     F.month(t).alias("month"), F.dayofmonth(t).alias("day"), F.year(t).alias("year"),
                     F.dayofyear(t).alias("day_of_year"), cal.is_leap_year(t).alias("is_leap_year"),
                     tables.hour_floor(t).alias("hour_floor"),
                     F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss").alias("iso"), epoch.alias("epoch_s"),
                     F.timestamp_seconds(epoch).cast("timestamp_ntz").alias("from_epoch"),
                     (t - F.expr("INTERVAL 7 HOURS")).alias("market_ts"),
                     (F.to_date(t).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")).alias("next_day"))


@register("scalar_math", f"""
SELECT event_id, {S.r6('sin(value)')} AS sin_v, {S.r6('cos(value)')} AS cos_v,
  {S.r6('sqrt(value * value + CAST(user_id AS DOUBLE) * CAST(user_id AS DOUBLE))')} AS hypot_v,
  {S.r6('abs(value - 100.0)')} AS abs_v, {S.r6('sqrt(value)')} AS sqrt_v, {S.r6('exp(-value / 100.0)')} AS exp_v,
  CAST(((user_id * 7) % 360 + 360) % 360 AS BIGINT) AS pmod_v, CAST(floor(value) AS BIGINT) AS floor_v,
  CAST(ceil(value) AS BIGINT) AS ceil_v, {S.r6('GREATEST(value, 50.0)')} AS greatest_v,
  {S.r6('LEAST(value, 50.0)')} AS least_v, {S.r6('pi() * value')} AS pi_v
FROM events""")
def scalar_math(spark, sf_dir):
    """Math scalar family (all JVM-side built-ins)."""
    ev = tables.read_table(spark, sf_dir, "events", ["event_id", "user_id", "value"])
    v = F.col("value")
    return ev.select("event_id", r6(F.sin(v)).alias("sin_v"), r6(F.cos(v)).alias("cos_v"),
                     r6(F.hypot(v, F.col("user_id").cast("double"))).alias("hypot_v"),
                     r6(F.abs(v - 100.0)).alias("abs_v"), r6(F.sqrt(v)).alias("sqrt_v"),
                     r6(F.exp(-v / 100.0)).alias("exp_v"), F.pmod(F.col("user_id") * 7, F.lit(360)).cast("long").alias("pmod_v"),
                     F.floor(v).cast("long").alias("floor_v"), F.ceil(v).cast("long").alias("ceil_v"),
                     r6(F.greatest(v, F.lit(50.0))).alias("greatest_v"), r6(F.least(v, F.lit(50.0))).alias("least_v"),
                     r6(F.pi() * v).alias("pi_v"))


@register("scalar_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(to_json({'k': CAST(json_extract(props, '$.k') AS BIGINT), 'type': event_type}) AS VARCHAR) AS props_out
FROM events""")
def scalar_json(spark, sf_dir):
    """JSON family: path extraction, typed parse, struct back to JSON text."""
    ev = tables.read_table(spark, sf_dir, "events", ["event_id", "event_type", "props"])
    parsed = F.from_json("props", "k BIGINT")
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"),
                     F.to_json(F.struct(parsed["k"].alias("k"), F.col("event_type").alias("type"))).alias("props_out"))


@register("scalar_string", """
SELECT event_id, upper(event_type) AS upper_type, replace(event_type, 'i', 'I') AS replaced,
       starts_with(event_type, 'c') AS starts_c, trim(replace(string_split(props, ':')[2], '}', '')) AS k_text,
       concat_ws('|', event_type, CAST(user_id AS VARCHAR)) AS joined, printf('%s-%05d', event_type, user_id) AS formatted
FROM events""")
def scalar_string(spark, sf_dir):
    """String family: upper, replace, startswith, split + trim, concat_ws, format_string."""
    ev = tables.read_table(spark, sf_dir, "events", ["event_id", "event_type", "user_id", "props"])
    t = F.col("event_type")
    return ev.select("event_id", F.upper(t).alias("upper_type"), F.replace(t, F.lit("i"), F.lit("I")).alias("replaced"),
                     t.startswith("c").alias("starts_c"),
                     F.trim(F.replace(F.split("props", ":").getItem(1), F.lit("}"), F.lit(""))).alias("k_text"),
                     F.concat_ws("|", t, F.col("user_id").cast("string")).alias("joined"),
                     F.format_string("%s-%05d", t, F.col("user_id")).alias("formatted"))


# --- sinks ------------------------------------------------------------------------------------

H_SCHEMA = T.StructType([T.StructField("ts", T.TimestampNTZType())] +
                        [T.StructField(c, T.DoubleType()) for c in P.BASE_COLUMNS])


@register("sink_roundtrip", S.with_h(f"SELECT ts, price, load, {S.fuel_cols()}, imp, exp FROM h"))
def sink_roundtrip(spark, sf_dir):
    """S06 + S01: write the hourly table as day-partitioned Parquet and as CSV,
    read the CSV back with an explicit schema and a column list."""
    h = hourly_system(spark, sf_dir)
    base = scratch_path(spark, f"sink_{_tag(sf_dir)}")
    h.withColumn("day", F.to_date("ts")).write.mode("overwrite").partitionBy("day").parquet(base + "/parquet")
    h.write.mode("overwrite").option("header", True).csv(base + "/csv")
    back = (spark.read.schema(H_SCHEMA).option("header", True).option("mode", "FAILFAST")
                 .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").csv(base + "/csv"))
    return back.select("ts", *P.BASE_COLUMNS)


@register("metrics_json", S.with_h("SELECT model, threshold, f1, f2, precision, recall FROM sel",
                                   extra=PRED + "," + _sweep_ctes() + "," + SELECT_SQL))
def metrics_json(spark, sf_dir):
    """Metrics as nested structs written with write.json and read back."""
    p = predictions(spark, sf_dir).filter(F.col("split") == "validation")
    sel = E.threshold_select(E.threshold_sweep(p, ["model"], P.GRID_BASELINE), ["model"])
    doc = sel.select("model", F.struct("threshold", F.struct(*[r6(c).alias(c) for c in ("f1", "f2", "precision", "recall")])
                                       .alias("metrics")).alias("selection"))
    path = scratch_path(spark, f"metrics_{_tag(sf_dir)}")
    doc.write.mode("overwrite").json(path)
    schema = "model string, selection struct<threshold: double, metrics: struct<f1: double, f2: double, precision: double, recall: double>>"
    back = spark.read.schema(schema).json(path)
    return back.select("model", "selection.threshold", "selection.metrics.*")
