"""Queries: integration of the hourly sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .. import params as P
from ..functions.columns import r6
from ..operators import series, system
from ..session import scratch_path
from ..sources import files, tables
from . import sql as S
from .inputs import hourly_system
from .registry import register

# --- flagship ---------------------------------------------------------------------------

FLAGSHIP_SQL = S.with_h(f"""
SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day,
       (round(avg(spike_lead_2), 6) + 0.0) AS spike_rate,
       count(spike_lead_2) AS hours
FROM l GROUP BY 1""", extra=f"""
f AS (SELECT ts, CAST(price > {P.SPIKE_THRESHOLD} AS INTEGER) AS spike FROM h),
l AS (SELECT ts, LEAD(spike, {P.HORIZON}) OVER (ORDER BY ts) AS spike_lead_2 FROM f)""")


@register("spike_rate_by_hour", FLAGSHIP_SQL, headline=True)
def spike_rate_by_hour(spark, sf_dir):
    """Flagship: spike rate two hours ahead by hour of day."""
    h = hourly_system(spark, sf_dir).select("ts", "price")
    h = h.withColumn("spike", (F.col("price") > P.SPIKE_THRESHOLD).cast("int"))
    h = series.ordered(h, series.leads("spike", [P.HORIZON], name="spike_lead_2"), reach=P.HORIZON)
    return (h.groupBy(F.hour("ts").alias("hour_of_day"))
             .agg(r6(F.avg("spike_lead_2")).alias("spike_rate"), F.count("spike_lead_2").alias("hours")))


# --- sources -------------------------------------------------------------------------------

def _stand_in(spark, name: str) -> str:
    return scratch_path(spark, f"csv-{name}-{uuid.uuid4().hex[:12]}")


def _generation_files(spark, sf_dir) -> str:
    """The readings as CSV files in one folder a day; returns a glob."""
    path = _stand_in(spark, "generation")
    g = tables.generation_long(spark, sf_dir)
    files.write_csv(g.withColumn("file_day", F.to_date("ts")), path, by=["file_day"])
    return path + "/file_day=*/*.csv"


@register("src_generation_scan", S.with_h("""
SELECT event_type AS fuel_type, count(*) AS readings, (round(sum(value), 6) + 0.0) AS volume
FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup', 'error') GROUP BY 1"""))
def src_generation_scan(spark, sf_dir):
    """Glob over the CSV files of all days, blanks as NULL."""
    g = files.read_generation(spark, _generation_files(spark, sf_dir))
    return g.groupBy("fuel_type").agg(F.count(F.lit(1)).alias("readings"), r6(F.sum("volume")).alias("volume"))


@register("src_price_scan", S.with_h("SELECT ts, price, load, imp, exp FROM pr"))
def src_price_scan(spark, sf_dir):
    """Column list and time column of a wide CSV table."""
    path = _stand_in(spark, "price")
    files.write_csv(tables.price_wide(spark, sf_dir).select(F.col("ts").alias("begin"), "load", "imp", "price", "exp", F.lit(1).alias("unused")), path)
    schema = "begin TIMESTAMP_NTZ, load DOUBLE, imp DOUBLE, price DOUBLE, exp DOUBLE, unused INT"
    return files.read_price(spark, path, schema, ["price", "load", "imp", "exp"], ts_col="begin")


@register("load_hourly", S.with_h(f"SELECT ts, price, load, {S.fuel_cols()}, imp, exp FROM h ORDER BY ts"))
def load_hourly(spark, sf_dir):
    """The stored hourly table, read back with its required columns in time order."""
    path = _stand_in(spark, "hourly")
    h = hourly_system(spark, sf_dir, materialized=False).select("ts", *P.BASE_COLUMNS)
    files.write_csv(h, path)
    schema = ", ".join(["ts TIMESTAMP_NTZ", *[f"{c} DOUBLE" for c in P.BASE_COLUMNS]])
    return files.load_hourly(spark, path, schema, P.BASE_COLUMNS)


@register("hourly_by_type", S.with_h("SELECT ts, event_type AS fuel_type, volume, capability FROM g"))
def hourly_by_type(spark, sf_dir):
    return system.hourly_by_type(tables.generation_long(spark, sf_dir))


@register("type_filter", """
SELECT event_type AS fuel_type, count(*) AS readings FROM events
WHERE event_type IN ('click', 'view', 'purchase', 'signup', 'error') GROUP BY 1""")
def type_filter(spark, sf_dir):
    return tables.generation_long(spark, sf_dir).groupBy("fuel_type").agg(F.count(F.lit(1)).alias("readings"))


@register("pivot_two_measures", S.with_h(f"SELECT ts, {S.fuel_cols()} FROM gw"))
def pivot_two_measures(spark, sf_dir):
    return system.pivot_fuels(system.hourly_by_type(tables.generation_long(spark, sf_dir)))


@register("pivot_dense", S.with_h(f"""
SELECT count(*) AS hours,
  {", ".join(f"CAST(sum(CASE WHEN {f}_total = 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_{f}" for f in P.FUELS)}
FROM gw"""))
def pivot_dense(spark, sf_dir):
    """Zero-filled cells per fuel after the dense pivot."""
    g = system.pivot_fuels(system.hourly_by_type(tables.generation_long(spark, sf_dir)))
    return g.agg(F.count(F.lit(1)).alias("hours"),
                 *[F.sum((F.col(f"{f}_total") == 0).cast("long")).alias(f"zero_{f}") for f in P.FUELS])


@register("dead_band", S.with_h("""
SELECT ts, solar_total, (round(volume, 6) + 0.0) AS raw_volume FROM gw
JOIN (SELECT ts, volume FROM g WHERE event_type = 'purchase') r USING (ts)"""))
def dead_band(spark, sf_dir):
    """Solar volume after clip-at-0 and the 0.5 dead band, next to the raw value."""
    by_type = system.hourly_by_type(tables.generation_long(spark, sf_dir))
    g = system.pivot_fuels(by_type)
    raw = by_type.filter(F.col("fuel_type") == "purchase").select("ts", r6("volume").alias("raw_volume"))
    return g.select("ts", "solar_total").join(raw, "ts")


@register("merge_hourly", S.with_h(f"SELECT ts, price, load, {S.fuel_cols()}, imp, exp FROM h"), headline=True)
def merge_hourly(spark, sf_dir):
    """J01 + J02: the price table joined with the pivoted generation on the hour."""
    gen = system.pivot_fuels(system.hourly_by_type(tables.generation_long(spark, sf_dir)))
    return system.merge_hourly(tables.price_wide(spark, sf_dir), gen)


@register("src_file_counts", S.with_h("""
SELECT CAST(date_trunc('day', ts) AS DATE) AS file_day, count(*) AS rows_in_file
FROM events WHERE event_type IN ('click', 'view', 'purchase', 'signup', 'error') GROUP BY 1"""))
def src_file_counts(spark, sf_dir):
    """Rows of each input file, added up by the folder that the files stand in."""
    counts = files.file_counts(files.read_generation(spark, _generation_files(spark, sf_dir)))
    day = F.regexp_extract("file", "file_day=([0-9-]+)/", 1).cast("date").alias("file_day")
    return counts.groupBy(day).agg(F.sum("rows_in_file").alias("rows_in_file"))


@register("clock_shift", f"""
SELECT event_id, ts - INTERVAL {abs(P.CLOCK_SHIFT_HOURS)} HOUR AS market_ts,
       CAST(date_trunc('hour', ts - INTERVAL {abs(P.CLOCK_SHIFT_HOURS)} HOUR) AS TIMESTAMP) AS market_hour
FROM events""")
def clock_shift(spark, sf_dir):
    """Constant-offset clock shift (UTC -> market time, no DST)."""
    ev = tables.read_table(spark, sf_dir, "events", ["event_id", "ts"])
    shifted = F.col("ts") + F.make_dt_interval(hours=F.lit(P.CLOCK_SHIFT_HOURS))
    return ev.select("event_id", shifted.alias("market_ts"), tables.hour_floor(shifted).alias("market_hour"))
