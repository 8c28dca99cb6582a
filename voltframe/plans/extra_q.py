"""Queries: written-back backfill (S08), interval join (J06), array functions (F-arr)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.columns import r6
from ..operators import backfill, intervals
from ..session import scratch_path
from ..sources import tables
from . import sql as S
from .inputs import daily_system, hourly_system
from .registry import register


@register("backfill_commit", "WITH " + S.d_ctes() + """,
dd AS (SELECT CAST(ts AS DATE) AS date, price FROM d),
rq AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM dd)
SELECT rq.date, price, CASE WHEN price IS NOT NULL AND dayofyear(rq.date) % 2 = 0 THEN 'existing' ELSE 'backfilled' END AS source,
       strftime(rq.date, '%Y-%m') AS part FROM rq LEFT JOIN dd ON rq.date = dd.date""")
def backfill_commit(spark, sf_dir):
    """A table of every second day is completed by two runs that write back the
    months they touch; the first is capped, the second goes on where it ended."""
    d = daily_system(spark, sf_dir).select(F.to_date("ts").alias("date"), "price")
    path = scratch_path(spark, f"backfill-{uuid.uuid4().hex[:12]}")
    month = F.date_format("date", "yyyy-MM")
    old = d.filter(F.dayofyear("date") % 2 == 0).withColumn("source", F.lit("existing"))
    backfill.write_parts(old.withColumn(backfill.PART, month), path)
    bounds = d.agg(F.min("date").alias("a"), F.max("date").alias("b"))
    requested = bounds.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("date"))

    def compute(pending):
        return pending.join(d, "date", "left").withColumn("source", F.lit("backfilled"))

    for most in (300, None):
        backfill.run_backfill(spark, path, old.schema, requested, "date", month, compute, max_new=most)
    return spark.read.parquet(path).select("date", "price", "source", F.col(backfill.PART).cast("string").alias("part"))


@register("interval_join", """
WITH i AS (SELECT event_id AS interval_id, ts AS start, ts + to_microseconds(CAST(round(value * CASE WHEN user_id % 50 = 0 THEN 86400 ELSE 60 END) AS BIGINT) * 1000000) AS stop
           FROM events WHERE event_type = 'error' AND value IS NOT NULL),
 p AS (SELECT ts, value FROM events WHERE event_type = 'purchase')
SELECT interval_id, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM i JOIN p ON p.ts >= i.start AND p.ts < i.stop GROUP BY 1""")
def interval_join(spark, sf_dir):
    """Purchases within the intervals that errors open (minutes to months long, overlapping)."""
    ev = tables.events(spark, sf_dir, ("event_id", "ts", "event_type", "value", "user_id"))
    seconds = F.round(F.col("value") * F.when(F.col("user_id") % 50 == 0, 86400).otherwise(60)).cast("long")
    spans = ev.filter((F.col("event_type") == "error") & F.col("value").isNotNull()).select(
        F.col("event_id").alias("interval_id"), F.col("ts").alias("start"), (F.col("ts") + F.make_dt_interval(secs=seconds)).alias("stop"))
    points = ev.filter(F.col("event_type") == "purchase").select("ts", F.col("value").cast("decimal(18,2)").alias("value"))
    hits = intervals.interval_join(points, spans, "ts", "start", "stop", totals={"events": F.lit(1), "total": "value"})
    return hits.groupBy("interval_id").agg(F.sum("events").alias("events"), F.sum("total").cast("double").alias("total"))


@register("scalar_array", S.with_h(f"""
SELECT day, list_position(a, list_max(a)) - 1 AS argmax, list_transform(list_sort(list_transform(a, lambda x, i: struct_pack(x := x, i := i - 1))), lambda s: s.i) AS argsort,
  list_transform(list_filter(list_transform(f, lambda x, i: struct_pack(x := x, i := i - 1)), lambda s: s.x <> 0), lambda s: s.i) AS spike_hours,
  a[3:6] AS part, a[greatest(len(a) - 2, 1):len(a)] AS tail,
  CASE WHEN len(a) >= 4 THEN list_transform(generate_series(1, len(a) - 3), lambda i: {S.r6('list_sum(a[i:i+3])')}) ELSE [] END AS window_sums
FROM x""", extra="""
x AS (SELECT CAST(ts AS DATE) AS day, list(price ORDER BY ts) AS a, list(CAST(price > 200 AS INTEGER) ORDER BY ts) AS f FROM h GROUP BY 1)"""))
def scalar_array(spark, sf_dir):
    """F-arr: argmax (first), argsort, flatnonzero, slices and the window view of each day's prices."""
    h = hourly_system(spark, sf_dir, materialized=False).select(F.to_date("ts").alias("day"), "ts", "price")
    d = h.groupBy("day").agg(F.transform(F.sort_array(F.collect_list(F.struct("ts", "price"))), lambda s: s["price"]).alias("a"))
    a = F.col("a")
    sums = F.transform(A.windows(a, 4), lambda w: r6(F.aggregate(w, F.lit(0.0), lambda s, x: s + x)))
    return d.select("day", A.argmax(a).alias("argmax"), A.argsort(a).alias("argsort"),
                    A.flatnonzero(F.transform(a, lambda x: (x > 200).cast("int"))).alias("spike_hours"),
                    A.take(a, 2, 6).alias("part"), A.take(a, -3, 100).alias("tail"), sums.alias("window_sums"))
