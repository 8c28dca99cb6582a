"""Queries: the three streaming jobs, each fed by two rounds of arriving files
and compared with the batch result over the same rows (ST1-ST3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import r6
from ..streaming import jobs
from .registry import register


def first_round():
    return F.dayofmonth("day") <= 15


def _two_rounds(spark, sf_dir, name, run):
    run_dir = jobs.new_run_dir(spark, name)
    src = run_dir + "/input"
    jobs.stage_event_files(spark, sf_dir, src, day_filter=first_round())
    run(src, run_dir)
    jobs.stage_event_files(spark, sf_dir, src, day_filter=~first_round())
    run(src, run_dir)
    return run_dir


@register("stream_hourly_totals", """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, event_type,
       (round(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 6) + 0.0) AS volume, count(*) AS readings
FROM events GROUP BY 1, 2""")
def stream_hourly_totals(spark, sf_dir):
    """ST1 = A01: watermark + tumbling hour windows, update mode, two arrival rounds."""
    holder = {}

    def run(src, run_dir):
        holder["df"] = jobs.hourly_totals_stream(spark, src, run_dir)

    _two_rounds(spark, sf_dir, "hourly", run)
    return holder["df"].withColumn("volume", r6("volume"))


@register("stream_finalised_hours", """
SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts, event_type,
       (round(CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE), 6) + 0.0) AS volume, count(*) AS readings
FROM events WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR GROUP BY 1, 2""")
def stream_finalised_hours(spark, sf_dir):
    """ST1 = A01: append mode with watermark eviction, two arrival rounds: every
    hour that ended before the watermark, written once."""
    holder = {}

    def run(src, run_dir):
        holder["df"], _ = jobs.finalised_hours_stream(spark, src, run_dir)

    _two_rounds(spark, sf_dir, "final", run)
    return holder["df"].withColumn("volume", r6("volume"))


@register("stream_dedupe", "SELECT event_id, ts, event_type, value FROM events")
def stream_dedupe(spark, sf_dir):
    """ST2 = A30: the later days first, then every row: late rows that are new
    stay, re-delivered ones go."""
    run_dir = jobs.new_run_dir(spark, "dedupe")
    src = run_dir + "/input"
    jobs.stage_event_files(spark, sf_dir, src, day_filter=~first_round())
    jobs.dedupe_stream(spark, src, run_dir)
    jobs.stage_event_files(spark, sf_dir, src)
    out = jobs.dedupe_stream(spark, src, run_dir)
    return out.select("event_id", "ts", "event_type", "value")


@register("stream_backfill", """
SELECT CAST(ts AS DATE) AS day, CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total, count(*) AS readings
FROM events GROUP BY 1""")
def stream_backfill(spark, sf_dir):
    """ST3 = S08: incremental file backfill; the second run reads only new files."""
    def run(src, run_dir):
        jobs.incremental_daily(spark, src, run_dir)

    run_dir = _two_rounds(spark, sf_dir, "backfill", run)
    return jobs.incremental_result(spark, run_dir)
