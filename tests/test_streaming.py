"""Stream = batch: the streaming jobs over two arrival rounds equal the batch
operators on the same rows."""

from pyspark.sql import functions as F

from small_tables import SF_SMALL

import __spark_entry__ as E


def test_incremental_backfill_reads_only_new_files(spark):
    from voltframe.streaming import jobs
    run_dir = jobs.new_run_dir(spark, "t_backfill")
    src = run_dir + "/input"
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day") <= 10)
    jobs.incremental_daily(spark, src, run_dir)
    first = jobs.incremental_result(spark, run_dir).count()
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day") > 10)
    jobs.incremental_daily(spark, src, run_dir)
    res = spark.read.parquet(run_dir + "/out")
    # every day appears in exactly one batch: the second run read only the new files
    assert res.groupBy("day").count().filter(F.col("count") > 1).count() == 0
    total = jobs.incremental_result(spark, run_dir)
    assert total.count() > first
    ev = spark.read.parquet(SF_SMALL + "/events.parquet")
    assert total.agg(F.sum("readings")).first()[0] == ev.count()


def test_stream_dedupe_equals_distinct_events(spark):
    out = E.queries()["stream_dedupe"](spark, SF_SMALL)
    ev = spark.read.parquet(SF_SMALL + "/events.parquet").select("event_id", "ts", "event_type", "value")
    assert out.exceptAll(ev).count() == 0 and ev.exceptAll(out).count() == 0


def test_stream_hourly_equals_batch(spark, duck):
    out = E.queries()["stream_hourly_totals"](spark, SF_SMALL)
    got = sorted(tuple(r) for r in out.select("ts", "event_type", "volume", "readings").collect())
    cur = duck(SF_SMALL).execute(E.oracle_sql()["stream_hourly_totals"])
    exp = sorted(tuple(r) for r in cur.fetchall())
    assert got == exp


def test_watermark_drops_rows_later_than_the_bound(spark):
    """ST1: rows that arrive after the watermark passed their window are dropped
    (late data beyond the bound); rows within the bound are still counted."""
    from voltframe.streaming import jobs
    run_dir = jobs.new_run_dir(spark, "t_late")
    src = run_dir + "/input"
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day") >= 20)
    first = jobs.hourly_totals_stream(spark, src, run_dir, delay="2 hours")
    n_first = first.agg(F.sum("readings")).first()[0]
    # a re-sent copy of day 3 arrives now: far behind the watermark -> ignored
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day") == 3)
    second = jobs.hourly_totals_stream(spark, src, run_dir, delay="2 hours")
    assert second.filter(F.dayofmonth("ts") == 3).count() == 0
    assert second.agg(F.sum("readings")).first()[0] == n_first


def test_finalised_hours_are_written_once_with_bounded_state(spark, duck):
    """ST1, append mode: windows leave the state when the watermark passes them, and
    what comes later than that is counted and left out."""
    from voltframe.streaming import jobs
    run_dir = jobs.new_run_dir(spark, "t_final")
    src = run_dir + "/input"
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day") != 3)
    done, first = jobs.finalised_hours_stream(spark, src, run_dir, delay="60 days", max_files=4)
    assert done.count() == 0                    # nothing can be final yet: all windows are in the state
    run_dir = jobs.new_run_dir(spark, "t_final")
    src = run_dir + "/input"
    for day in range(1, 31):                    # one day after another, as they come
        if day != 3:
            jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day") == day)
            if day in (2, 10, 30):
                done, figures = jobs.finalised_hours_stream(spark, src, run_dir, delay="2 hours")
    assert figures["late_groups"] == 0
    cur = duck(SF_SMALL).execute(E.oracle_sql()["stream_finalised_hours"])
    want = sorted(r for r in cur.fetchall() if r[0].day != 3)
    got = sorted((r.ts, r.event_type, round(r.volume, 6), r.readings) for r in done.collect())
    assert got == want
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day") == 3)
    done, figures = jobs.finalised_hours_stream(spark, src, run_dir, delay="2 hours")
    assert done.count() == len(want) and figures["late_groups"] > 0
    assert figures["most_windows"] < first["most_windows"] / 20
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_dedupe_reads_the_target_for_late_rows_only(spark):
    from pathlib import Path

    from voltframe.streaming import jobs
    run_dir = jobs.new_run_dir(spark, "t_near")
    src = run_dir + "/input"
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day").between(2, 20))
    jobs.dedupe_stream(spark, src, run_dir, max_files=3)
    files = [f for f in Path(run_dir, "out").rglob("*.parquet")]
    kept = {f: f.read_bytes() for f in files}
    for f in files:                             # a batch that read the target would fail now
        f.write_bytes(b"no parquet")
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day").between(20, 23))     # day 20 again
    jobs.dedupe_stream(spark, src, run_dir, max_files=1).columns
    for f, raw in kept.items():
        f.write_bytes(raw)
        Path(f.parent, f".{f.name}.crc").unlink(missing_ok=True)
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day") < 10)       # late: day 1 is new, others again
    out = jobs.dedupe_stream(spark, src, run_dir, max_files=2).select("event_id", "ts", "event_type", "value")
    ev = spark.read.parquet(SF_SMALL + "/events.parquet").filter(F.dayofmonth("ts") <= 23).select("event_id", "ts", "event_type", "value")
    assert out.exceptAll(ev).count() == 0 and ev.exceptAll(out).count() == 0
