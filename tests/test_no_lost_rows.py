"""Rows with NULL keys, NULL or negative positions, gaps and late arrival stay."""

import datetime as dt

from pyspark.sql import functions as F

from small_tables import SF_SMALL
from voltframe.functions import calendar as cal
from voltframe.operators import align, series


def test_ordered_keeps_negative_and_null_positions(spark):
    ids = [-30, -3, -2, -1, 0, 1, 2, 7, 8, 9]
    df = spark.createDataFrame([(i,) for i in ids] + [(None,), (None,)], "i long")
    out = series.ordered(df, lambda w: {"prev": F.lag("i").over(w), "next": F.lead("i").over(w)}, order="i", idx="i", reach=1, block_rows=3)
    got = {r.i: (r.prev, r.next) for r in out.collect() if r.i is not None}
    assert sorted(got) == ids and out.filter("i IS NULL AND prev IS NULL AND next IS NULL").count() == 2
    near = {-3: (None, -2), -2: (-3, -1), -1: (-2, 0), 0: (-1, 1), 1: (0, 2), 8: (7, 9)}
    assert {k: got[k] for k in near} == near


def test_row_index_keeps_null_keys_and_null_order(spark):
    t = lambda d: dt.datetime(2024, 1, d)
    rows = [(None, t(1)), (None, t(3)), ("a", None), ("a", t(2)), ("a", t(9)), (None, None)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz")
    out = series.add_row_index(df, keys=["k"], block_width=86400.0)
    got = sorted((r.k or "", r.idx, r.ts or dt.datetime.min) for r in out.collect())
    assert [(k, i) for k, i, _ in got] == [("", 0), ("", 1), ("", 2), ("a", 0), ("a", 1), ("a", 2)]
    assert got[0][2] == dt.datetime.min and got[3][2] == dt.datetime.min        # NULL first


def test_prefix_sums_and_totals_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 2.0), (None, 2, 3.0), ("a", 1, 5.0)], "k string, o int, v double")
    out = series.prefix_sums(df, ["v"], "o", keys=["k"], block=F.col("o"))
    assert sorted((r.k or "", r.v_cum) for r in out.collect()) == [("", 2.0), ("", 5.0), ("a", 5.0)]
    totals = df.groupBy("k").agg(F.sum("v").alias("total"))
    assert sorted((r.k or "", r.total) for r in series.attach_totals(df, totals, ["k"]).collect()) == [("", 5.0), ("", 5.0), ("a", 5.0)]


def test_event_flag_has_one_rule_for_null(spark):
    df = spark.createDataFrame([(None,), (dt.datetime(2024, 1, 3),)], "ts timestamp_ntz")
    for n in (1, 71, 400):
        ranges = [("2024-01-03", "2024-01-04")] + [(f"{1800 + k}-01-01", f"{1800 + k}-01-02") for k in range(n)]
        assert sorted((r.ts is None, r.is_event) for r in cal.event_flag(df, ranges).collect()) == [(False, 1), (True, 0)]
    outside = spark.createDataFrame([(dt.datetime(2024, 5, 1),)], "ts timestamp_ntz")       # a midnight of no range
    assert cal.event_flag(outside, [("2024-01-03", "2024-01-04")]).first().is_event == 0


def test_inventory_ends_at_the_next_line_whatever_its_number(spark):
    lines = spark.createDataFrame([("f", f"{n}:{n * 100 - 100}:d=20240101:v:0 m:") for n in (1, 2, 4, 5)], "file string, value string")
    got = {r.n: r.end for r in align.parse_inventory(lines).collect()}
    assert got == {1: 99, 2: 299, 4: 399, 5: None}


def test_backfill_is_capped_only_on_request(spark):
    days = spark.createDataFrame([(d,) for d in range(300)], "d int")
    old = spark.createDataFrame([(5, "old")], "d int, s string")
    compute = lambda p: p.withColumn("s", F.lit("new"))
    assert align.resume_backfill(days, old, "d", compute).count() == 300
    capped = align.resume_backfill(days, old, "d", compute, max_new=10)
    assert sorted(r.d for r in capped.collect()) == [*range(11)]


def test_late_new_rows_reach_the_deduplicated_target(spark):
    from voltframe.streaming import jobs
    run_dir = jobs.new_run_dir(spark, "t_late_new")
    src = run_dir + "/input"
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=F.dayofmonth("day") >= 20)
    before = jobs.dedupe_stream(spark, src, run_dir).count()
    jobs.stage_event_files(spark, SF_SMALL, src, day_filter=(F.dayofmonth("day") <= 3) | (F.dayofmonth("day") == 25))
    after = jobs.dedupe_stream(spark, src, run_dir)
    ev = spark.read.parquet(SF_SMALL + "/events.parquet").filter((F.dayofmonth("ts") >= 20) | (F.dayofmonth("ts") <= 3))
    assert after.count() == ev.count() > before
    assert after.select("event_id").distinct().count() == ev.count()
