"""Killed and resumed backfills, interval joins and array functions against plain Python."""

import datetime as dt
import os
import random
import shutil
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltframe.functions import arrays as A
from voltframe.operators import backfill, intervals
from voltframe.plans import QUERIES

DAY0 = dt.date(2024, 1, 1)


def month():
    return F.date_format("day", "yyyy-MM")



class Killed(Exception):
    pass


@pytest.fixture
def job(spark, tmp_path):
    every = spark.createDataFrame([(DAY0 + dt.timedelta(days=i), float(i)) for i in range(100)], "day date, v double")
    path = str(tmp_path / "table")
    old = every.filter("v % 3 = 0")
    backfill.write_parts(old.withColumn(backfill.PART, month()), path)

    def run(**options):
        return backfill.run_backfill(spark, path, old.schema, every.select("day"), "day", month(), lambda p: p.join(every, "day").withColumn("v", F.col("v") + 1000), **options)

    def rows():
        return {(r.day - DAY0).days: r.v for r in spark.read.parquet(path).collect()}

    return path, run, rows


WANT = {i: float(i) if i % 3 == 0 else i + 1000.0 for i in range(100)}


def test_one_run_fills_the_table(job):
    path, run, rows = job
    assert run() == 66 and rows() == WANT and run() == 0 and rows() == WANT


def test_killed_between_compute_and_commit(job):
    path, run, rows = job
    before = rows()

    def kill(_):
        raise Killed

    with pytest.raises(Killed):
        run(before_publish=kill)
    assert rows() == before
    assert run() == 0 and rows() == WANT        # what was staged in full is published, nothing is computed again


def test_killed_while_partitions_are_replaced(spark, job):
    path, run, rows = job
    staged = []
    with pytest.raises(Killed):
        run(before_publish=lambda r: (staged.append(r), (_ for _ in ()).throw(Killed))[0])
    shutil.rmtree(os.path.join(path, f"{backfill.PART}=2024-02"))       # one partition gone, another replaced
    part = spark.read.parquet(f"{path}/_staged/{staged[0]}").filter(f"{backfill.PART} = '2024-03'")
    backfill.write_parts(part, path)
    run()
    assert rows() == WANT


def test_killed_while_staging(spark, job):
    path, run, rows = job
    with pytest.raises(Killed):
        run(before_publish=lambda r: (os.remove(f"{path}/_staged/{r}/_SUCCESS"), (_ for _ in ()).throw(Killed))[0])
    assert run() == 66 and rows() == WANT       # the half-written staging folder is not read


def test_capped_runs_go_on_and_leave_other_partitions_alone(job):
    path, run, rows = job
    files = lambda p: sorted(f for f in os.listdir(os.path.join(path, f"{backfill.PART}={p}")) if f.startswith("part-"))
    april = files("2024-04")
    assert run(max_new=10) == 10 and files("2024-04") == april
    assert run(max_new=40) == 40 and run() == 16 and rows() == WANT


def test_no_table_yet(spark, tmp_path):
    want = spark.createDataFrame([(DAY0, 1.0)], "day date, v double")
    path = str(tmp_path / "none")
    assert backfill.run_backfill(spark, path, want.schema, want.select("day"), "day", month(), lambda p: p.join(want, "day")) == 1
    assert spark.read.parquet(path).count() == 1


@pytest.mark.parametrize("closed", [False, True])
def test_interval_join_equals_all_pairs(spark, closed):
    rng, t0 = random.Random(4), dt.datetime(2023, 12, 31, 23)
    at = lambda hours: t0 + dt.timedelta(seconds=int(hours * 3600))
    points = [(i, at(rng.uniform(-50, 9000))) for i in range(300)] + [(900, None), (901, at(5)), (902, at(6)), (903, at(6))]
    spans = [(i, at(a), at(a + rng.choice([0, 0.2, 1, 1.0003, 7, 8, 9, 64, 700, 8760]))) for i, a in enumerate(rng.uniform(0, 8000) for _ in range(60))]
    spans += [(100, at(5), at(6)), (101, at(5), at(5)), (102, at(9), at(1)), (103, None, at(4)), (104, at(4), None), (105, at(-40), at(9000))]
    got = intervals.interval_join(spark.createDataFrame(points, "p int, ts timestamp_ntz"), spark.createDataFrame(spans, "s int, a timestamp_ntz, b timestamp_ntz"), "ts", "a", "b", closed)
    inside = lambda t, a, b: a <= t <= b if closed else a <= t < b
    want = sorted((p, s) for p, t in points if t for s, a, b in spans if a and b and inside(t, a, b))
    assert sorted((r.p, r.s) for r in got.collect()) == want
    assert "Nested" not in got._jdf.queryExecution().executedPlan().toString()


def test_interval_join_of_nothing(spark):
    none = spark.createDataFrame([], "s int, a timestamp_ntz, b timestamp_ntz")
    some = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))], "p int, ts timestamp_ntz")
    assert intervals.interval_join(some, none, "ts", "a", "b").count() == 0


@pytest.mark.parametrize("closed", [False, True])
@pytest.mark.parametrize("blocks", [None, 7])
def test_interval_sums_equal_all_pairs(spark, closed, blocks):
    """Sums of each interval row: equal rows, equal times, NULL values, empty and reversed intervals."""
    rng, t0 = random.Random(6), dt.datetime(2023, 12, 31, 23)
    at = lambda minutes: t0 + dt.timedelta(minutes=minutes)
    points = [(at(rng.randrange(0, 900)), rng.choice([None, Decimal(rng.randrange(-500, 500)) / 100])) for _ in range(400)]
    points += [(None, Decimal(1)), (at(2000), None), (at(2000), None), (at(3000), Decimal("0.01"))]
    spans = [(rng.randrange(20), at(a), at(a + rng.choice([0, 1, 30, 700]))) for a in (rng.randrange(-50, 950) for _ in range(60))]
    spans += [spans[0], (None, at(5), at(80)), (100, at(2000), at(2000)), (101, at(2000), at(2001)), (102, at(9), at(1)), (103, None, at(4)), (104, at(4), None), (105, at(5000), at(6000))]
    got = intervals.interval_join(spark.createDataFrame(points, "ts timestamp_ntz, v decimal(18,2)"), spark.createDataFrame(spans, "s int, a timestamp_ntz, b timestamp_ntz"),
                                  "ts", "a", "b", closed, totals={"n": F.lit(1), "total": "v"}, blocks=blocks)
    want = []
    for s, a, b in spans:
        held = [v for t, v in points if t and a and b and (a <= t <= b if closed else a <= t < b)]
        if held:
            want.append((s, a, b, len(held), sum(v for v in held if v is not None) if any(v is not None for v in held) else None))
    assert got.columns == ["s", "a", "b", "n", "total"]
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_interval_sums_of_nothing_and_of_doubles(spark):
    none = spark.createDataFrame([], "s int, a timestamp_ntz, b timestamp_ntz")
    some = spark.createDataFrame([(1.5, dt.datetime(2024, 1, 1))], "p double, ts timestamp_ntz")
    assert intervals.interval_join(some, none, "ts", "a", "b", totals={"n": F.lit(1)}).count() == 0
    with pytest.raises(TypeError, match="total"):
        intervals.interval_join(some, none, "ts", "a", "b", totals={"total": "p"})


def test_interval_query_forms_no_pairs(spark, tmp_path, monkeypatch):
    """Dense purchases in long intervals: rows out of the join grow with the intervals, not with the pairs."""
    t0, n = dt.datetime(2024, 1, 1), 200
    rows = [(i, t0 + dt.timedelta(seconds=i), 50, "error" if i % 2 else "purchase", 1.0 + i % 3) for i in range(2 * n)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    out, join = [], intervals.interval_join

    def counted(*args, **options):
        hits = join(*args, **options)
        out.append(hits.count())
        return hits

    monkeypatch.setattr(intervals, "interval_join", counted)
    got = {r.interval_id: (r.events, r.total) for r in QUERIES["interval_join"](spark, str(tmp_path)).collect()}
    later = {i: [1.0 + j % 3 for j in range(i + 1, 2 * n, 2)] for i in range(1, 2 * n - 1, 2)}
    assert got == {i: (len(v), sum(v)) for i, v in later.items()}
    assert out == [n - 1]


def test_array_functions_equal_numpy(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.integers(0, 4, n).astype(float).tolist()) for i, n in enumerate([0, 1, 2, 3, 5, 8, 13])] + [(99, None)]
    a = F.col("a")
    got = spark.createDataFrame(rows, "i int, a array<double>").select(
        "i", A.argmax(a).alias("m"), A.argsort(a).alias("s"), A.flatnonzero(a).alias("z"), A.take(a, 1, 4).alias("t"), A.take(a, -3, -1).alias("u"),
        A.take(a, 5, 2).alias("e"), A.windows(a, 3).alias("w")).collect()
    for (_, v), r in zip(sorted(rows), sorted(got)):
        if v is None:
            assert r.m is None and r.s is None and r.z is None
            continue
        x = np.array(v)
        assert r.m == (int(x.argmax()) if len(x) else None) and r.s == x.argsort(kind="stable").tolist() and r.z == np.flatnonzero(x).tolist()
        assert (r.t, r.u, r.e) == (v[1:4], v[-3:-1], v[5:2])
        assert r.w == [v[k:k + 3] for k in range(len(v) - 2)]
